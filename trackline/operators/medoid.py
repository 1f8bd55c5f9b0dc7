"""The main trip of each route: the one with the least total edit distance to the others.

Equal sequences are counted, not compared. On routes with few sequences by the number that one can be
measured against, all pairs are measured, each once: in blocks of sequences, any two of which are a piece of work of
its own (``pair_sums``). On busier routes trips are ruled out in rounds first. A lower bound of each trip's total comes from how many
trips of the route pass each cell, and from the lengths. In each round the few trips with the
smallest bounds are measured against all that have not been measured before. That gives their exact
totals, and it raises the bounds of all others: by what each distance exceeds its part of the bound,
and by the triangle inequality, as d(i, k) >= |d(p, i) - d(p, k)| makes total(i) >= |n d(p, i) -
total(p)|. A trip whose bound exceeds the best total so far is out. Rounds grow as long as each of them
halves the pairs that are left to measure; what they leave is measured in blocks. So the result is exact, ties included.
A trip once measured is not met again in later rounds, so that even where all are about equally far
apart, hardly more than half of the ordered pairs are.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackline.operators import pair_sums
from trackline.operators.routes import ROUTE
from trackline.operators.tracks import ORDER, TRIP
from trackline.session import materialized

PIVOTS = 8  # in the first round, then twice as many each time
MOST_PIVOTS = 512
SALTS = 32  # parts of a busy route
MEASURED = 32_768  # pairs per sequence of a route that are measured without any round before
SMALL_ROUTE = 128  # sequences that are joined with each other
BLOCK, BLOCK_CELLS = 4096, 1_000_000  # sequences of a block and their cells
MOST_TASKS = 2000
WIDE = "\x01"  # stands before each cell of a route with more cells than there are characters
FIRST_SYMBOL = 0x100
SURROGATES, SURROGATE_COUNT = 0xD800, 0x800
SYMBOLS = 0x110000 - SURROGATE_COUNT - FIRST_SYMBOL


def visited_cells(
    points: DataFrame,
    *,
    keys: Sequence[str] = TRIP,
    order: Sequence[str] = ORDER,
    cell: dict[str, int] | None = None,
) -> DataFrame:
    """Each grid cell a trip passes, as text, with the time of the first visit.

    ``cell`` gives the decimals each coordinate is rounded to. A trip cannot have more
    rows here than the grid has cells. Points that lack a coordinate pass no cell.
    """
    cell = cell or {"lon": 1, "lat": 1}
    points = points.na.drop(subset=list(cell))
    token = F.concat_ws(",", *[F.round(c, d).cast("string") for c, d in cell.items()])
    return (
        points.select(*keys, token.alias("token"), F.struct(*order).alias("at"))
        .groupBy(*keys, "token")
        .agg(F.min("at").alias("at"))
    )


def token_sequences(cells: DataFrame, *, keys: Sequence[str] = TRIP) -> DataFrame:
    """The cells of each trip in order of the first visit, as an array."""
    ordered = F.array_sort(F.collect_list(F.struct("at", "token")))
    return cells.groupBy(*keys).agg(ordered["token"].alias("tokens"))


def edit_distance(a: Column, b: Column) -> Column:
    """Least number of insertions, deletions and replacements between two arrays of any vocabulary.

    Elements become characters: those of ``b`` by where they stand first in it, all others the
    same one, which ``b`` does not have. So the built-in function on text does the work.
    """
    places = F.array_distinct(b)

    def coded(elements: Column) -> Column:
        number = F.transform(elements, lambda x: F.array_position(places, x).cast("int") + 1)
        return F.array_join(F.transform(number, _character), "")

    return F.levenshtein(coded(a), coded(b))


def coded_sequences(
    cells: DataFrame,
    trips: DataFrame,
    *,
    keys: Sequence[str] = TRIP,
    route: Sequence[str] = ROUTE,
    symbols: int = SYMBOLS,
) -> DataFrame:
    """``trips`` with ``code``: its cells as text, one character per cell of the route.

    Where a route has more than ``symbols`` cells, their own names stand in the text, each after a mark.
    """
    placed = cells.join(trips.select(*keys, *route), list(keys))
    known = placed.select(*route, "token").distinct()
    # numbered within hashed parts, after the parts before: no window holds a whole route
    inside = F.row_number().over(Window.partitionBy(*route, "_part").orderBy("token"))
    known = materialized(known.withColumn("_part", _salt("token")).withColumn("_inside", inside))
    sizes = known.groupBy(*route, "_part").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy(*route).orderBy("_part")
    starts = sizes.select(
        *route,
        "_part",
        (F.sum("_n").over(upto) - F.col("_n")).alias("_start"),
        F.sum("_n").over(Window.partitionBy(*route)).alias("_cells"),
    )
    narrow = _character((F.col("_start") + F.col("_inside")).cast("int"))
    symbol = F.when(F.col("_cells") <= symbols, narrow).otherwise(F.concat(F.lit(WIDE), "token"))
    vocabulary = known.join(starts, [*route, "_part"]).select(*route, "token", symbol.alias("symbol"))
    code = F.array_sort(F.collect_list(F.struct("at", "symbol")))["symbol"]
    codes = (
        placed.join(vocabulary, [*route, "token"])
        .groupBy(*keys)
        .agg(F.array_join(code, "").alias("code"))
    )
    return trips.join(codes, list(keys))


def _character(number: Column) -> Column:
    """The character for a number from 1 to SYMBOLS."""
    point = number + (FIRST_SYMBOL - 1)
    point = F.when(point >= SURROGATES, point + SURROGATE_COUNT).otherwise(point)
    return F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")


def code_cells(code: Column) -> Column:
    """The cells of a code, as an array."""
    letters = F.transform(
        F.sequence(F.lit(1), F.length(code)), lambda k: F.substr(code, k, F.lit(1))
    )
    named = F.split(F.substr(code, F.lit(2)), WIDE)
    none = F.array().cast("array<string>")
    return F.when(_is_wide(code), named).when(F.length(code) > 0, letters).otherwise(none)


def code_distance(a: Column, b: Column) -> Column:
    """Edit distance of two codes of one route."""
    apart = edit_distance(code_cells(a), code_cells(b))
    return F.when(_is_wide(a) | _is_wide(b), apart).otherwise(F.levenshtein(a, b))


def _is_wide(code: Column) -> Column:
    return F.startswith(code, F.lit(WIDE))


def route_medoid(
    coded: DataFrame,
    *,
    route: Sequence[str] = ROUTE,
    pivots: int = PIVOTS,
    measured: int = MEASURED,
    log: list[int] | None = None,
) -> DataFrame:
    """The trips with the least total edit distance on their route, ties kept.

    Adds ``total``, the sum of distances to all trips of the route. Rounds serve routes where more than
    ``measured`` pairs per sequence are left. ``log`` receives how many distances each step has measured.
    """
    route = list(route)
    counted = coded.filter("code IS NOT NULL").groupBy(*route, "code").agg(F.count(F.lit(1)).alias("w"))
    sequences = materialized(counted)
    whole = sequences.groupBy(*route).agg(F.sum("w").alias("_n"))
    # _known: distances to the trips measured so far, added up; _least: by triangles
    left = sequences.join(whole, route).select(
        *route,
        *("code", "w", "_n"),
        F.lit(0.0).alias("_bound"),
        _long(0).alias("_known"),
        _long(0).alias("_least"),
    )
    totals = before = None
    while True:
        marked = _marked(left, totals, route)
        sizes = materialized(_sizes(marked, before, route, measured))
        ready, busy = sizes.filter("_ready"), sizes.filter("NOT _ready")
        done = sizes.agg(*[F.sum(F.when(F.col("_ready"), F.col(c))).alias(c) for c in ("_pairs", "_units")]).first()
        if done["_pairs"] is not None:
            found = materialized(_all_pairs(marked, ready, route, int(done["_units"])))
            totals = found if totals is None else totals.unionByName(found)
            if log is not None:
                log.append(int(done["_pairs"]))
        if busy.isEmpty():
            break
        left = left.join(busy.select(*route), route, "left_semi")
        if before is None:
            bounds = _bounded(left.select(*route, "code", "w"), route).select(*route, "code", "_bound")
            left = left.drop("_bound").join(bounds, [*route, "code"], "left")
            left = materialized(left.withColumn("_bound", F.coalesce("_bound", F.lit(0)).cast("double")))
        before = busy.select(*route, F.col("_pairs").alias("_before"))
        chosen = materialized(_chosen(left, totals, route, pivots))
        distances = materialized(_measured(left, chosen, route))
        if log is not None:
            log.append(distances.agg(F.sum(F.size("_d"))).first()[0])
        found = materialized(_totals(distances, chosen, route, pivots))
        totals = found if totals is None else totals.unionByName(found)
        left = materialized(_raised(distances, found, route))
        pivots = min(2 * pivots, MOST_PIVOTS)
    if totals is None:
        return coded.withColumn("total", _long(0)).limit(0)
    best = totals.groupBy(*route).agg(F.min("total").alias("total"))
    return coded.join(totals.join(best, [*route, "total"]), [*route, "code"])


def _marked(left: DataFrame, totals: DataFrame | None, route: list[str]) -> DataFrame:
    """Add ``_open``: whether the bound does not exceed the best total."""
    if totals is None:
        return left.withColumn("_open", F.lit(True))
    best = totals.groupBy(*route).agg(F.min("total").alias("_best"))
    is_open = F.coalesce(_lower() <= F.col("_best"), F.lit(True))
    return left.join(best, route, "left").withColumn("_open", is_open).drop("_best")


def _sizes(
    marked: DataFrame, before: DataFrame | None, route: list[str], measured: int
) -> DataFrame:
    """Per route the pairs that are left to measure, the blocks for it, and whether it is time for that."""
    cells = F.length("code").cast("bigint")
    sizes = marked.groupBy(*route).agg(
        F.count(F.lit(1)).alias("_left"),
        F.count_if("_open").alias("_open_left"),
        F.sum(F.when(F.col("_open"), cells).otherwise(0)).alias("_open_cells"),
        F.sum(cells).alias("_cells"),
    )
    rest, rest_cells = F.col("_left") - F.col("_open_left"), F.col("_cells") - F.col("_open_cells")

    def blocks(rows: Column, cells: Column) -> Column:
        return F.greatest(F.ceil(rows / BLOCK), F.least(rows, F.ceil(cells / BLOCK_CELLS)))

    sizes = sizes.withColumns(
        {
            "_pairs": F.col("_open_left") * rest + F.expr("_open_left * (_open_left - 1) div 2"),
            "_blocks": blocks(F.col("_open_left"), F.col("_open_cells")),
            "_rest_blocks": blocks(rest, rest_cells),
        }
    )
    is_ready = F.col("_pairs") <= F.col("_left") * measured
    if before is not None:
        sizes = sizes.join(before, route)
        is_ready |= 2 * F.col("_pairs") > F.col("_before")
    units = F.expr("_blocks * (_blocks + 1) div 2 + _blocks * _rest_blocks")
    return sizes.select(
        *route, "_left", "_pairs", "_blocks", "_rest_blocks", units.alias("_units"), is_ready.alias("_ready")
    )


def _all_pairs(marked: DataFrame, sizes: DataFrame, route: list[str], units: int) -> DataFrame:
    """Exact totals of the open sequences of the given routes."""
    sized = marked.join(sizes.select(*route, "_left", "_blocks", "_rest_blocks"), route)
    is_small = F.col("_left") <= SMALL_ROUTE
    small, large = sized.filter(is_small), sized.filter(~is_small)
    others = small.select(*route, F.col("code").alias("_code"), F.col("w").alias("_w"))
    apart = code_distance(F.col("code"), F.col("_code"))
    joined = (
        small.filter("_open")
        .join(others, route)
        .select(*route, "code", (F.col("_w") * apart).alias("total"))
    )
    known = sized.filter("_open").select(*route, "code", F.col("_known").alias("total"))
    parts = _block_sums(large, route, units)
    return (
        known.unionByName(joined)
        .unionByName(parts)
        .groupBy(*route, "code")
        .agg(F.sum("total").alias("total"))
    )


def _block_sums(large: DataFrame, route: list[str], units: int) -> DataFrame:
    """Parts of the totals of the open sequences, from every two blocks that meet.

    Open sequences are dealt into blocks of their own, and any two of these meet once; the others
    meet the open ones only.
    """
    blocks, rest, block = F.col("_blocks"), F.col("_rest_blocks"), F.col("_block")
    none = F.array().cast("array<struct<one:bigint,two:bigint,mixed:boolean>>")

    def pieces(n: Column, piece: Callable[[Column], tuple[Column, Column]], mixed: bool) -> Column:
        def made(k: Column) -> Column:
            one, two = piece(k)
            return F.struct(one.alias("one"), two.alias("two"), F.lit(mixed).alias("mixed"))

        return F.when(n > 0, F.transform(F.sequence(_long(0), n - 1), made)).otherwise(none)

    among = pieces(blocks, lambda k: (F.least(k, block), F.greatest(k, block)), False)
    met = F.when(F.col("_open"), F.concat(among, pieces(rest, lambda k: (block, k), True)))
    met = met.otherwise(pieces(blocks, lambda k: (k, block), True))
    keys = [*route, "_one", "_two", "_mixed"]
    # few bytes mean much work, so the number of tasks must not follow the bytes
    tasks = int(large.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(tasks, min(units, MOST_TASKS))
    dealt = (
        large.withColumn("_block", F.pmod(F.xxhash64("code"), F.when(F.col("_open"), blocks).otherwise(rest)))
        .select(*route, "code", "w", "_open", "_block", F.explode(met).alias("_met"))
        .select("*", *[F.col(f"_met.{c}").alias(f"_{c}") for c in ("one", "two", "mixed")])
        .drop("_met")
        .repartition(tasks, *keys)
    )
    schema = large.select(*route, "code", F.col("w").alias("total")).schema
    return dealt.groupBy(*keys).applyInArrow(pair_sums.of_blocks(route, WIDE), schema)


def _long(value: int) -> Column:
    return F.lit(value).cast("bigint")


def _salt(column: str) -> Column:
    return F.pmod(F.xxhash64(column), _long(SALTS))


def _lower() -> Column:
    return F.greatest("_bound", "_least")


def _chosen(left: DataFrame, totals: DataFrame | None, route: list[str], pivots: int) -> DataFrame:
    """Per route the trips to measure next: the smallest bounds that do not exceed the best total."""
    left = _marked(left, totals, route).filter("_open").drop("_open")
    # the smallest of a route are found within hashed parts of it first
    order = [_lower(), F.col("code")]
    part = Window.partitionBy(*route, "_salt").orderBy(*order)
    every = Window.partitionBy(*route).orderBy(*order)
    return (
        left.withColumn("_salt", _salt("code"))
        .withColumn("_rank", F.row_number().over(part))
        .filter(F.col("_rank") <= pivots)
        .withColumn("_rank", F.row_number().over(every))
        .filter(F.col("_rank") <= pivots)
        .groupBy(*route)
        .agg(F.sort_array(F.collect_list(F.struct("code", "w", "_known"))).alias("_pivots"))
    )


def _measured(left: DataFrame, chosen: DataFrame, route: list[str]) -> DataFrame:
    """All trips not measured so far, of routes that have pivots, with their distances to those."""
    # Few bytes mean much work here, so the number of tasks must not follow the bytes, and a busy
    # route is spread over the salts.
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [*route, "_salt"]
    salts = F.explode(F.sequence(_long(0), _long(SALTS - 1)))
    spread = left.withColumn("_salt", _salt("code")).repartition(tasks, *keys)
    pivots = chosen.withColumn("_salt", salts).repartition(tasks, *keys)
    distances = F.transform("_pivots", lambda p: code_distance(F.col("code"), p["code"]))
    return spread.join(pivots, keys).drop("_salt").withColumn("_d", distances)


def _totals(measured: DataFrame, chosen: DataFrame, route: list[str], pivots: int) -> DataFrame:
    """Exact totals of the pivots: what they knew, and their distances to all others."""
    sums = F.array(*[F.sum(F.col("w") * F.get("_d", F.lit(k))) for k in range(pivots)])
    each = F.arrays_zip(
        F.col("_pivots").alias("p"),
        F.slice("_sums", F.lit(1), F.size("_pivots")).alias("s"),
    )
    return (
        measured.groupBy(*route)
        .agg(sums.alias("_sums"))
        .join(chosen, route)
        .select(*route, F.inline(each))
        .select(*route, F.col("p.code").alias("code"), (F.col("p._known") + F.col("s")).alias("total"))
    )


def _raised(measured: DataFrame, found: DataFrame, route: list[str]) -> DataFrame:
    """The trips that are not pivots, with bounds raised by what their distances tell."""
    in_order = F.sort_array(F.collect_list(F.struct("code", "total")))
    totals = found.groupBy(*route).agg(in_order["total"].alias("_totals"))
    apart = F.transform(
        F.arrays_zip(F.col("_d").alias("d"), F.col("_totals").alias("t")),
        lambda x: F.abs(F.col("_n") * x["d"] - x["t"]),
    )
    pairs = F.arrays_zip(F.col("_d").alias("d"), F.col("_pivots").alias("p"))

    def added(value: Callable[[Column], Column]) -> Column:
        """The sum of a value of each pivot, as often as its sequence occurs."""
        return F.aggregate(pairs, _long(0), lambda so_far, x: so_far + x["p"]["w"] * value(x))

    def spare(x: Column) -> Column:
        """What the distance exceeds the part that this pair has in the bound."""
        other = F.array_distinct(code_cells(x["p"]["code"]))
        common = F.size(F.array_intersect("_cells", other))
        return x["d"] - F.greatest(F.size("_cells"), F.size(other)) + common

    return (
        measured.join(totals, route)
        .filter(~F.exists("_pivots", lambda p: p["code"] == F.col("code")))
        .withColumn("_cells", F.array_distinct(code_cells(F.col("code"))))
        .select(
            *route,
            *("code", "w", "_n"),
            (F.col("_bound") + added(spare)).alias("_bound"),
            (F.col("_known") + added(lambda x: x["d"])).alias("_known"),
            F.greatest("_least", F.array_max(apart)).alias("_least"),
        )
    )


def _bounded(sequences: DataFrame, route: list[str]) -> DataFrame:
    """Add ``_bound``, at most the total distance of the sequence.

    Two sequences with cell sets A and B differ by at least max(|A - B|, |B - A|), which is
    half of the number of cells in just one of them plus half the difference of the sizes.
    Both parts sum up over a route from counts per cell and per size.
    """
    sets = sequences.filter(F.length("code") > 0)
    sets = sets.withColumn("_set", F.array_distinct(code_cells(F.col("code"))))
    sets = sets.withColumn("_size", F.size("_set"))
    cells = sets.select(*route, "code", "w", F.explode("_set").alias("_cell"))
    passing = cells.groupBy(*route, "_cell").agg(F.sum("w").alias("_passing"))
    whole = sequences.groupBy(*route).agg(F.sum("w").alias("_n"))
    all_cells = passing.groupBy(*route).agg(F.sum("_passing").alias("_all"))
    # cells of other trips not in this one, plus cells of this one not in other trips
    apart = (
        cells.join(passing, [*route, "_cell"])
        .join(whole, route)
        .groupBy(*route, "code")
        .agg(F.sum(F.col("_n") - 2 * F.col("_passing")).alias("_apart"))
    )
    by_size = sets.groupBy(*route, "_size").agg(F.sum("w").alias("_w"))
    upto = Window.partitionBy(*route).orderBy("_size").rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy(*route)
    mass = F.col("_w") * F.col("_size")
    below, below_mass = F.sum("_w").over(upto), F.sum(mass).over(upto)
    above = F.sum("_w").over(every) - below
    above_mass = F.sum(mass).over(every) - below_mass
    spread = by_size.select(
        *route,
        "_size",
        (F.col("_size") * (below - above) - below_mass + above_mass).alias("_spread"),
    )
    bound = (F.col("_all") + F.col("_apart") + F.col("_spread")) / 2
    return (
        sets.drop("_set")
        .join(apart, [*route, "code"])
        .join(spread, [*route, "_size"])
        .join(all_cells, route)
        .select(*route, "code", "w", bound.alias("_bound"))
    )


def medoid_label_mix(
    medoids: DataFrame, *, route: Sequence[str] = ROUTE, label: str = "type"
) -> DataFrame:
    """Per route the number of labelled trips among its main trips."""
    return medoids.groupBy(*route).agg(F.sum(label).alias("labelled"))


def medoid_points(
    points: DataFrame, medoids: DataFrame, *, keys: Sequence[str] = TRIP
) -> DataFrame:
    """The points of the main trips."""
    return points.join(medoids.select(*keys), list(keys), "left_semi")
