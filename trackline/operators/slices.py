"""Ordered computations per key that stay parallel when one key is huge.

A window over ``partitionBy(key)`` puts all rows of a key into one task. That is
right for ordinary keys and impossible for a key that holds a third of the data.
``per_key`` therefore separates the two kinds: ordinary keys use one plain window,
keys with more rows than a task should sort are cut into time slices. Each helper
takes ``slice_col=None`` for the plain case; given a slice column it works inside the
slices and carries what crosses a border through a small per-slice summary, so both
cases give the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE = "_slice"
ROW_BUDGET = 4_000_000  # rows of one key that one task may sort
INTERVALS = 64  # time intervals of about equal row counts, each cut further if need be
OVERSPLIT = 4  # slices per row budget, as rows are not quite even within an interval
CUTS = ("_edges", "_parts", "_bursts")
TIE = "id"  # orders rows of equal times; where there is such a number, bursts are cut by it


def hot_keys(
    df: DataFrame,
    keys: Sequence[str],
    t: str,
    row_budget: int = ROW_BUDGET,
    tie: str = TIE,
) -> DataFrame:
    """Keys with more rows than ``row_budget``, and how to cut their rows by time.

    Times that hold many rows of a key on their own (a default clock, a burst) are cut by
    ``tie``, a number that comes next in the order of rows. One row per hot key; there are at most as many as the budget goes into all rows.
    Joins with it are left to Spark, which broadcasts it only while it is small.
    """
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    large = sizes.filter(F.col("_n") > row_budget)
    levels = [k / INTERVALS for k in range(INTERVALS + 1)]
    times = df.select(*keys, F.col(t).cast("double").alias("_t"), _tie(df, tie).alias("_tie"))
    times = times.join(large.select(*keys), list(keys))
    cuts = times.groupBy(*keys).agg(
        F.percentile_approx("_t", levels).alias("_edges"),
        F.ceil(F.count(F.lit(1)) * OVERSPLIT / (row_budget * INTERVALS)).alias("_parts"),
    )
    bursts = (
        times.groupBy(*keys, "_t")
        .agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx("_tie", levels).alias("_ties"))
        .filter(F.col("_n") > row_budget / OVERSPLIT)
        .groupBy(*keys)
        .agg(F.collect_list(F.struct(F.col("_t").alias("t"), F.col("_ties").alias("ties"))).alias("_bursts"))
    )
    none = F.array().cast("array<struct<t:double,ties:array<double>>>")
    return cuts.join(bursts, list(keys), "left").withColumn("_bursts", F.coalesce("_bursts", none))


def _tie(df: DataFrame, tie: str) -> Column:
    number = dict(df.dtypes).get(tie) in ("int", "bigint", "double", "float", "smallint")
    return F.col(tie).cast("double") if number else F.lit(None).cast("double")


def split_hot(df: DataFrame, t: str, hot: DataFrame, tie: str = TIE) -> tuple[DataFrame, DataFrame]:
    """(rows of ordinary keys, rows of hot keys with a ``_slice`` column).

    Slices are in the order of time, and within a burst in the order of its ties.
    """
    keys = [c for c in hot.columns if c not in CUTS]
    cold = df.join(hot.select(*keys), keys, "left_anti")
    time = F.col(t).cast("double")
    interval = F.greatest(F.size(F.filter("_edges", lambda edge: edge <= time)), F.lit(1))
    low, high = F.get("_edges", F.col("_k") - 1), F.get("_edges", F.col("_k"))
    part = F.floor(F.try_divide(time - low, high - low) * F.col("_parts"))
    part = F.greatest(F.least(F.coalesce(part, F.lit(0)), F.col("_parts") - 1), F.lit(0))
    burst = F.get(F.filter("_bursts", lambda b: b["t"] == time), F.lit(0))["ties"]
    number = _tie(df, tie)
    piece = F.when(number.isNotNull(), F.size(F.filter(burst, lambda edge: edge <= number)))
    sliced = (
        df.join(hot, keys)
        .withColumn("_k", interval)
        .withColumn(
            SLICE,
            F.struct(
                (F.col("_k") * F.col("_parts") + part).alias("part"),
                F.size(F.filter("_bursts", lambda b: b["t"] < time)).alias("after"),
                F.coalesce(piece, F.lit(-1)).alias("piece"),
            ),
        )
        .drop("_k", *CUTS)
    )
    return cold, sliced


def per_key(
    df: DataFrame,
    t: str,
    hot: DataFrame,
    compute: Callable[[DataFrame, str | None], DataFrame],
    tie: str = TIE,
) -> DataFrame:
    """Run ``compute(rows, slice_col)`` on ordinary and on hot keys; keep all rows.

    ``hot`` comes from ``hot_keys``. It may be keyed by a prefix of the keys that
    ``compute`` works on: a trip can only be large if its entity is.
    """
    cold, sliced = split_hot(df, t, hot, tie)
    return compute(cold, None).unionByName(compute(sliced, SLICE).drop(SLICE))


def neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    wanted: dict[str, tuple[str, int]],
    slice_col: str | None = None,
) -> DataFrame:
    """Add ``{new column: (column, offset)}``; a negative offset looks back.

    Near a slice border the neighbour sits in another slice. The rows within twice the
    largest offset of a border contain every neighbour those border rows need, so a
    second window over just that band repairs them.
    """

    def shifted(window) -> dict[str, Column]:
        return {
            name: (F.lag(col, -off) if off < 0 else F.lead(col, off)).over(window)
            for name, (col, off) in wanted.items()
        }

    if slice_col is None:
        return df.withColumns(shifted(Window.partitionBy(*keys).orderBy(*order)))

    radius = max(abs(off) for _, off in wanted.values())
    inside = Window.partitionBy(*keys, slice_col)
    local = df.withColumns(
        {
            **shifted(inside.orderBy(*order)),
            "_pos": F.row_number().over(inside.orderBy(*order)),
            "_size": F.count(F.lit(1)).over(inside),
        }
    )

    def near_border(rows: int) -> Column:
        return (F.col("_pos") <= rows) | (F.col("_size") - F.col("_pos") < rows)

    repaired = (
        local.filter(near_border(2 * radius))
        .withColumns(shifted(Window.partitionBy(*keys).orderBy(*order)))
        .filter(near_border(radius))
    )
    return local.filter(~near_border(radius)).unionByName(repaired).drop("_pos", "_size")


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    value: str,
    out: str,
    slice_col: str | None = None,
) -> DataFrame:
    """Sum of ``value`` from the first row of the key up to this row."""
    if slice_col is None:
        window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(out, F.sum(value).over(window))
    parts = [*keys, slice_col]
    inside = Window.partitionBy(*parts).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = (
        Window.partitionBy(*keys).orderBy(slice_col).rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        df.groupBy(*parts)
        .agg(F.sum(value).alias("_sum"))
        .select(*parts, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    )
    return (
        df.join(offsets, parts)
        .withColumn(out, F.sum(value).over(inside) + F.col("_offset"))
        .drop("_offset")
    )


def nearest_known(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    wanted: dict[str, str],
    *,
    forward: bool,
    slice_col: str | None = None,
) -> DataFrame:
    """Add ``{new column: column}`` holding the last (or next) value that is not null.

    The next value is found by walking the reversed order, so that the frame only grows;
    a frame that ends at the partition's end would be scanned again for every row.
    """
    direction = F.asc if forward else F.desc
    ordering = [direction(c) for c in order]

    def fill(window) -> dict[str, Column]:
        return {out: F.last(col, ignorenulls=True).over(window) for out, col in wanted.items()}

    if slice_col is None:
        return df.withColumns(
            fill(
                Window.partitionBy(*keys)
                .orderBy(*ordering)
                .rowsBetween(Window.unboundedPreceding, 0)
            )
        )
    parts = [*keys, slice_col]
    inside = (
        Window.partitionBy(*parts).orderBy(*ordering).rowsBetween(Window.unboundedPreceding, 0)
    )
    earlier = (
        Window.partitionBy(*keys)
        .orderBy(direction(slice_col))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    pick = F.max_by if forward else F.min_by
    at = F.struct(*order)
    carried = {out: f"_carried_{out}" for out in wanted}
    borders = (
        df.groupBy(*parts)
        .agg(
            *[
                pick(F.col(col), F.when(F.col(col).isNotNull(), at)).alias(out)
                for out, col in wanted.items()
            ]
        )
        .select(
            *parts,
            *[F.last(o, ignorenulls=True).over(earlier).alias(c) for o, c in carried.items()],
        )
    )
    return (
        df.join(borders, parts)
        .withColumns(fill(inside))
        .withColumns({out: F.coalesce(F.col(out), F.col(c)) for out, c in carried.items()})
        .drop(*carried.values())
    )


def end_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    first: int,
    last: int,
    slice_col: str | None = None,
) -> DataFrame:
    """The first and last rows of each key.

    Adds ``_size`` (rows of the key) and the ranks ``_rank`` and ``_back``, which count
    from 1 at either end.
    """
    window = Window.partitionBy(*keys)
    size: Column = F.count(F.lit(1))
    if slice_col is not None:
        # The rows at the ends of the slices include those at the ends of the key.
        df = end_rows(df, [*keys, slice_col], order, first, last)
        df = df.withColumn("_part", F.when(F.col("_rank") == 1, F.col("_size")))
        df = df.drop("_size", "_rank", "_back")
        size = F.sum("_part")
    ranked = df.withColumns(
        {
            "_size": size.over(window),
            "_rank": F.row_number().over(window.orderBy(*order)),
            "_kept": F.count(F.lit(1)).over(window),
        }
    ).withColumn("_back", F.col("_kept") - F.col("_rank") + 1)
    return ranked.filter((F.col("_rank") <= first) | (F.col("_back") <= last)).drop(
        "_kept", "_part"
    )
