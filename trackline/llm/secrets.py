"""Secrets in texts: fixed patterns, and strings that a battery of tests finds random. Columns only.

Base spans are the matches of three patterns. Added spans ("random") are strings of 20 or more letters,
digits and signs of common encodings, with a letter and a digit. The string's characters tell its
encoding; over that alphabet three tests look at it: chi-squared of the symbols' counts, the number of
runs above and below the middle of the alphabet, and the correlation of neighbours. Fisher's method
combines their probabilities. Strings that are not random (paths, names, numbered words) get small
probabilities; the Benjamini-Hochberg procedure over all strings of about the same length in the corpus
rejects them, so that among the rejected at most the share ``share`` are random after all. What is
not rejected is reported. Long strings give the tests more power, which is why lengths are kept apart.

Positions are code points, the end exclusive. A null text counts as empty and has no spans. Repeated
rows are scanned one by one. Other columns are not carried unless named. An empty table gives an empty
result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from trackline.session import materialized

# The patterns of the base spans, in the order of their kinds.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
LEAST_VALUE = 12
KINDS = ["assign", "access", "hex", "random"]

# A run of 20 or more encoding characters with a digit and a letter, and padding.
CANDIDATE = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9+/_-]*[A-Za-z])[A-Za-z0-9+/_-]{20,}={0,2}"

DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Encodings by their characters, the narrowest first, and their alphabets in order of value.
ENCODINGS = [
    ("^[0-9a-f]+$", DIGITS + "abcdef"),
    ("^[0-9A-F]+$", DIGITS + "ABCDEF"),
    ("^[A-Z2-7]+$", UPPER + "234567"),
    ("^[a-z0-9]+$", DIGITS + LOWER),
    ("^[A-Z0-9]+$", DIGITS + UPPER),
    ("^[A-Za-z0-9]+$", DIGITS + UPPER + LOWER),
    ("^[A-Za-z0-9+/]+$", UPPER + LOWER + DIGITS + "+/"),
    ("^[A-Za-z0-9_-]+$", UPPER + LOWER + DIGITS + "-_"),
]

SPAN = "array<struct<start:bigint,place:int,stop:bigint,kind:string>>"
STEPS = 20  # bins of probabilities for a factor of ten
LAST_BIN = 20 * STEPS


def _sums(values: Column) -> Column:
    """Sums of an array of longs up to each element. Copies the sums so far for each: for short arrays."""
    return F.aggregate(
        values,
        F.array().cast("array<bigint>"),
        lambda done, x: F.concat(done, F.array(F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit(0)) + x)),
    )


def with_running_sums(rows: DataFrame, columns: dict[str, str], block: int = 256) -> DataFrame:
    """For each array of longs its sums up to each element, under a new name.

    Sums are taken within blocks first, and then over blocks, so that long arrays cost little more
    than in proportion to their length.
    """

    def cut(old: str) -> Column:
        numbers = F.sequence(F.lit(0), ((F.size(old) - 1) / block).cast("int"))
        parts = F.transform(numbers, lambda n: _sums(F.slice(old, n * block + 1, F.lit(block))))
        return F.when(F.size(old) > 0, parts).otherwise(F.array().cast("array<array<bigint>>"))

    blocks = {f"{new}_blocks": cut(old) for new, old in columns.items()}
    before = {
        f"{new}_before": F.concat(
            F.array(F.lit(0).cast("bigint")), _sums(F.transform(f"{new}_blocks", lambda b: F.element_at(b, -1)))
        )
        for new in columns
    }
    whole = {
        new: F.flatten(
            F.zip_with(
                f"{new}_blocks",
                F.slice(f"{new}_before", F.lit(1), F.size(f"{new}_blocks")),
                lambda b, start: F.transform(b, lambda x: x + start),
            )
        )
        for new in columns
    }
    return rows.withColumns(blocks).withColumns(before).withColumns(whole)


def normal_tail(z: Column) -> Column:
    """Probability that a standard normal value is above z >= 0 (Abramowitz and Stegun, 26.2.17)."""
    t = 1 / (1 + 0.2316419 * z)
    series = t * (
        0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429)))
    )
    return F.exp(-z * z / 2) * 0.3989422804014327 * series


def _tail(z: Column) -> Column:
    """Upper tail for z of either sign; beyond 12 the tail of 12."""
    bounded = F.least(F.abs(z), F.lit(12.0))
    return F.when(z >= 0, normal_tail(bounded)).otherwise(1 - normal_tail(bounded))


def _both_tails(z: Column) -> Column:
    return F.least(2 * normal_tail(F.least(F.abs(z), F.lit(12.0))), F.lit(1.0))


def with_randomness(strings: Column) -> Column:
    """For structs with s (a string) and others: s, others, size (length class) and bin (of the probability).

    One transform after the other, so that what later formulas use several times is computed once.
    """

    def encoded(x: Column) -> Column:
        text, alphabet = F.rtrim(x["s"], F.lit("=")), F.lit(None).cast("string")
        for pattern, letters in reversed(ENCODINGS):
            alphabet = F.when(F.rtrim(x["s"], F.lit("=")).rlike(pattern), F.lit(letters)).otherwise(alphabet)
        return F.struct(x["p"].alias("p"), text.alias("s"), alphabet.alias("alphabet"))

    def valued(x: Column) -> Column:
        values = F.transform(F.split(x["s"], ""), lambda c: F.instr(x["alphabet"], c) - 1)
        squares = F.aggregate(
            F.split(x["alphabet"], ""),
            F.lit(0.0),
            lambda done, c: done + F.pow(F.length(x["s"]) - F.length(F.replace(x["s"], c, F.lit(""))), F.lit(2.0)),
        )
        n, k = F.length(x["s"]).cast("double"), F.length(x["alphabet"]).cast("double")
        return F.struct(x["p"].alias("p"), n.alias("n"), k.alias("k"), squares.alias("squares"), values.alias("values"))

    def paired(x: Column) -> Column:
        following = F.slice(x["values"], F.lit(2), F.size(x["values"]) - 1)
        middle = (x["k"] - 1) / 2
        pairs = F.zip_with(
            F.slice(x["values"], F.lit(1), F.size(x["values"]) - 1),
            following,
            lambda a, b: F.struct(
                ((a - middle) * (b - middle)).alias("product"), F.when((a > middle) != (b > middle), 1).otherwise(0).alias("change")
            ),
        )
        return F.struct(x["p"].alias("p"), x["n"].alias("n"), x["k"].alias("k"), x["squares"].alias("squares"), pairs.alias("pairs"))

    def measured(x: Column) -> Column:
        n, k = x["n"], x["k"]
        chi = k / n * x["squares"] - n
        changes = F.aggregate(x["pairs"], F.lit(0), lambda done, pair: done + pair["change"])
        together = F.aggregate(x["pairs"], F.lit(0.0), lambda done, pair: done + pair["product"])
        return F.struct(
            x["p"].alias("p"),
            F.floor(F.log2(n)).cast("int").alias("size"),
            ((chi - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)).alias("uniform"),
            ((changes - (n - 1) / 2) / (F.sqrt(n - 1) / 2)).alias("runs"),
            (together / ((k * k - 1) / 12) / F.sqrt(n - 1)).alias("serial"),
        )

    def combined(x: Column) -> Column:
        logs = -(F.log(_tail(x["uniform"])) + F.log(_both_tails(x["runs"])) + F.log(_both_tails(x["serial"])))
        return F.struct(x["p"].alias("p"), x["size"].alias("size"), logs.alias("logs"))

    def binned(x: Column) -> Column:
        logs = x["logs"]
        chance = -(F.log10(1 + logs + logs * logs / 2) - logs / F.lit(2.302585092994046))
        number = F.least(F.floor(chance * STEPS), F.lit(LAST_BIN))
        return F.struct(x["p"].alias("p"), x["size"].alias("size"), F.greatest(number, F.lit(0)).cast("int").alias("bin"))

    known = F.filter(F.transform(strings, encoded), lambda x: x["alphabet"].isNotNull())
    for step in (valued, paired, measured, combined, binned):
        known = F.transform(known, step)
    return known


def count_below(numbers: str, limit: Column) -> Column:
    """How many numbers of a sorted array column are below ``limit``, by halving steps."""
    size = F.size(numbers)
    steps = F.when(size > 0, F.sequence(F.floor(F.log2(size)).cast("int"), F.lit(0), F.lit(-1)))
    return F.aggregate(
        F.coalesce(steps, F.array().cast("array<int>")),
        F.lit(0),
        lambda done, step: F.when(
            F.coalesce(F.try_element_at(numbers, done + F.call_function("shiftleft", F.lit(1), step)) < limit, F.lit(False)),
            done + F.call_function("shiftleft", F.lit(1), step),
        ).otherwise(done),
    )


def _sorted(spans: Column, field: str) -> Column:
    return F.array_sort(F.transform(spans, lambda s: s[field]))


def _spans(places: Column, kind: str) -> Column:
    place = KINDS.index(kind)
    return F.transform(
        places,
        lambda p: F.struct(
            p["start"].alias("start"), F.lit(place).alias("place"), p["stop"].alias("stop"), F.lit(kind).alias("kind")
        ),
    ).cast(SPAN)


def scan(
    docs: DataFrame, key: str = "doc_id", text: str = "text", carry: list[str] | None = None, share: float = 0.05
) -> DataFrame:
    """``key``, base and added (arrays of start, place, stop, kind; sorted by start and kind).

    ``carry`` names columns to bring along in a struct column "carried".
    """
    rows = docs.select(
        F.col(key).alias("key"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.struct(F.lit(1), *(carry or [])).alias("carried"),
    )
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "random": CANDIDATE}
    no_strings = F.array().cast("array<string>")
    for kind, pattern in patterns.items():
        found = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
        if kind == "access":
            found = F.when(F.contains("text", F.lit("AKIA")), found).otherwise(no_strings)
        rows = rows.withColumn(f"{kind}_found", found)
    values = F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2))
    rows = rows.withColumn("assign_values", F.when(F.size("assign_found") > 0, values).otherwise(no_strings))
    rows = rows.withColumns(
        {
            f"{kind}_gaps": F.when(
                F.size(f"{kind}_found") > 0,
                F.transform(F.split("text", pattern, -1), lambda x: F.length(x).cast("bigint")),
            ).otherwise(F.array().cast("array<bigint>"))
            for kind, pattern in patterns.items()
        }
    )
    # each match ends after all texts before matches and all matches up to it
    rows = rows.withColumns(
        {
            f"{kind}_steps": F.zip_with(
                F.slice(f"{kind}_gaps", F.lit(1), F.size(f"{kind}_found")),
                f"{kind}_found",
                lambda gap, match: gap + F.length(match),
            )
            for kind in patterns
        }
    )
    rows = with_running_sums(rows, {f"{kind}_ends": f"{kind}_steps" for kind in patterns})
    rows = rows.withColumns(
        {
            f"{kind}_places": F.zip_with(
                f"{kind}_ends",
                f"{kind}_found",
                lambda end, match: F.struct((end - F.length(match)).alias("start"), end.alias("stop")),
            )
            for kind in patterns
        }
    )
    valued = F.zip_with("assign_places", "assign_values", lambda p, v: F.struct(p.alias("p"), F.length(v).alias("n")))
    long_enough = F.transform(F.filter(valued, lambda x: x["n"] >= LEAST_VALUE), lambda x: x["p"])
    base = F.concat(
        _spans(long_enough, "assign"), _spans(F.col("access_places"), "access"), _spans(F.col("hex_places"), "hex")
    )
    rows = rows.withColumn("base", F.array_sort(base))
    tested = F.zip_with("random_found", "random_places", lambda s, p: F.struct(s.alias("s"), p.alias("p")))
    rows = rows.withColumns({"base_starts": _sorted(F.col("base"), "start"), "base_stops": _sorted(F.col("base"), "stop")})
    # base spans begun before the candidate's end, less those over before its start, are those that overlap it
    free = F.filter(
        tested,
        lambda x: count_below("base_starts", x["p"]["stop"]) == count_below("base_stops", x["p"]["start"] + 1),
    )
    rows = rows.withColumn("free", free).withColumn("tested", with_randomness(F.col("free")))
    rows = materialized(rows.select("key", "carried", "base", "tested"))
    cuts = _cuts(rows, share)
    table = F.create_map(*[F.lit(x) for pair in cuts.items() for x in pair]) if cuts else None
    kept = F.col("tested")
    if table is not None:
        kept = F.filter("tested", lambda x: x["bin"] < F.coalesce(F.try_element_at(table, x["size"]), F.lit(LAST_BIN + 1)))
    added = F.array_sort(_spans(F.transform(kept, lambda x: x["p"]), "random"))
    columns = [F.col("key").alias(key), "base", added.alias("added")]
    return rows.select(*columns, *(["carried"] if carry else []))


def _cuts(rows: DataFrame, share: float) -> dict[int, int]:
    """Per length class the first bin that is rejected. A class has a bounded number of bins, classes are few."""
    counts = rows.select(F.explode("tested").alias("x")).groupBy("x.size", "x.bin").count()
    above = Window.partitionBy("size").orderBy(F.desc("bin"))
    all_bins = Window.partitionBy("size")
    ranked = counts.select(
        "size", "bin", F.sum("count").over(above).alias("rank"), F.sum("count").over(all_bins).alias("total")
    )
    # the bin's upper edge stands for all its probabilities, which rejects fewer
    passed = ranked.where(F.pow(F.lit(10.0), -F.col("bin") / STEPS) <= share * F.col("rank") / F.col("total"))
    return {size: first for size, first in passed.groupBy("size").agg(F.min("bin")).collect()}


def joined(spans: Column) -> Column:
    """kind:start:end of spans, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ","
    )


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def redacted(rows: DataFrame, text: str, spans: str, mark: str = "[SECRET]", together: int = 64) -> DataFrame:
    """Rows with every stretch of the column ``text`` that ``spans`` cover replaced by ``mark``.

    A stretch begins where no span is open and ends where none is any longer; stretches that only touch stay two.
    Stretches are cut out ``together`` at a time from the part of the text they lie in, so that the text is
    passed over once for that many.
    """
    own = {f"_{name}": name for name in ("starts", "stops", "froms", "tos", "parts")}
    starts, stops, froms, tos, parts = own
    rows = rows.withColumns({starts: _sorted(F.col(spans), "start"), stops: _sorted(F.col(spans), "stop")})

    def idle(x: Column) -> Column:
        return count_below(starts, x) == count_below(stops, x + 1)

    begins = F.array_distinct(F.filter(starts, idle))
    ends = F.array_distinct(F.filter(stops, idle))
    zero, length = F.array(F.lit(0).cast("bigint")), F.array(F.length(text).cast("bigint"))
    rows = rows.withColumns({froms: F.concat(zero, ends), tos: F.concat(begins, length)})
    # what stays lies from froms[i] to tos[i]
    blocks = F.sequence(F.lit(0), F.floor((F.size(froms) - 1) / together).cast("int"))

    def cut(block: Column) -> Column:
        some = F.zip_with(
            F.slice(froms, block * together + 1, F.lit(together)),
            F.slice(tos, block * together + 1, F.lit(together)),
            lambda a, b: F.struct(a.alias("a"), b.alias("b")),
        )
        first = F.element_at(froms, block * together + 1)
        last = F.element_at(tos, F.least((block + 1) * together, F.size(tos)))
        part = F.substr(text, (first + 1).cast("int"), (last - first).cast("int"))
        return F.struct(first.alias("first"), part.alias("part"), some.alias("some"))

    def kept(block: Column) -> Column:
        pieces = F.transform(
            block["some"],
            lambda x: F.substr(block["part"], (x["a"] - block["first"] + 1).cast("int"), (x["b"] - x["a"]).cast("int")),
        )
        return F.array_join(pieces, mark)

    rows = rows.withColumn(parts, F.when(F.size(spans) > 0, F.transform(blocks, cut)))
    done = F.when(F.size(spans) > 0, F.array_join(F.transform(parts, kept), mark)).otherwise(F.col(text))
    return rows.withColumn(text, done).drop(*own)
