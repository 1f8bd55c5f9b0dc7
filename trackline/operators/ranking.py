"""Ranks, quantiles and exact top-n without sorting everything in one task.

All of these cut the ordered values into buckets, add up the buckets (few rows), and then
look at single values only inside the buckets that matter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackline.operators import slices

HASH_DIGITS = 4
EDGES = 64  # parts at least
PART_ROWS = 1_000_000  # distinct values that one task should sort


def top_by_count(df: DataFrame, key: str, n: int, out: str = "n") -> DataFrame:
    """The ``n`` most frequent values, equal counts in order of the value."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias(out))
    return counts.orderBy(F.desc(out), key).limit(n)


def top_by_group(df: DataFrame, by: Sequence[str], key: str, n: int, out: str = "n") -> DataFrame:
    """The ``n`` most frequent values of each group, equal counts in order of the value."""
    counts = df.groupBy(*by, key).agg(F.count(F.lit(1)).alias(out))
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(out), key))
    return counts.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def hashed_sample(df: DataFrame, key: str, n: int, seed: str = "") -> DataFrame:
    """Exactly ``n`` rows, those with the smallest hash of ``key``.

    ``n`` may be millions: whole hash buckets are taken by their counts, and only the
    bucket in which ``n`` is reached is sorted. A null key has a hash of its own.
    """
    text = F.coalesce(F.concat(F.col(key).cast("string"), F.lit(seed)), F.lit(f"null {seed}"))
    hashed = df.withColumn("_hash", F.md5(text))
    hashed = hashed.withColumn("_bucket", F.substring("_hash", 1, HASH_DIGITS))
    counts = hashed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_count"))
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    ends = counts.withColumn("_before", F.coalesce(F.sum("_count").over(earlier), F.lit(0)))
    placed = hashed.join(F.broadcast(ends), "_bucket")  # at most 16 ** HASH_DIGITS rows
    whole = placed.filter(F.col("_before") + F.col("_count") <= n)
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy("_hash", key))
    partly = (
        placed.filter((F.col("_before") < n) & (F.col("_before") + F.col("_count") > n))
        .withColumn("_rank", rank)
        .filter(F.col("_before") + F.col("_rank") <= n)
        .drop("_rank")
    )
    return whole.unionByName(partly).drop("_hash", "_bucket", "_count", "_before")


def _bucketed(counts: DataFrame, value: str) -> DataFrame:
    """Distinct values with ``_bucket``, parts of about the same number of them.

    There are EDGES parts, or as many as PART_ROWS asks for. Only the edges between the parts
    come to the driver.
    """
    parts = max(EDGES, -(-counts.count() // PART_ROWS))
    levels = [k / parts for k in range(1, parts)]
    edges = counts.agg(F.percentile_approx(value, levels)).first()[0] or []
    below = F.filter(F.array(*map(F.lit, edges)), lambda e: e <= F.col(value))
    return counts.withColumn("_bucket", F.size(below))


def quantiles(df: DataFrame, column: str, at: Sequence[float]) -> DataFrame:
    """Exact quantiles with linear interpolation between neighbours, one row per level."""
    counts = (
        df.select(F.col(column).cast("double").alias("x"))
        .na.drop()
        .groupBy("x")
        .agg(F.count(F.lit(1)).alias("w"))
    )
    bucketed = _bucketed(counts, "x")
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy("_bucket")
        .agg(F.sum("w").alias("_rows"))
        .withColumns(
            {
                "_before": F.coalesce(F.sum("_rows").over(earlier), F.lit(0)),
                "_n": F.sum("_rows").over(Window.partitionBy()),
            }
        )
    )
    last = F.col("_n") - 1
    wanted = F.array(
        *[
            F.struct(
                F.lit(q).alias("level"),
                F.floor(F.lit(q) * last).alias("low"),
                F.ceil(F.lit(q) * last).alias("high"),
                (F.lit(q) * last).alias("position"),
            )
            for q in at
        ]
    )

    def covers(rank: Column, start: Column, rows: Column) -> Column:
        return (rank >= start) & (rank < start + rows)

    def touched(start: Column, rows: Column):
        return lambda q: covers(q["low"], start, rows) | covers(q["high"], start, rows)

    running = F.sum("w").over(
        Window.partitionBy("_bucket").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    )
    start, w = F.col("_start"), F.col("w")
    used = offsets.withColumn("_wanted", wanted).filter(
        F.exists("_wanted", touched(F.col("_before"), F.col("_rows")))
    )
    hits = (
        bucketed.join(F.broadcast(used), "_bucket")  # at most two parts for each quantile
        .withColumn("_start", F.col("_before") + running - w)
        .select("x", "w", "_start", F.explode(F.filter("_wanted", touched(start, w))).alias("q"))
    )

    def value(end: str) -> Column:
        return F.max(F.when(covers(F.col(f"q.{end}"), start, w), F.col("x")))

    low, high = F.col("low"), F.col("high")
    return (
        hits.groupBy(F.col("q.level").alias("level"))
        .agg(
            value("low").alias("low"),
            value("high").alias("high"),
            F.max(F.col("q.position") - F.col("q.low")).alias("part"),
        )
        .select("level", (low + (high - low) * F.col("part")).alias("value"))
    )


def roc_points(df: DataFrame, score: str, truth: str) -> DataFrame:
    """True and false positive rate for every distinct score used as the threshold.

    ``truth`` is 0 or 1.
    """
    steps = df.groupBy(F.col(score).alias("threshold")).agg(
        F.sum(F.col(truth).cast("bigint")).alias("_pos"),
        F.sum(1 - F.col(truth).cast("bigint")).alias("_neg"),
    )
    total = steps.agg(F.struct(F.sum("_pos").alias("pos"), F.sum("_neg").alias("neg"))).scalar()
    falling = _bucketed(steps, "threshold").withColumns(
        {slices.SLICE: -F.col("_bucket"), "_order": -F.col("threshold")}
    )
    for value, out in (("_pos", "tp"), ("_neg", "fp")):
        falling = slices.running_total(falling, [], ["_order"], value, out, slices.SLICE)
    return falling.select(
        "threshold",
        F.try_divide("fp", total["neg"]).alias("fpr"),
        F.try_divide("tp", total["pos"]).alias("tpr"),
    )


def nearest_threshold(roc: DataFrame, to: float = 0.5) -> DataFrame:
    """The ROC point whose threshold is nearest to ``to``, the higher one of two."""
    gap = F.struct(F.abs(F.col("threshold") - to), -F.col("threshold"))
    return roc.agg(F.min_by(F.struct("threshold", "fpr", "tpr"), gap).alias("_p")).select("_p.*")


SKETCH_K = 400  # rank error below one per cent
SKETCH_ERROR = 0.01


def quantile_sketches(
    df: DataFrame, column: str, keys: Sequence[str], *, k: int = SKETCH_K
) -> DataFrame:
    """One mergeable sketch of the values per key, of bounded size; nulls do not count.

    Sketches of days (or any other parts) are kept and merged later, so that quantiles of any
    span need no second look at the rows.
    """
    value = F.col(column).cast("double")
    return df.groupBy(*keys).agg(F.kll_sketch_agg_double(value, F.lit(k)).alias("sketch"))


def sketch_quantiles(
    sketches: DataFrame, at: Sequence[float], keys: Sequence[str] = ()
) -> DataFrame:
    """Per key and level: ``n`` values and ``value``, whose rank is off by SKETCH_ERROR at most."""
    merged = sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch").alias("_all"))
    found = F.array(
        *[
            F.struct(
                F.lit(q).alias("level"),
                F.kll_sketch_get_n_double("_all").alias("n"),
                F.kll_sketch_get_quantile_double("_all", F.lit(q)).alias("value"),
            )
            for q in at
        ]
    )
    return merged.filter(F.kll_sketch_get_n_double("_all") > 0).select(*keys, F.inline(found))
