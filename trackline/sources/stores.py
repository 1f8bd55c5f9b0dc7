"""Tables that are written once for many later reads: bucketed by key, or cut by time."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from trackline.operators.tracks import TRIP

BUCKETS = 64  # for a large table: so many that a bucket fits into a task
SLICE_SECONDS = 3600
SLICE = "slice"


def write_bucketed(
    df: DataFrame, path: str, *, keys: Sequence[str] = TRIP, buckets: int = BUCKETS
) -> DataFrame:
    """Write ``df`` as a table bucketed and sorted by ``keys``, and return that table.

    Such tables meet on these keys without a shuffle on their side, as often as needed, if they
    have the same number of buckets. There is one file per bucket.
    """
    name = _fresh_name()
    (
        df.repartition(buckets, *keys)
        .write.format("parquet")
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .option("path", path)
        .saveAsTable(name)
    )
    return df.sparkSession.table(name)


def open_bucketed(
    spark: SparkSession,
    path: str,
    schema: StructType,
    *,
    keys: Sequence[str] = TRIP,
    buckets: int = BUCKETS,
) -> DataFrame:
    """The table that another session wrote with ``write_bucketed``."""
    name, by = _fresh_name(), ", ".join(f"`{k}`" for k in keys)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet "
        f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def _fresh_name() -> str:
    return f"trackline_{uuid.uuid4().hex}"


def write_time_slices(
    points: DataFrame,
    path: str,
    *,
    t: str = "t",
    seconds: int = SLICE_SECONDS,
    parts: int = 1,
    cluster: Sequence[str] = ("entity",),
) -> None:
    """Write points in one folder per slice of time, sorted by ``cluster`` and time inside.

    A slice has ``parts`` files at most, so that a busy one is not written by one task.
    """
    part = F.pmod(F.xxhash64(*cluster, t), F.lit(parts).cast("bigint"))
    (
        points.withColumn(SLICE, F.floor(F.col(t) / seconds))
        .repartition(SLICE, part)
        .sortWithinPartitions(SLICE, *cluster, t)
        .write.partitionBy(SLICE)
        .parquet(path)
    )


def read_between(
    spark: SparkSession,
    path: str,
    first: float,
    last: float,
    *,
    t: str = "t",
    seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """The stored points from one time to another, both included; other slices are not read."""
    slices = F.col(SLICE).between(int(first // seconds), int(last // seconds))
    points = spark.read.parquet(path).filter(slices)
    return points.filter(F.col(t).between(first, last)).drop(SLICE)
