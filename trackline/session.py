"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import functools
import math
import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

Result = TypeVar("Result")
MOST_AT_ONCE = 4

# Cluster submissions override any of these with --conf; they are defaults, not requirements.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.legacy.javaCharsets": "true",  # files in encodings other than Unicode
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def session(app: str = "trackline", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def allow_encoding(spark: SparkSession, encoding: str) -> None:
    """Let the files of any session, also one without the defaults, be in an encoding such as GBK.

    The setting stays on, as files are decoded only when their rows are used; all it does is
    lift an error.
    """
    if not is_unicode(encoding):
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")


def is_unicode(encoding: str) -> bool:
    return encoding.lower().startswith("utf")


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    Every executor must see what another one wrote, so the folder named by
    ``spark.checkpoint.dir`` is used. Only where driver and executors are one process
    (a local master) does a temporary folder stand in for a missing one; elsewhere that
    is an error.
    """
    return f"{_checkpoint_root(spark)}/trackline-{uuid.uuid4().hex}"


def materialized(df: DataFrame) -> DataFrame:
    """Write ``df`` to a table in the shared folder and read it back.

    For results that several branches of a plan use: they are computed once, a lost
    executor loses nothing, and the planner knows the true size of what it reads.
    """
    path = f"{scratch_dir(df.sparkSession)}/table"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def side_by_side(work: Sequence[Callable[[], Result]], df: DataFrame) -> list[Result]:
    """What the functions return, each of which runs many jobs over ``df``.

    A job over a table of few parts leaves cores idle, so several functions run at a time; over a
    table whose parts fill the cores twice it is one after the other.
    """
    cores, parts = df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions()
    at_once = min(math.ceil(2 * cores / max(parts, 1)), MOST_AT_ONCE)
    if at_once < 2:
        return [f() for f in work]
    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(lambda f: f(), work))


def _checkpoint_root(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if not configured:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = _local_folder()
    return configured.rstrip("/")


@functools.cache
def _local_folder() -> str:
    return "file:" + tempfile.mkdtemp(prefix="trackline-")
