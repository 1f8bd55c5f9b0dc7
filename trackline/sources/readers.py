"""Reading tables and files. Every schema is declared; nothing is inferred from data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackline.session import allow_encoding

# Place of each field in a record of the state feed (fixed values).
STATE_FIELDS = {
    "id": (0, "string"),
    "callsign": (1, "string"),
    "lon": (5, "double"),
    "lat": (6, "double"),
    "baro_altitude": (7, "double"),
    "on_ground": (8, "boolean"),
    "bearing": (10, "double"),
    "alt": (13, "double"),
}
BAD_LINE = "_bad_line"


def read_table(spark: SparkSession, *paths: str, fmt: str = "parquet") -> DataFrame:
    """Files that carry their schema, all paths in one scan.

    Parquet and ORC come with Spark; "avro" and "delta" work where their package is on the
    class path.
    """
    return spark.read.format(fmt).load(list(paths) if len(paths) > 1 else paths[0])


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: str,
    *,
    spread: int | None = None,
    encoding: str = "UTF-8",
    multi_line: bool = False,
) -> DataFrame:
    """CSV with a header line; globs and gzip allowed.

    Texts with line breaks need ``multi_line``. With it, or if it is gzip, a file is read by one
    task however large it is; ``spread`` deals its rows out to that many partitions.
    """
    allow_encoding(spark, encoding)
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("encoding", encoding)
        .option("multiLine", multi_line)
        .csv(paths)
    )
    return rows.repartition(spread) if spread else rows


def read_dirty_csv(spark: SparkSession, paths: str | Sequence[str], schema: str) -> DataFrame:
    """Like ``read_csv``, and ``_bad_line`` holds the text of lines that do not fit the schema."""
    return (
        spark.read.schema(f"{schema}, {BAD_LINE} STRING")
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BAD_LINE)
        .csv(paths)
    )


def good_lines(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col(BAD_LINE).isNull()).drop(BAD_LINE)


def read_json_records(
    spark: SparkSession, paths: str | Sequence[str], schema: str, *, array: bool = False
) -> DataFrame:
    """JSON records, one per line, or with ``array`` one array of records per file."""
    return spark.read.schema(schema).option("multiLine", array).json(paths)


def parse_json(df: DataFrame, column: str, schema: str) -> DataFrame:
    """Replace a JSON text column by its fields."""
    others = [c for c in df.columns if c != column]
    return df.select(*others, F.from_json(column, schema).alias("_json")).select(
        *others, "_json.*"
    )


def parse_states(df: DataFrame, column: str) -> DataFrame:
    """One row per aircraft of state feed responses, those with a position and a call sign.

    A response holds arrays of values without names.
    """
    response = F.from_json(column, "states array<array<string>>")
    others = [c for c in df.columns if c != column]
    states = df.select(*others, F.explode(response["states"]).alias("_state"))
    fields = [
        F.get("_state", F.lit(place)).try_cast(kind).alias(name)
        for name, (place, kind) in STATE_FIELDS.items()
    ]
    return states.select(*others, *fields).filter("lon IS NOT NULL AND callsign <> ''")


def file_census(spark: SparkSession, path: str) -> DataFrame:
    """Number of files below a folder and their bytes; the contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.agg(F.count("path").alias("files"), F.sum("length").alias("bytes"))
