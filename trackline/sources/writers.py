"""Writing results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from trackline.session import allow_encoding, is_unicode


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


def write_csv(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    encoding: str = "UTF-8",
    compression: str = "none",
) -> None:
    """CSV with a header line per file, perhaps as gzip; ``mode="append"`` adds files to a folder.

    White space at the ends of texts is kept. A character that an ``encoding`` outside Unicode,
    such as GBK, does not have is an error; Spark itself would write a question mark.
    """
    if not is_unicode(encoding):
        allow_encoding(df.sparkSession, encoding)
        texts = [field.name for field in df.schema if isinstance(field.dataType, StringType)]
        df = df.withColumns({c: F.decode(F.encode(f"`{c}`", encoding), encoding) for c in texts})
    (
        df.write.mode(mode)
        .option("header", True)
        .option("encoding", encoding)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path, compression=compression)
    )


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON record per line, nulls kept."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def json_text(df: DataFrame, out: str = "json") -> DataFrame:
    """Each row as JSON text."""
    return df.select(F.to_json(F.struct(*df.columns)).alias(out))
