"""A cleaning pipeline over documents; each stage is one operator of ``trackline.llm``.

Every stage takes (spark, docs, sf_dir) and all but the last return the columns of ``docs``; "text"
and "n_chars" are those of the cleaned text. Columns beyond the usual five are carried along. Each
stage handles what its operator handles: null and empty texts, repeated rows, empty tables.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from trackline.llm import language, line_dedup, packing, secrets, simhash
from trackline.session import materialized


def _with_text(rows: DataFrame, columns: list[str], text) -> DataFrame:
    """The carried columns of ``rows`` with a new text and its length."""
    new = {"text": text, "n_chars": F.length(text).cast("long")}
    return rows.select(*[new[c].alias(c) if c in new else F.col("carried")[c].alias(c) for c in columns])


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told. What is "und" goes: null texts and texts without a letter."""
    found = language.identify(docs, learn=~language.held_out(), carry=docs.columns)
    return found.where(F.col("lang_pred") != language.UNKNOWN).select("carried.*")


def own_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, less the long lines that three or more share (the largest doc_id keeps its line)."""
    found = line_dedup.dedupe_lines(docs, carry=docs.columns)
    return _with_text(found, docs.columns, F.col("kept"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near duplicates (fingerprints that 2 bits link) one row: least doc_id (null last), then least text.

    Rows, not ids, are chosen: rows without an id and rows that share one are kept where their groups differ. Texts
    without words are one group.
    """
    found = simhash.near_duplicates(docs, words=3, distance=2, carry=docs.columns)
    row = F.col("carried")
    rest = F.to_json(F.struct(*[row[c].alias(c) for c in docs.columns if c not in ("doc_id", "text")]))
    # the digest of the other columns makes the choice among rows with equal doc_id and text determinate
    order = F.struct(row["doc_id"].isNull(), row["doc_id"], row["text"], F.sha2(rest, 256))
    return found.groupBy("component").agg(F.min_by(row, order).alias("carried")).select("carried.*")


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; every stretch that a span of a secret covers is replaced by a mark."""
    found = secrets.scan(docs, carry=docs.columns)
    rows = found.select("carried", F.col("carried.text").alias("text"), F.concat("base", "added").alias("spans"))
    return _with_text(secrets.redacted(rows, "text", "spans"), docs.columns, F.col("text"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens: one row per piece of a document."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language", known_language),
    ("line dedup", own_lines),
    ("near duplicates", one_of_each),
    ("secrets", without_secrets),
    ("packing", pack),
]

# Tokenisation, trained models and connected components have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = materialized(stage(spark, docs, sf_dir))
    return docs
