"""One query per operator, on its whole table with production parameters, and SQL where it can be said in SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from trackline.llm import (
    bpe,
    collision_search,
    exact_search,
    html_text,
    hyper_minhash,
    language,
    line_dedup,
    packing,
    phrases,
    secrets,
    simhash,
    spelling,
    toxicity,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages"))


@query
def op2_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth."""
    return collision_search.search(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, k=10)


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text, learned from labelled documents outside the held-out fifth."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = language.held_out(parts=5, part=0)
    found = toxicity.score(docs, labels, ~held_out)
    return found.withColumn("held_out", held_out)


@query
def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every text: spans of fixed patterns and of random strings."""
    found = secrets.scan(table(spark, sf_dir, "documents"))
    counts = [secrets.count_of(F.col("base"), kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")]
    everything = secrets.joined(F.array_sort(F.concat("base", "added")))
    return found.select(
        "doc_id", *counts, F.sha2(secrets.joined(F.col("base")), 256).alias("base_sha256"), everything.alias("spans")
    )


@query
def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text and the text they decode to, as digests."""
    return bpe.digest_texts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, distance=2)


@query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the long lines that three or more documents share."""
    found = line_dedup.dedupe_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE["op8_line_dedup"] = line_dedup.sql()


@query
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text, learned from documents outside the held-out quarter."""
    held_out = language.held_out()
    found = language.identify(table(spark, sf_dir, "documents"), learn=~held_out)
    return found.withColumn("held_out", held_out)


@query
def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five largest integer inner products of every fiftieth vector."""
    return exact_search.search(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5)


ORACLE["op10_top_k"] = exact_search.sql()


@query
def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of every language."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


ORACLE["op11_phrases"] = phrases.sql()


@query
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words with the more frequent spelling they are close to; one in 97 runs loses a code point, as agreed."""
    return spelling.variants(spelling.words(table(spark, sf_dir, "documents"), one_in=97))


@query
def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of the shingle set, component and whether kept, of every document."""
    return hyper_minhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, similarity=0.8)
