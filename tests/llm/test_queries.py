"""Registered queries against their SQL, and the pipeline stage by stage."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from check import connect, differences
from trackline.llm import secrets, simhash
from trackline.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, sf_dir, name):
    got = QUERIES[name](spark, sf_dir).toPandas()
    assert differences(got, connect(sf_dir).sql(ORACLE[name]).df()) is None


def test_every_operator_has_a_query():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 14))


COLUMNS = {
    1: {"page_id", "url", "text", "n_chars"},
    2: {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"},
    3: {"query_id", "rank", "vec_id", "score"},
    4: {"doc_id", "held_out", "score", "predicted"},
    5: {"doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"},
    6: {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    7: {"doc_id", "fingerprint", "component_id"},
    8: {"doc_id", "n_lines", "n_dropped", "kept_sha256"},
    9: {"doc_id", "held_out", "lang_pred", "score"},
    10: {"query_id", "rank", "vec_id", "score"},
    11: {"lang", "rank", "phrase", "a", "l", "r", "n", "score"},
    12: {"word", "form", "root", "n", "n_near", "form_n"},
    13: {"doc_id", "n_shingles", "component_id", "kept"},
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns(spark, sf_dir, name):
    assert set(QUERIES[name](spark, sf_dir).columns) == COLUMNS[int(re.match(r"op(\d+)_", name)[1])]


def rows_of(docs):
    return sorted((tuple(r) for r in docs.collect()), key=repr)


EXTRA = [
    (90_001, None, "en", "s", None), (90_002, "", "en", "s", 0), (90_003, "123 456", None, None, 7), (None, "some words of a text", None, "s", 20), (None, "quite another text without an id", None, "s", 32),
    (90_007, "one id with this text here", "en", "s", 26), (90_007, "but also with that other one", "en", "s", 28),
    (90_004, "twice the same words here", "en", "s", 25), (90_004, "twice the same words here", "en", "s", 25),
    (90_005, "token = abcdef0123456789abcdef0123456789 and words", "en", "s", 50), (90_006, "w" * 200_000, "en", "s", 200_000),
]


def test_stages(spark, sf_dir):
    from test_line_dedup import plain
    from test_secrets import base
    from test_simhash import by_hand, components

    given = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = given.unionByName(spark.createDataFrame(EXTRA, given.schema)).withColumn("score", F.lit(2)).withColumn("kept", F.lit("k"))
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "line dedup", "near duplicates", "secrets", "packing"]

    def after(name, docs):
        out = corpus_pipeline.materialized(stages[name](spark, docs, sf_dir))
        assert out.columns == docs.columns and [t for _, t in out.dtypes] == [t for _, t in docs.dtypes]
        return out

    known = after("language", docs)
    assert rows_of(known) == sorted((r for r in rows_of(docs) if r[1] and any(c.isalpha() for c in r[1])), key=repr)

    unshared = after("line dedup", known)
    want = {(d, kept) for d, _, _, kept in plain([r[:2] for r in rows_of(known)])}
    assert {r[:2] for r in rows_of(unshared)} == want and unshared.count() == known.count()
    assert unshared.where("n_chars <> length(text)").count() == 0

    single = after("near duplicates", unshared)
    rows = rows_of(unshared)
    roots = components([by_hand(r[1], 3) for r in rows], 2)
    least = {}
    for row, root in zip(rows, roots):
        least[root] = min([x for x in (row[0], least.get(root)) if x is not None], default=None)
    assert sorted(map(repr, (r[0] for r in rows_of(single)))) == sorted(map(repr, least.values()))
    assert set(rows_of(single)) <= set(rows)

    clean = after("secrets", single)
    before = [(r[0], r[1]) for r in rows_of(single)]
    assert clean.count() == len(before)
    for row in rows_of(clean):
        assert not base(row[1])
        if (row[0], row[1]) not in before:
            assert "[SECRET]" in row[1] and row[0] in {r[0] for r in before}
    assert "[SECRET]" in {r[0]: r[1] for r in rows_of(clean)}[90_005]

    packed = corpus_pipeline.materialized(stages["packing"](spark, clean, sf_dir))
    whole = F.sum(F.when(F.col("start") == 0, F.col("doc_tokens")))  # a doc_id may have several rows
    sizes = packed.groupBy("doc_id").agg(F.sum("length").alias("n"), whole.alias("d"))
    assert sizes.where("n <> d").count() == 0 and packed.where("start = 0").count() == clean.count()


def test_empty_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialized(stage(spark, docs, sf_dir))
    assert docs.count() == 0


def test_run_reads_documents(spark, sf_dir):
    packed = corpus_pipeline.run(spark, sf_dir)
    assert 0 < packed.select("doc_id").distinct().count() <= spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert secrets.KINDS == ["assign", "access", "hex", "random"] and simhash.BITS == 64
