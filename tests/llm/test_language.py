"""Language identification on given and on odd rows."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from trackline.llm import language


def test_given_documents(spark, sf_dir):
    docs = spark.read.parquet(sf_dir.replace("sf0.001", "sf0.01") + "/documents.parquet")
    out = language.held_out()
    found = language.identify(docs, learn=~out).withColumn("held_out", out)
    rows = found.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_labels_are_not_used(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = language.held_out()
    lied = docs.withColumn("lang", F.when(out, F.lit("xx")).otherwise(F.col("lang"))).withColumn("source", F.lit("s"))
    one = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(docs, learn=~out).collect()}
    two = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(lied, learn=~out).collect()}
    assert one == two


def test_odd_rows(spark):
    german, english = "der Hund und die Katze schlafen nicht ", "the dog and the cat are not asleep "
    rows = [(i, x * 3 + str(i), y) for i in range(0, 40, 2) for x, y in [(german, "de")]]
    rows += [(i, english * 3 + str(i), "en") for i in range(1, 40, 2)]
    odd = [(100, None, "de"), (101, "", "en"), (102, "123 !? \n", None), (None, german, "en"), (103, "x", None), (103, "x", None), (104, english * 9000, None)]
    docs = spark.createDataFrame([(*r, "l", 0.5) for r in rows + odd], "doc_id long, text string, lang string, lang_pred string, score double")
    got = language.identify(docs, learn=~language.held_out(), carry=["lang", "score", "text"]).collect()
    assert len(got) == len(rows + odd)
    by_key = {r.doc_id: r for r in got}
    assert [by_key[k].lang_pred for k in (100, 101, 102)] == ["und"] * 3 and by_key[100].score == 0
    assert by_key[None].lang_pred == "de" and by_key[104].lang_pred == "en"
    assert by_key[104].carried.text == english * 9000 and by_key[104].carried.score == 0.5 and by_key[100].carried.text is None
    assert all(by_key[k].lang_pred == y for k, _, y in rows)
    assert len([r for r in got if r.doc_id == 103]) == 2


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert [tuple(r) for r in language.identify(docs, learn=F.lit(True)).collect()] == [(1, "und", 0.0)]
    assert language.identify(docs.limit(0), learn=F.lit(True)).collect() == []
    lone = spark.createDataFrame([(1, "text", "eo"), (2, "other", None)], "doc_id long, text string, lang string")
    assert sorted(map(tuple, language.identify(lone, learn=F.lit(True)).collect())) == [(1, "eo", 1.0), (2, "eo", 1.0)]


def test_a_small_sample_is_enough(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = language.identify(docs, learn=F.lit(True), per_language=7).join(docs.select("doc_id", "lang"), "doc_id")
    assert found.where("lang = lang_pred").count() > 0.8 * docs.count() == 0.8 * found.count()


def test_families():
    assert language.family("en") == language.family("de") != language.family("fr")
    assert language.family("qq") == "only qq"
