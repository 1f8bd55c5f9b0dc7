"""The factorisation machine and its query."""

import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from trackline.llm import language, toxicity


def test_pairs_count_not_terms():
    """Either word alone is harmless, both together are not: no additive weights can say so."""
    rng = random.Random(1)
    rows, labels = [], []
    for a, b in itertools.product((0, 1), repeat=2):
        for _ in range(400):
            words = [f"w{rng.randrange(50)}" for _ in range(6)] + ["you"] * a + ["vermin"] * b
            rows.append(np.array(toxicity.terms(" ".join(words)), np.int64))
            labels.append(float(a == b))  # both or none
    machine = toxicity.fit(rows, np.array(labels), epochs=60, sparse=1e-4, positive=1.0)
    found = machine.scores(np.concatenate(rows), np.array([len(r) for r in rows]))
    assert ((found >= 0.5) == (np.array(labels) == 1)).mean() > 0.97


def test_sums_are_those_of_all_pairs():
    rng = np.random.default_rng(2)
    weights, vectors = rng.normal(size=9), rng.normal(size=(9, 3))
    rows = [np.array([1, 4, 8]), np.array([], int), np.array([2])]
    machine = toxicity.Machine(0.3, weights, vectors)
    got = machine.scores(np.concatenate(rows).astype(int), np.array([3, 0, 1]))
    want = [
        1 / (1 + np.exp(-(0.3 + weights[r].sum() + sum(vectors[a] @ vectors[b] for a, b in itertools.combinations(r, 2)))))
        for r in rows
    ]
    assert np.allclose(got, want)


def test_held_out_accuracy(spark, sf_dir):
    folder = sf_dir.replace("sf0.001", "sf0.1")
    docs, labels = (spark.read.parquet(f"{folder}/{x}.parquet") for x in ("documents", "labels"))
    out = language.held_out(parts=5, part=0)
    found = toxicity.score(docs, labels, ~out)
    assert found.count() == docs.count()
    rows = found.join(labels, "doc_id").where(out).select("score", "predicted", "toxic").collect()
    toxic = np.array([r.score for r in rows if r.toxic == 1])
    clean = np.array([r.score for r in rows if r.toxic == 0])
    assert (toxic[:, None] > clean).mean() > 0.95  # area under the curve
    assert (clean >= 0.5).mean() < 0.01


def test_odd_rows(spark):
    rows = [(i, "you are a fool" if i % 3 == 0 else "what a fine day") for i in range(60)]
    rows += [(100, None), (101, ""), (102, "?!"), (None, "you fool"), (103, "fine day"), (103, "fine day"), (104, "fool " * 50_000)]
    docs = spark.createDataFrame([(k, t, 2.0, "x") for k, t in rows], "doc_id long, text string, score double, key string")
    labels = spark.createDataFrame(
        [(i, int(i % 3 == 0)) for i in range(60)] + [(None, 1), (7, None), (8, 9), (500, 1)], "doc_id long, toxic int"
    )
    got = toxicity.score(docs, labels, F.lit(True))
    assert got.columns == ["doc_id", "score", "predicted"]
    found = got.collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    assert all(r.predicted == (r.doc_id % 3 == 0) for r in found if r.doc_id is not None and r.doc_id < 60)
    assert toxicity.score(docs.limit(0), labels, F.lit(True)).collect() == []
    assert {r.score for r in toxicity.score(docs, labels.limit(0), F.lit(True)).collect()} == {0.0}
