"""Nearest neighbours and exact top-k against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackline.llm import collision_search, exact_search
from trackline.llm.vectors import best

SCHEMA = "vec_id long, embedding array<float>, rank int, id string, v int"
ODD = [
    (1000, None), (1001, [0.0] * 8), (1002, [1.0, None] + [0.0] * 6), (1003, [math.nan] + [1.0] * 7), (1004, [math.inf] + [0.0] * 7),
    (None, [1.0] * 8), (1005, []), (1100, [1.0, 2.0]), (1200, [1.0, 3.0]),
]


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], SCHEMA)


def vectors(n, seed, dim=8):
    rng = np.random.default_rng(seed)
    return [(int(i), [float(np.float32(x)) for x in v]) for i, v in enumerate(rng.normal(size=(n, dim)))]


def brute(rows, every, k, cost, zero):
    """Items with all their vectors; the best of them counts."""
    items = {}
    for i, v in rows:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v) or not (zero or any(v)):
            continue
        items.setdefault(i, []).append(np.array(v, float))
    out = {}
    for q, own in items.items():
        if q % every == 0:
            found = []
            for i, theirs in items.items():
                costs = [cost(a, b) for a in own for b in theirs if len(a) == len(b) and i != q]
                if costs:
                    found.append((min(costs), i))
            if found:
                out[q] = sorted(found)[:k]
    return out


def distance(a, b):
    return float(np.sqrt(((b - a) ** 2).sum()))


def minus_product(a, b):
    return -int(sum(int(x) * int(y) for x, y in zip(np.floor(256 * a), np.floor(256 * b))))


def lists(found, sign=1):
    out = {}
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((sign * r.score, r.vec_id))
        assert r["rank"] == len(out[r.query_id])
    return out


@pytest.mark.parametrize("shard_rows", [100_000, 70])
def test_top_k_is_exact(spark, shard_rows):
    rows = vectors(300, 1) + ODD + [(7, [0.5] * 8), (7, [0.5] * 8), (50, [0.1] * 8)] + [(400 + i, [0.25] * 8) for i in range(30)]
    found = exact_search.search(table(spark, rows), F.col("id") % 50 == 0, k=5, shard_rows=shard_rows, block_rows=5)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert lists(found, -1) == brute(rows, 50, 5, minus_product, zero=True)


def test_products_beyond_doubles(spark):
    rows = [(0, [3e8, 1.0]), (1, [3e8, 2.0]), (2, [3e8, 1.0]), (3, [3e30, 1.0]), (50, [-3e30, 0.0])]
    got = lists(exact_search.search(table(spark, rows), F.col("id") % 50 == 0, k=5), -1)
    big = exact_search.LONGEST
    want = brute(rows, 50, 5, lambda a, b: max(-big, min(big, minus_product(a, b))), zero=True)
    assert got == want


def test_nearest_few_rows_are_exact(spark):
    rows = vectors(60, 2) + ODD + [(i, [1.0] * 8) for i in range(200, 206)] + [(100, [9.0] * 8), (100, [1.0] * 8)]
    found = collision_search.search(table(spark, rows), F.col("id") % 100 == 0, k=10, shard_rows=20)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    want = brute(rows, 100, 10, distance, zero=False)
    got = lists(found)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for _, i in got[q]] == [i for _, i in want[q]]
        assert np.allclose([c for c, _ in got[q]], [c for c, _ in want[q]], rtol=1e-15)


def test_recall(spark, sf_dir):
    vectors_table = spark.read.parquet(sf_dir.replace("sf0.001", "sf0.01") + "/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in vectors_table.collect()]
    got = lists(collision_search.search(vectors_table, F.col("id") % 20 == 0, k=10))
    want = brute(rows, 20, 10, distance, zero=False)
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.95


def test_fewer_are_verified_than_there_are():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 32))
    rows = np.repeat(centres, 50, axis=0) + rng.normal(scale=0.05, size=(2000, 32))
    index = collision_search.CollisionIndex(np.arange(2000), rows, 128, 5)
    verified = []
    index._verified = lambda query, checked, ids, distances, k: (
        verified.append(len(checked)) or collision_search.CollisionIndex._verified(index, query, checked, ids, distances, k)
    )
    list(index.search(np.arange(0, 2000, 100), rows[::100], 10, 2.0, 24, 1.2))
    assert sum(verified) < 20 * 2000 / 4


def test_no_rows(spark):
    empty = table(spark, [(1, None)]).limit(0)
    assert exact_search.search(empty, F.col("id") % 50 == 0).collect() == []
    assert collision_search.search(empty, F.col("id") % 50 == 0).collect() == []
    assert exact_search.search(table(spark, ODD[:6]), F.col("id") % 50 == 0).count() == 0


def test_best_counts_an_id_once():
    ids, costs = best(np.array([3, 3, 3, 3, 3, 1, 2]), np.array([1, 1, 1, 1, 1, 1, 0.5]), 2)
    assert ids.tolist() == [2, 1] and costs.tolist() == [0.5, 1]
