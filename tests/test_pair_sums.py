"""Sums of edit distances in blocks, and the main trip of routes that rounds do not thin out."""

import random

import numpy as np
import pyarrow as pa
import pytest

from test_brute_force import levenshtein
from trackline.operators import medoid, pair_sums

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def texts(rng, n, longest, letters):
    return ["".join(rng.choices(letters, k=rng.randint(0, longest))) for _ in range(n)]


def mixed(seed):
    """Short and long ones, at the borders of words, and empty ones."""
    rng = random.Random(seed)
    some = texts(rng, 20, 9, "abcd") + texts(rng, 25, 20, LETTERS) + texts(rng, 8, 70, "abcde")
    return some + texts(rng, 5, 300, LETTERS) + ["a" * n for n in (0, 8, 16, 32, 63, 64, 65, 128, 129)] + ["日é" * 20]


def sequences(*sides, weights):
    return [pair_sums.Sequences(*found, w) for found, w in zip(pair_sums.numbered(sides), weights)]


@pytest.mark.parametrize("table_bytes", [pair_sums.TABLE_BYTES, 0])
@pytest.mark.parametrize("step_bytes", [pair_sums.STEP_BYTES, 1])
def test_sums_of_distances(monkeypatch, table_bytes, step_bytes):
    monkeypatch.setattr(pair_sums, "TABLE_BYTES", table_bytes)
    monkeypatch.setattr(pair_sums, "STEP_BYTES", step_bytes)
    a, b = mixed(1), mixed(2)[:30]
    wa, wb = (np.arange(len(x)) % 5 + 1 for x in (a, b))
    one, other = sequences(a, b, weights=(wa, wb))
    apart = np.array([[levenshtein(x, y) for y in b] for x in a])
    here, there = pair_sums.across(one, other)
    assert here.tolist() == (apart @ wb).tolist() and there.tolist() == (wa @ apart).tolist()
    apart = np.array([[levenshtein(x, y) for y in a] for x in a])
    assert pair_sums.within(one).tolist() == (apart @ wa).tolist()


def test_wide_codes_of_a_block():
    codes = [medoid.WIDE + medoid.WIDE.join(c) for c in (["1,1", "2,2"], ["2,2"], ["3,3", "1,1", "2,2"])]
    table = pa.table(
        {
            "route": ["r"] * 3,
            "code": codes,
            "w": pa.array([1, 2, 1], pa.int64()),
            "_open": [True] * 3,
            **{c: pa.array([0] * 3, pa.int64()) for c in ("_block", "_one", "_two")},
            "_mixed": [False] * 3,
        }
    )
    assert pair_sums.of_blocks(["route"], medoid.WIDE)(table)["total"].to_pylist() == [3, 3, 5]


def expected(trips):
    totals = [0] * len(trips)
    for a in range(len(trips)):
        for b in range(a):
            if trips[a][0] == trips[b][0]:
                d = levenshtein(trips[a][2], trips[b][2])
                totals[a] += d
                totals[b] += d
    best = {}
    for (route, *_), t in zip(trips, totals):
        best[route] = min(t, best.get(route, t))
    return {(k, t) for (route, k, _), t in zip(trips, totals) if t == best[route]}


def alike(seed, n):
    rng = random.Random(seed)
    found = []
    for k in range(n):
        code = [c for c in LETTERS[:14] if rng.random() > 0.2]
        if k % 6 == 0:
            rng.shuffle(code)
        found.append("".join(code) or "a")
    return found


@pytest.mark.parametrize("measured, block", [(medoid.MEASURED, 40), (10, medoid.BLOCK), (0, 40)])
def test_rounds_and_blocks_agree(spark, monkeypatch, measured, block):
    monkeypatch.setattr(medoid, "BLOCK", block)
    monkeypatch.setattr(medoid, "SMALL_ROUTE", 12)
    rng = random.Random(5)
    apart = ["".join(rng.sample(LETTERS, 9)) for _ in range(130)]
    trips = [("alike", k, c) for k, c in enumerate(alike(6, 150))]
    trips += [("apart", 1000 + k, c) for k, c in enumerate(apart)]
    trips += [("few", 2000 + k, c) for k, c in enumerate(alike(7, 10))] + [("one", 3000, "abc")]
    df = spark.createDataFrame(trips, "route string, id int, code string")
    got = medoid.route_medoid(df, route=["route"], pivots=4, measured=measured)
    assert {(r.id, r.total) for r in got.collect()} == expected(trips)


def test_no_rounds_where_all_trips_are_equally_far_apart(spark):
    """Each round is several jobs, and rounds rule out hardly any of such trips."""
    rng = random.Random(9)
    trips = [("r", k, "".join(rng.sample(LETTERS, 12))) for k in range(400)]
    df = spark.createDataFrame(trips, "route string, id int, code string")
    log = []
    got = medoid.route_medoid(df, route=["route"], log=log)
    assert {(r.id, r.total) for r in got.collect()} == expected(trips)
    assert log == [400 * 399 // 2]
