"""HyperMinHash near duplicates against brute-force Jaccard similarity of shingles."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackline.llm import hyper_minhash
from trackline.llm.hyper_minhash import near_duplicates

A_TO_Z = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
SCHEMA = "doc_id long, text string, size string, row string"


def shingle_set(text, words=4):
    parts = [x for x in (text or "").translate(A_TO_Z).replace("\x1c", "_").split(" ") if x]
    return {tuple(parts[i : i + words]) for i in range(max(len(parts) - words + 1, 1))} if parts else set()


def by_hand(rows, percent=80):
    sets = [shingle_set(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    index = {}
    for i, found in enumerate(sets):
        for s in found:
            index.setdefault(s, []).append(i)
    met = {pair for held in index.values() for pair in itertools.combinations(held, 2)}
    for a, b in met:
        common = len(sets[a] & sets[b])
        if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    names = {}
    for i, (key, _) in enumerate(rows):
        names[find(i)] = min([x for x in (key, names.get(find(i))) if x is not None], default=None)
    return sorted(
        ((key, len(sets[i]), names[find(i)], key == names[find(i)]) for i, (key, _) in enumerate(rows)), key=repr
    )


def run(spark, rows, **how):
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in near_duplicates(docs, **how).collect()), key=repr)


def edited(rng, words, share):
    return " ".join(w if rng.random() >= share else f"n{rng.randrange(10**9)}" for w in words)


@pytest.mark.parametrize("chunks", [{}, {"chunk_rows": 7, "chunk_hashes": 900}])
def test_groups_of_all_similarities(spark, chunks):
    rng = random.Random(3)
    texts = []
    for share in (0.005, 0.01, 0.02, 0.03, 0.04):
        for size in (8, 40, 250):
            words = [f"w{rng.randrange(10**9)}" for _ in range(size)]
            texts += [edited(rng, words, share) for _ in range(12)]
    rows = [(i * 3 % 181, t) for i, t in enumerate(texts)]
    assert run(spark, rows, **chunks) == by_hand(rows)


def test_odd_rows(spark):
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "one two three four"),
        (8, "One Two Three four"), (None, "one two three four"), (None, "alone"), (9, "twice the same row here"),
        (9, "twice the same row here"), (9, "another text of that very id"), (None, None), (10, "É a b c d"), (11, "é a b c d"),
        (12, "long " * 60_000), (13, "long " * 60_000 + "end"),
    ]
    assert run(spark, rows) == by_hand([(k, t if t is None else t.replace("\t", " ").replace("\n", " ")) for k, t in rows])
    assert run(spark, rows[:0]) == []


def test_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plain = docs.select("doc_id", F.regexp_replace("text", r"[\t-\r]", " ")).collect()
    got = sorted((tuple(r) for r in near_duplicates(docs).collect()), key=repr)
    assert got == by_hand([tuple(r) for r in plain])


def test_rows_grow_with_a_group_not_with_its_square(spark):
    """A passage that all share keeps them just below the similarity: every pair is compared, none becomes a row."""
    rng, links = random.Random(5), []
    passage = " ".join(f"p{i}" for i in range(280))
    texts = [f"{passage} {' '.join(f'o{rng.randrange(10**9)}' for _ in range(36))}" for _ in range(1500)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    rows = hyper_minhash.sketched(docs, "doc_id", "text", 4).withColumnRenamed("row", "id").drop("key")
    inside = hyper_minhash.inside
    try:
        hyper_minhash.inside = lambda members, similarity: links.append(inside(members, similarity)) or links[0]
        found = hyper_minhash.connected(docs, "text", 4, rows, 0.8, 512, 1 << 20)
        assert found.count() == 0 and links[0].count() == 0
    finally:
        hyper_minhash.inside = inside


def test_registers_and_correction():
    rng = np.random.default_rng(1)
    x = np.unique(rng.integers(0, 1 << 64, 500, np.uint64))
    got, least = hyper_minhash.registers(x), {}
    for v in map(int, x):
        least[v >> 57] = min(v, least.get(v >> 57, 1 << 64))
    for bucket, v in least.items():
        bits = format(v, "064b")[7:]
        zeros = len(bits) - len(bits.lstrip("0"))
        assert got[bucket] == zeros << 10 | int((bits[zeros + 1 :] + "0" * 80)[:10], 2)
    # registers of unrelated sets agree as often as calculated
    equal = [
        (hyper_minhash.registers(np.sort(rng.integers(0, 1 << 64, 4096, np.uint64))) ==
         hyper_minhash.registers(np.sort(rng.integers(0, 1 << 64, 4096, np.uint64)))).sum() for _ in range(600)
    ]
    assert abs(np.sum(equal) / (600 * 128) - hyper_minhash.chance(12, 12)) < 2e-4
    assert abs(hyper_minhash.estimate(np.array([128]), np.array([5]), np.array([5]))[0] - 1) < 1e-12


def test_intersections():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 300, rng.integers(1, 200)).astype(np.uint64)) for _ in range(40)]
    want = [[len(np.intersect1d(a, b)) for b in sets[:15]] for a in sets]
    for block in (7, 64, 4096):
        assert hyper_minhash.intersections(sets, sets[:15], block).tolist() == want
