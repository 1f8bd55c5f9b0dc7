"""Fingerprints, links and components against brute force."""

import itertools
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from trackline.llm import simhash
from trackline.llm.components import stars

A_TO_Z = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
BLANKS = " \t\n\v\f\r"


def by_hand(text, words):
    text, parts, word = (text or "").translate(A_TO_Z), [], ""
    for c in text + " ":
        if c in BLANKS:
            parts += [word] if word else []
            word = ""
        else:
            word += c
    if not parts:
        return 0
    shingles = [" ".join(parts[i : i + words]) for i in range(len(parts) - words + 1)] or [" ".join(parts)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, distance):
    """Least index of each print's component."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(prints)), 2):
        if (prints[a] ^ prints[b]).bit_count() <= distance:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return [find(x) for x in range(len(prints))]


@pytest.mark.parametrize("text", [None, "", " \n\t", "One", "one TWO", "É É é a b c\x1cd", "a b c d a b c d", "x " * 70_000])
@pytest.mark.parametrize("words", [3, 5])
def test_fingerprint(text, words):
    assert simhash.fingerprint(text, words) == by_hand(text, words)


def test_hash_is_that_of_spark(spark):
    row = spark.sql("SELECT xxhash64('a b c') AS h").first()
    assert row.h % 2**64 == xxhash.xxh64(b"a b c", seed=42).intdigest()


def clustered(seed, clusters, each, flips):
    """Prints around centres, some a chain away from each other."""
    rng = random.Random(seed)
    out = {0}
    for _ in range(clusters):
        centre = rng.getrandbits(64)
        for _ in range(each):
            out.add(centre ^ sum({1 << rng.randrange(64) for _ in range(rng.randint(0, flips))}))
    return sorted(out)


@pytest.mark.parametrize(("distance", "bucket"), [(2, 512), (2, 40), (3, 40), (1, 512)])
def test_links_lose_no_link(spark, distance, bucket):
    prints = clustered(1, 4, 60, 3) + [2**64 - 1, 2**63]
    table = spark.createDataFrame([(p - 2**64 if p >> 63 else p,) for p in prints], "print long")
    found = simhash.links(table, distance, bucket).collect()
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in found:
        a, b = a % 2**64, b % 2**64
        assert a != b
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    assert [find(p) for p in prints] == [prints[i] for i in components(prints, distance)]


def test_rows(spark):
    base = "the quick brown fox jumps over the lazy dog and runs far away from all of it " * 40
    rows = [(9, base), (4, base), (4, base), (7, base + "now"), (1, None), (2, " \n"), (None, "alone here"), (None, base), (30, "alone here")]
    docs = spark.createDataFrame([(k, t, 1, "c") for k, t in rows], "doc_id long, text string, print int, component_id string")
    got = simhash.near_duplicates(docs)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    prints = [by_hand(t, 3) for _, t in rows]
    roots = components(prints, 2)
    least = {r: min((k for (k, _), x in zip(rows, roots) if x == r and k is not None), default=None) for r in roots}
    want = [(k, f"{p:016x}", least[r]) for (k, _), p, r in zip(rows, prints, roots)]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert simhash.near_duplicates(docs.limit(0)).collect() == []


def test_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    prints = [by_hand(t, 3) for _, t in rows]
    roots = components(prints, 2)
    least = {}
    for (key, _), root in zip(rows, roots):
        least[root] = min(key, least.get(root, key))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == {k: (f"{p:016x}", least[r]) for (k, _), p, r in zip(rows, prints, roots)}


def test_allotment_is_the_cheapest():
    rng = random.Random(2)
    for _ in range(50):
        costs = [{t: float(rng.randrange(100)) for t in (-1, 0, 1)} for _ in range(rng.randint(1, 5))]
        total = rng.randint(-len(costs), len(costs))
        cost, chosen = simhash.allot(costs, total)
        every = [c for c in itertools.product((-1, 0, 1), repeat=len(costs)) if sum(c) == total]
        assert sum(chosen) == total and cost == sum(c[t] for c, t in zip(costs, chosen))
        assert cost == min(sum(c[t] for c, t in zip(costs, e)) for e in every)


def test_bits_that_vary_together_share_a_group(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(400):
        p = rng.getrandbits(64)
        for bit in range(10, 30, 2):  # 40 to 49 repeat these
            copy = 40 + (bit - 10) // 2
            p = p & ~(1 << copy) | (p >> bit & 1) << copy
        rows.append((p - 2**64 if p >> 63 else p,))
    table = spark.createDataFrame(rows, "print long")
    groups = simhash.bit_groups(simhash._together(table), len(rows), 2)
    assert sorted(b for g in groups for b in g) == list(range(64)) and [len(g) for g in groups] == [32, 32]
    apart = sum(any((10 + 2 * i in g) != (40 + i in g) for g in groups) for i in range(10))
    assert apart <= 1


def test_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, x) for x in range(101, 160)] + [(200, 201), (201, 200), (5, 5)]
    got = dict(map(tuple, stars(spark.createDataFrame(edges, "a int, b int")).collect()))
    assert got == {i: 0 for i in range(1, 41)} | {x: 100 for x in range(101, 160)} | {201: 200}
    assert stars(spark.createDataFrame([], "a int, b int")).where(F.lit(True)).collect() == []
