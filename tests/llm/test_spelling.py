"""Spelling variants against brute force."""

import itertools
import random
import re
import zlib
from collections import Counter

import pytest

from trackline.llm import spelling

A_TO_Z = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def counted(rows, one_in, least):
    found = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(A_TO_Z)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % one_in == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= least}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def by_hand(known):
    others = {w: [] for w in known}
    for a, b in itertools.combinations(known, 2):
        if near(a, b):
            others[a].append(b)
            others[b].append(a)
    form = {}
    for w, found in others.items():
        best = min(found, key=lambda x: (-known[x], x), default=None)
        form[w] = best if best is not None and known[best] >= 2 * known[w] else None
    out = []
    for w in known:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, known[w], len(others[w]), known[form[w]] if form[w] else None))
    return sorted(out)


def run(spark, rows, one_in, least=3, held=1 << 19):
    docs = spark.createDataFrame([(*r, "w", 1) for r in rows], "doc_id long, text string, word string, n int").repartition(3)
    known = spelling.words(docs, one_in=one_in, least=least, held=held)
    return sorted(tuple(r) for r in spelling.variants(known).collect())


def variants_of(rng, letters, size, count):
    out = set()
    while len(out) < count:
        w = [rng.choice(letters) for _ in range(rng.randint(5, size))]
        for _ in range(6):
            out.add("".join(w))
            at, what = rng.randrange(len(w)), rng.randrange(3)
            w[at : at + (what > 0)] = [rng.choice(letters)] if what < 2 else []
            if len(w) < 5:
                break
    return sorted(x for x in out if len(x) >= 4)


@pytest.mark.parametrize("letters", ["ab", "abcé", "abcdefghijklmnopqrstuvwxyzßü"])
def test_all_near_words(spark, letters):
    rng = random.Random(len(letters))
    pool = variants_of(rng, letters, 9, 350)
    texts = [" ".join(rng.choices(pool, k=60)) for _ in range(120)]
    rows = [(i, t if i % 2 else t.title()) for i, t in enumerate(texts)]
    want = by_hand(counted(rows, 7, 2))
    assert sum(r[4] for r in want) > 100 and len({r[2] for r in want}) < len(want)
    assert run(spark, rows, 7, 2) == want
    if len(letters) == 4:
        assert run(spark, rows, 7, 2, held=5) == want


def test_odd_rows(spark):
    rows = [
        (1, None), (2, ""), (3, "1234 -- !?"), (None, "Letter letter LETTER lettre"), (4, "letter_letter×letter"), (4, "letter_letter×letter"),
        (5, "ÉCOLE École école ecole ecole ecole ecole ecole ecole"), (6, "long" * 30_000 + " " + "again " * 20_000), (7, "日本語letters日letters letters"),
    ]
    assert run(spark, rows, 5) == by_hand(counted(rows, 5, 3))
    assert run(spark, rows, 10**12) == by_hand(counted(rows, 10**12, 3))
    assert run(spark, rows[:2], 97) == [] and run(spark, [], 97) == []


def test_pivots_are_the_rarest_disjoint():
    rng = random.Random(4)
    for _ in range(400):
        word = "".join(rng.choices("abcde", k=rng.randint(5, 12)))
        grams = sorted({word[i : i + 2] for i in range(len(word) - 1)})
        rng.shuffle(grams)
        ranks = {g: i for i, g in enumerate(grams)}
        cost = sorted(rng.randrange(50) for _ in grams)
        prefix = spelling.prefix_of(word, ranks)
        assert len(prefix) >= 3 and {r for r, _ in prefix} == set(range(prefix[-1][0] + 1)) & {ranks[g] for g in grams}
        got = spelling.pivots_of(prefix, cost)
        want = min(cost[a[0]] + cost[b[0]] for a, b in itertools.combinations(prefix, 2) if abs(a[1] - b[1]) >= 2)
        assert len(got) == 2 and abs(got[0][1] - got[1][1]) >= 2 and sum(cost[r] for r, _ in got) == want


def test_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    known = {w: n for w, n in spelling.words(docs, one_in=97).collect()}
    assert known == counted([tuple(r) for r in docs.select("doc_id", "text").collect()], 97, 3)
    assert sorted(tuple(r) for r in spelling.variants(spelling.words(docs, one_in=97)).collect()) == by_hand(known)
