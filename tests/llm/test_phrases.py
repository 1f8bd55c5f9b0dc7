"""Phrases against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from trackline.llm import phrases

A_TO_Z = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def by_hand(rows, least, top=2000, share=80):
    out = []
    for lang in sorted({r[0] or "und" for r in rows}):
        f = Counter()
        for own, text in rows:
            for piece in re.split("[.,;:!?\n\v\f\r]", (text or "").translate(A_TO_Z) if (own or "und") == lang else ""):
                words = tuple(w for w in re.split("[ \t]", piece) if w)
                f.update(words[i : i + m] for m in (1, 2, 3, 4) for i in range(len(words) - m + 1))
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in found.items():
            longer = (x for x in found if len(x) > len(p) and any(x[i : i + len(p)] == p for i in range(len(x))))
            if any(100 * found[x] >= share * a for x in longer):
                continue
            cuts = [(2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            kept.append((-score, -a, " ".join(p).encode(), left, right))
        n = sum(a for p, a in f.items() if len(p) == 1)
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return out


def run(spark, rows, **how):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "lang string, text string, phrase string, n int").repartition(3)
    return sorted(tuple(r) for r in phrases.collocations(docs, **how).collect())


@pytest.mark.parametrize(
    "how", [{}, {"heavy": 5}, {"filter_bits": 6, "heavy": 9}, {"portion": 300}, {"top": 7, "share": 50}], ids=str
)
def test_all_phrases(spark, how):
    rng = random.Random(8)
    pool = ["a", "b", "The", "of", "É", "é", "new", "york", "x-y", "日本", "\x00"]
    rows = []
    for i in range(160):
        text = "".join(rng.choice(pool) + rng.choice("      \t.,\n!") for _ in range(rng.randrange(60)))
        rows.append((rng.choice(["en", "en", "de", None, "und"]), text if i % 9 else text + " new york city hall is open" * 3))
    want = by_hand(rows, 6, **{k: v for k, v in how.items() if k in ("top", "share")})
    assert len(want) > 20
    assert run(spark, rows, least=6, **how) == want


def test_odd_rows(spark):
    rows = [
        ("en", None), ("en", ""), (None, " .,\n"), ("fr", "one two"), ("fr", "one two"), ("fr", "one two"), ("fr", "one two"),
        ("de", "lang und länger " * 40_000), ("de", "w" * 100_000), ("en", "x. y"), ("en", "x y"), ("en", "x  y"), ("en", "x\ty"),
    ]
    assert run(spark, rows, least=3) == by_hand(rows, 3)
    assert run(spark, rows[:3], least=3) == [] and run(spark, [], least=3) == []


def test_a_stripe_over_many_batches():
    batch = phrases._stripes_of("en", ["a b c", "a c", "a. b"], 1, None, None)
    first = phrases._added_up(phrases._unpacked(batch))
    again = phrases._added_up(phrases.pa.concat_tables([first.slice(0, 1), first.slice(0, 1)]))
    assert again.num_rows == 1 and again["total"][0].as_py() == 2 * first["total"][0].as_py() == 14
    assert [x * 2 for x in first["counts"][0].as_py()] == again["counts"][0].as_py()


def test_bitmap_holds_all(spark):
    found = spark.createDataFrame([("en", "a b"), ("en", "b a"), ("de", "a b c")], "lang string, phrase string")
    bits = phrases.bitmap(found, 20)
    a, b, c = (np.array([phrases.hash_of(x)], np.uint64) for x in (b"a", b"b", b"c"))
    for lang, words, held in (("en", [a, b], True), ("en", [b, a], True), ("de", [a, b], False), ("de", [a, b, c], True)):
        assert phrases.in_bitmap(bits, phrases.phrase_hashes(lang, words))[0] == held
