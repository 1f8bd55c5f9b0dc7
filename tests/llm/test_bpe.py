"""Encoding and decoding against the tokenizers library."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from trackline.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
ODD = [
    "", " \n\t", "aaaaaaa aaaa aaaaab", "<|endoftext|>", "x<|endoftext|>Y <|startoftext|><|endoftext", "don't I'll 'S 's''t",
    "ΣΊΣΥΦΟΣ ΟΔΟΣ.", "İstanbul ǅ é x́ ạ́", "a\x1cb\x1d\x1fc", "a b c　d​x\x85",
    "中文字符 日本語 😀😀 ½ ² ١٢", "\u0000\x01 _ __ ##", "A" * 5000, "ab" * 3000, "'", "it's", "ẞ ﬁ Å",
]


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(PATH)


def library(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def test_odd_texts(encoder):
    assert [x.tolist() for x in encoder.encode_each(ODD)] == [library(x) for x in ODD]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("aabbcé ñ'sßtl.!?12 \nABZΣ<|>"), st.characters(codec="utf-8")), max_size=60), max_size=4))
def test_any_texts(encoder, texts):
    assert [x.tolist() for x in encoder.encode_each(texts)] == [library(x) for x in texts]


def test_forgetting_changes_nothing():
    small = bpe.Encoder(PATH, most=3)
    for _ in range(3):
        assert [x.tolist() for x in small.encode_each(ODD)] == [library(x) for x in ODD]


def test_portions_are_joined_rightly(encoder):
    texts = ODD * 3
    found = [(ids, counts) for ids, counts in encoder.encode(texts, portion=50)]
    flat = np.concatenate([ids for ids, _ in found]).tolist()
    assert flat == [i for t in texts for i in library(t)]
    assert np.concatenate([c for _, c in found]).tolist() == [len(library(t)) for t in texts]


def test_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(bpe, "POWERS", np.zeros(8, np.uint64))  # now all ranges have one hash
    points = np.frombuffer("abxabyab".encode("utf-32-le"), np.uint32)
    first, which = bpe.distinct_ranges(points, np.array([0, 3, 6, 2]), np.array([2, 2, 2, 1]))
    assert which[0] == which[1] == which[2] != which[3] and len(first) == 2


def test_rows(spark):
    rows = [(1, "Hello hello\nworld's <|endoftext|>"), (2, None), (3, ""), (3, ""), (None, "x y"), (5, "word " * 3000)]
    docs = spark.createDataFrame([(k, t, 7, "z") for k, t in rows], "doc_id long, text string, n_tokens int, key string")
    got = bpe.digest_texts(docs, PATH).collect()
    want = []
    for key, text in rows:
        ids = library(text or "")
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), LIBRARY.decode(ids, skip_special_tokens=False))]
        want.append((key, len(ids), *sha))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert got[0].asDict().keys() == {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}
    assert bpe.digest_texts(docs.limit(0), PATH).collect() == []
