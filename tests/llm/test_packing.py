"""Packing: every token in exactly one piece, gapless sequences, little padding."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from trackline.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def check(rows, pieces, size, end_id=1):
    """Pieces must rebuild all rows' ids, and sequences be gapless and within size; the tokens and sequences."""
    left = defaultdict(list)
    for p in pieces:
        left[p.doc_id].append(p)
    total = 0
    for key in {k for k, _ in rows}:
        wanted = sorted([*LIBRARY.encode(t or "", add_special_tokens=False).ids, end_id] for k, t in rows if k == key)
        own = sorted(left.pop(key), key=lambda p: (p.doc_tokens, p.start, p.ids))
        got = []
        for ids in wanted:  # rows of one key: take pieces that continue the ids
            at = 0
            while at < len(ids):
                raw = np.array(ids[at:], "<u4").tobytes()
                p = next(p for p in own if p.start == at and p.doc_tokens == len(ids) and raw.startswith(bytes(p.ids)))
                assert p.length == len(p.ids) // 4 and p.ids_crc32 == zlib.crc32(bytes(p.ids))
                own.remove(p)
                at += p.length
            got.append(at)
            total += at
        assert not own
    assert not left
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append(p)
    for own in sequences.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= size
    return total, len(sequences)


@pytest.mark.parametrize(("partitions", "windows", "fan_in"), [(1, 4, 2), (9, 3, 2), (6, 16, 32)])
def test_round_trip(spark, sf_dir, partitions, windows, fan_in):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(partitions)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    pieces = packing.pack(docs, PATH, size=256, open_windows=windows, fan_in=fan_in, with_ids=True).collect()
    total, sequences = check(rows, pieces, 256)
    # at most min_piece - 1 of a full window are padded, and the last windows
    assert sequences * 256 - total <= sequences * 15 + windows * 256


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "same text"), (3, "same text"), (3, "other"), (None, "nobody's"), (7, "long " * 5000)]
    docs = spark.createDataFrame([(k, t, 1, 2) for k, t in rows], "doc_id long, text string, start int, key int")
    found = packing.pack(docs, PATH, with_ids=True)
    assert found.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
    check(rows, found.collect(), 2048)
    assert packing.pack(docs.limit(0), PATH).collect() == []


def test_best_fit():
    packer = packing.Packer(size=10, open_windows=2, min_piece=3, first_id=0)
    for doc, n in enumerate([6, 7, 3, 8]):
        packer.add(doc, n, 0, np.arange(n))
    # 6 and 7 open a window each, 3 fits best beside 7; 8 fits nowhere and cannot open a third
    first = [(r[0], r[1], len(r[2]), r[4]) for r in packer.out]
    assert first == [(1, 0, 7, 0), (2, 0, 3, 0)]
    packer.add(4, 9, 0, np.arange(9))
    assert [(r[0], len(r[2])) for r in packer.out][2:] == [(3, 8)]  # padded: less than min_piece is missing
