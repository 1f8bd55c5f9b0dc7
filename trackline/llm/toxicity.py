"""Toxicity scores from a factorisation machine over hashed terms.

The score of a text is the logistic function of a bias, a weight for each of its terms, and for each
pair of its terms the product of two short vectors. So a pair of terms, each harmless alone, can
count, which additive weights cannot express. Terms are hashed words and beginnings of words; a term
takes part if it occurs in at least ``least`` documents of the sample. The machine is fitted in one task on a
bounded, documented sample (``sample`` labelled rows, those with the smallest hash of their key) and
applied to every whole text.

Null texts count as empty. A text without known terms gets the bias' score. Rows with a null key or
label, and labels other than 0 and 1, are not learned from; a key with several labels gives several
rows. With nothing to learn from, every score is 0. Repeated rows are scored one by one. Other columns
are not carried. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from trackline.llm.bpe import portions

WIDTH = 1 << 18  # hashed terms
FOLD = bytes(b if chr(b).isalnum() or b >= 128 else 32 for b in range(256))


def terms(text: str | None, stem: int = 5) -> list[int]:
    """Distinct hashed words of a text and beginnings of its longer words, as bytes.

    Blanks and punctuation of ASCII end a word.
    """
    words = set((text or "").lower().encode("utf-8").translate(FOLD).split())
    words |= {b"^" + w[:stem] for w in words if len(w) > stem}
    return list({zlib.crc32(w) % WIDTH for w in words})


class Machine:
    """Bias, weights and vectors; terms that take no part have zeros."""

    def __init__(self, bias: float, weights: np.ndarray, vectors: np.ndarray):
        self.bias, self.weights, self.vectors = bias, weights, vectors

    def scores(self, flat: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Scores of rows that have ``counts`` of the terms in ``flat`` each."""
        linear, mixed, _ = _sums(flat, counts, self.weights, self.vectors)
        return _logistic(self.bias + linear + mixed)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _sums(flat: np.ndarray, counts: np.ndarray, weights: np.ndarray, vectors: np.ndarray):
    """Per row the sum of its terms' weights, the sum over its pairs of terms, and the sum of vectors."""
    borders = np.cumsum(counts) - counts
    some = counts > 0
    linear = np.zeros(len(counts))
    total = np.zeros((len(counts), vectors.shape[1]))
    squares = np.zeros(len(counts))
    if some.any():
        own = vectors[flat]
        linear[some] = np.add.reduceat(weights[flat], borders[some])
        total[some] = np.add.reduceat(own, borders[some], axis=0)
        squares[some] = np.add.reduceat((own * own).sum(1), borders[some])
    return linear, ((total * total).sum(1) - squares) / 2, total


def fit(
    rows: list[np.ndarray],
    labels: np.ndarray,
    rank: int = 4,
    least: int = 5,
    epochs: int = 15,
    batch: int = 256,
    rate: float = 0.15,
    sparse: float = 2e-3,
    positive: float = 3.0,
) -> Machine:
    """Adaptive gradient steps on the logistic loss, each followed by a pull to zero of size ``sparse``.

    The pull leaves weights and vectors of terms that tell nothing at zero, so that long texts do not
    drift with their many ordinary words. ``positive`` is the weight of a row with label 1.
    """
    flat = np.concatenate(rows) if rows else np.empty(0, np.int64)
    counts = np.bincount(flat, minlength=WIDTH)
    rows = [r[counts[r] >= least] for r in rows]
    rng = np.random.default_rng(11)
    used = np.flatnonzero(counts >= least)
    weights, vectors = np.zeros(WIDTH), np.zeros((WIDTH, rank))
    vectors[used] = rng.normal(0, 0.01, (len(used), rank))
    share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    bias, seen_bias = float(np.log(share / (1 - share))), 1e-2
    seen_weights, seen_vectors = np.full(WIDTH, 1e-6), np.full((WIDTH, rank), 1e-6)
    importance = np.where(labels == 1, positive, 1.0)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for begin in range(0, len(rows), batch):
            at = order[begin : begin + batch]
            sizes = np.array([len(rows[i]) for i in at])
            flat = np.concatenate([rows[i] for i in at]).astype(np.int64)
            linear, mixed, total = _sums(flat, sizes, weights, vectors)
            error = (_logistic(bias + linear + mixed) - labels[at]) * importance[at] / len(at)
            slope = error.sum()
            seen_bias += slope**2
            bias -= rate * slope / np.sqrt(seen_bias)
            if not len(flat):
                continue
            touched, where = np.unique(flat, return_inverse=True)
            each = np.repeat(error, sizes)
            weights[touched] = _step(weights, seen_weights, touched, np.bincount(where, each), rate, sparse)
            pulls = [
                np.bincount(where, each * (np.repeat(total[:, f], sizes) - vectors[flat, f])) for f in range(rank)
            ]
            vectors[touched] = _step(vectors, seen_vectors, touched, np.stack(pulls, axis=1), 0.3 * rate, sparse)
    return Machine(bias, weights, vectors)


def _step(values, seen, touched, slope, rate, sparse) -> np.ndarray:
    seen[touched] += slope**2
    size = rate / np.sqrt(seen[touched])
    moved = values[touched] - size * slope
    return np.sign(moved) * np.maximum(np.abs(moved) - size * sparse, 0)


def train(
    docs: DataFrame, labels: DataFrame, learn: Column, key: str, text: str, label: str, sample: int
) -> Machine | None:
    """The machine for the sample; ``learn`` is a condition on the columns of ``labels``."""
    known = labels.where(learn & F.col(key).isNotNull() & F.col(label).isin(0, 1))
    order = F.xxhash64(F.col(key).cast("string"), F.lit("sample"))
    drawn = known.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"), order.alias("order"))
    drawn = drawn.orderBy("order", "key", "label").limit(sample)  # the bound of the sample
    named = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, "text"):
            raw = [np.array(terms(x.as_py()), "<i4").tobytes() for x in batch.column("text")]
            columns = [batch.column("order"), batch.column("label"), pa.array(raw, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["order", "label", "terms"])

    def fitted(table: pa.Table) -> pa.Table:
        table = table.sort_by([("order", "ascending"), ("label", "ascending"), ("terms", "ascending")]).slice(0, sample)
        rows = [np.frombuffer(x, "<i4") for x in table.column("terms").to_pylist()]
        machine = fit(rows, np.array(table.column("label").to_pylist(), float))
        used = np.flatnonzero((machine.weights != 0) | (machine.vectors != 0).any(axis=1))
        return pa.table(
            {
                "bias": [machine.bias],
                "used": [used.astype("<i4").tobytes()],
                "weights": [machine.weights[used].astype("<f4").tobytes()],
                "vectors": [machine.vectors[used].astype("<f4").tobytes()],
            }
        )

    # the drawn keys are bounded by ``sample``, so every task may hold them
    rows = named.join(F.broadcast(drawn), "key").select("order", "label", "text").mapInArrow(
        packed, "order long, label int, terms binary"
    )
    found = rows.groupBy(F.lit(True)).applyInArrow(fitted, "bias double, used binary, weights binary, vectors binary").collect()
    if not found:
        return None
    used = np.frombuffer(found[0].used, "<i4")
    vectors = np.frombuffer(found[0].vectors, "<f4").reshape(len(used), -1) if len(used) else np.zeros((0, 1))
    weights, all_vectors = np.zeros(WIDTH), np.zeros((WIDTH, vectors.shape[1]))
    weights[used] = np.frombuffer(found[0].weights, "<f4")
    all_vectors[used] = vectors
    return Machine(found[0].bias, weights, all_vectors)


def score(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    sample: int = 20_000,
) -> DataFrame:
    """``key``, score (0 to 1), predicted (1 from 0.5 on) for every row of ``docs``."""
    machine = train(docs, labels, learn, key, text, label, sample)
    if machine is not None:  # only what is used travels to the tasks
        used = np.flatnonzero((machine.weights != 0) | (machine.vectors != 0).any(axis=1))
        small = (machine.bias, used, machine.weights[used], machine.vectors[used])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if machine is not None:
            place = np.zeros(WIDTH, np.int64)  # 0 stands for terms that take no part
            place[small[1]] = np.arange(1, len(small[1]) + 1)
            rank = small[3].shape[1]
            own = Machine(small[0], np.r_[0.0, small[2]], np.concatenate([np.zeros((1, rank)), small[3]]))
        for whole in portions(batches, "text", 1 << 22):
            for begin in range(0, whole.num_rows, 512):
                batch = whole.slice(begin, 512)
                found = np.zeros(batch.num_rows)
                if machine is not None:
                    rows = [place[np.array(terms(x.as_py()), np.int64)] for x in batch.column("text")]
                    rows = [r[r > 0] for r in rows]
                    counts = np.array([len(r) for r in rows])
                    found = own.scores(np.concatenate(rows), counts)
                columns = [batch.column("key"), pa.array(found), pa.array((found >= 0.5).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["key", "score", "predicted"])

    kind = docs.schema[key].dataType.simpleString()
    named = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return named.mapInArrow(run, f"key {kind}, score double, predicted int").withColumnRenamed("key", key)
