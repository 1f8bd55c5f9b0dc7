"""Language identification in two steps: the family first, then the language within it.

Linear support vector machines on hashed letter sequences: one per family against the rest picks the
family, one per pair of languages of a family votes for the language. They are fitted in one task
on a bounded sample, ``per_language`` labelled documents of each language (those with the smallest
hash of their key), and applied to every whole text.

Texts that are null or have no letter are "und" with score 0, as are all texts where nothing can
be learned. A lone language is always predicted. Null labels and null keys are not learned from.
Repeated rows are scored one by one; ties go to the language first in order. Other columns of the
input are not carried unless named. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from trackline.llm.bpe import portions

UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
WIDTH = 1 << 12  # hashed features

# Families of common languages. A language that is not listed is a family of its own.
FAMILIES = {
    "germanic": ["en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "fy", "lb"],
    "romance": ["fr", "es", "it", "pt", "ro", "ca", "gl", "oc", "la"],
    "slavic": ["ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "bg", "mk"],
    "turkic": ["tr", "az", "kk", "uz", "ky", "tk", "tt"],
    "indic": ["hi", "mr", "ne", "bn", "gu", "pa", "ur", "or", "as"],
    "uralic": ["fi", "et", "hu"],
    "semitic": ["ar", "he", "mt", "am"],
}


def family(language: str) -> str:
    return next((name for name, members in FAMILIES.items() if language in members), f"only {language}")


def features(text: str) -> np.ndarray:
    """Square roots of the shares of hashed sequences of two and three bytes; blanks stand for non-letters of ASCII."""
    raw = np.frombuffer(b" " + text.lower().encode("utf-8") + b" ", np.uint8)
    raw = FOLD[raw]
    twice_blank = np.r_[False, (raw[1:] == 32) & (raw[:-1] == 32)]
    raw = raw[~twice_blank].astype(np.uint32)
    two = raw[:-1] * 256 + raw[1:]
    three = two[:-1] * 256 + raw[2:]
    hashed = np.concatenate([two + (1 << 25), three]) * np.uint32(2654435761) >> np.uint32(32 - 12)
    counts = np.bincount(hashed, minlength=WIDTH)
    return np.sqrt(counts / max(counts.sum(), 1)).astype(np.float32)


FOLD = np.array([b if chr(b).isalpha() or b >= 128 else 32 for b in range(256)], np.uint8)


class Models:
    """Families and languages with one separating plane each: ``planes[n]`` and ``shifts[n]`` decide ``names[n]``."""

    def __init__(self, names: list[tuple[str, str]], planes: np.ndarray, shifts: np.ndarray, languages: list[str]):
        self.names, self.planes, self.shifts = names, planes, shifts
        self.languages = sorted(languages)
        self.families = sorted({family(x) for x in self.languages})

    def predict(self, rows: np.ndarray) -> list[tuple[str, float]]:
        margins = rows @ self.planes.T + self.shifts
        column = {name: n for n, name in enumerate(self.names)}
        own = np.stack([margins[:, column["family", f]] for f in self.families], axis=1) if len(self.families) > 1 else None
        out = []
        for n in range(len(rows)):
            score, name = 1.0, self.families[0]
            if own is not None:
                best = int(own[n].argmax())
                name, score = self.families[best], _sure(own[n, best])
            members = [x for x in self.languages if family(x) == name]
            votes = dict.fromkeys(members, 0)
            least = dict.fromkeys(members, np.inf)
            for a, b in combinations(members, 2):
                margin = float(margins[n, column[a, b]])
                votes[a if margin >= 0 else b] += 1
                least[a], least[b] = min(least[a], margin), min(least[b], -margin)
            language = max(members, key=lambda x: (votes[x], least[x]))
            out.append((language, score * (_sure(least[language]) if len(members) > 1 else 1.0)))
        return out


def _sure(margin: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(4 * margin, -30, 30))))


def separate(rows: np.ndarray, side: np.ndarray, epochs: int = 12, batch: int = 32, strength: float = 1e-4) -> tuple[np.ndarray, float]:
    """A linear support vector machine for sides +1 and -1: mean of the second half of stochastic subgradient steps."""
    rng = np.random.default_rng(7)
    weight = np.where(side > 0, 0.5 / max((side > 0).sum(), 1), 0.5 / max((side < 0).sum(), 1)) * len(side)
    plane, shift = np.zeros(rows.shape[1]), 0.0
    mean, mean_shift, taken = np.zeros_like(plane), 0.0, 0
    steps = 0
    for epoch in range(epochs):
        order = rng.permutation(len(rows))
        for begin in range(0, len(rows), batch):
            steps += 1
            at = order[begin : begin + batch]
            wrong = at[side[at] * (rows[at] @ plane + shift) < 1]
            rate = 10.0 / (1 + 0.02 * steps)
            pull = side[wrong] * weight[wrong] / len(at)
            plane *= 1 - min(rate * strength, 0.5)
            plane += rate * (pull @ rows[wrong])
            shift += rate * 0.1 * pull.sum()
            if epoch >= epochs // 2:
                mean, mean_shift, taken = mean + plane, mean_shift + shift, taken + 1
    return mean / max(taken, 1), mean_shift / max(taken, 1)


def fit(languages: np.ndarray, rows: np.ndarray) -> Models:
    known = sorted(set(languages.tolist()))
    families = np.array([family(x) for x in languages])
    names, planes, shifts = [], [], []

    def add(name: tuple[str, str], some: np.ndarray, positive: np.ndarray) -> None:
        plane, shift = separate(rows[some], np.where(positive[some], 1.0, -1.0))
        names.append(name)
        planes.append(plane)
        shifts.append(shift)

    if len(set(families)) > 1:
        for name in sorted(set(families)):
            add(("family", name), np.arange(len(rows)), families == name)
    for a, b in combinations(known, 2):
        if family(a) == family(b):
            add((a, b), np.flatnonzero((languages == a) | (languages == b)), languages == a)
    return Models(names, np.array(planes).reshape(-1, WIDTH), np.array(shifts), known)


def train(docs: DataFrame, text: str, lang: str, key: str, learn: Column, per_language: int) -> Models | None:
    """Fit on a sample of the rows for which ``learn`` holds."""
    order = F.xxhash64(F.col(key).cast("string"), F.lit("sample"))
    labelled = docs.where(learn & F.col(lang).isNotNull() & F.col(key).isNotNull() & F.col(text).rlike(r"\p{L}"))
    counted = docs.where(learn & F.col(lang).isNotNull() & F.col(key).isNotNull()).groupBy(lang).count().collect()
    if not counted:
        return None
    # rows with a hash up to this bound: somewhat more than wanted, cut to the wanted number in the fit
    bound = F.lit(None).cast("long")
    for language, count in counted:
        share = min(1.0, (1.5 * per_language + 50) / count)
        bound = F.when(F.col(lang) == language, F.lit(min(int((2 * share - 1) * 2**63), 2**63 - 1))).otherwise(bound)
    named = labelled.where(order <= bound).select(
        F.col(lang).alias("lang"), order.alias("order"), F.col(text).alias("text")
    )

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, "text"):
            raw = [features(x.as_py()).astype(np.float16).tobytes() for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), batch.column("order"), pa.array(raw, pa.binary())], ["lang", "order", "vector"]
            )

    def fitted(table: pa.Table) -> pa.Table:
        table = table.sort_by([("lang", "ascending"), ("order", "ascending"), ("vector", "ascending")])
        languages = np.array(table.column("lang").to_pylist())
        first = np.searchsorted(languages, languages)
        keep = np.flatnonzero(np.arange(len(languages)) - first < per_language)
        rows = np.stack([np.frombuffer(x.as_py(), np.float16) for x in table.column("vector").take(pa.array(keep))])
        models = fit(languages[keep], rows.astype(np.float32))
        return pa.table(
            {
                "one": [a for a, _ in models.names] + ["language"] * len(models.languages),
                "other": [b for _, b in models.names] + models.languages,
                "plane": [p.astype(np.float32).tobytes() for p in models.planes] + [None] * len(models.languages),
                "shift": [*models.shifts.tolist(), *[0.0] * len(models.languages)],
            },
            schema=pa.schema([("one", pa.string()), ("other", pa.string()), ("plane", pa.binary()), ("shift", pa.float64())]),
        )

    sample = named.mapInArrow(vectors, "lang string, order long, vector binary")
    rows = sample.groupBy(F.lit(True)).applyInArrow(fitted, "one string, other string, plane binary, shift double").collect()
    if not rows:
        return None
    planes = [r for r in rows if r.plane is not None]
    matrix = np.array([np.frombuffer(r.plane, np.float32) for r in planes], np.float32).reshape(-1, WIDTH)
    return Models(
        [(r.one, r.other) for r in planes],
        matrix,
        np.array([r.shift for r in planes]),
        [r.other for r in rows if r.plane is None],
    )


def identify(
    docs: DataFrame,
    learn: Column,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    carry: list[str] | None = None,
    per_language: int = 1000,
) -> DataFrame:
    """``key``, lang_pred, score for every row; ``carry`` names columns to bring along as struct column "carried".

    ``learn`` tells which rows may be learned from; ``lang`` is read of those only.
    """
    models = train(docs, text, lang, key, learn, per_language)
    others = [c for c in carry or [] if c not in (key, text)]
    with_text = text in (carry or [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in portions(batches, "text", 1 << 23):
            for begin in range(0, whole.num_rows, 512):
                batch = whole.slice(begin, 512)
                texts = [x.as_py() for x in batch.column("text")]
                known = [n for n, x in enumerate(texts) if models and x and LETTER.search(x)]
                found: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
                if known:
                    for n, pair in zip(known, models.predict(np.stack([features(texts[n]) for n in known]))):
                        found[n] = pair
                columns = [pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())]
                whole_text = batch.column("text") if with_text else pa.nulls(batch.num_rows, pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key"), *columns, whole_text, batch.column("others")],
                    ["key", "lang_pred", "score", "text", "others"],
                )

    named = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.struct(F.lit(1), *others).alias("others"))
    kind, carried = docs.schema[key].dataType.simpleString(), named.schema["others"].dataType.simpleString()
    done = named.mapInArrow(run, f"key {kind}, lang_pred string, score double, text string, others {carried}")
    place = {key: F.col("key"), text: F.col("text")} | {c: F.col("others")[c] for c in others}
    bundle = [F.struct(*[place[c].alias(c) for c in carry]).alias("carried")] if carry else []
    return done.select(F.col("key").alias(key), "lang_pred", "score", *bundle)


def held_out(key: str = "doc_id", parts: int = 4, part: int = 2) -> Column:
    """Whether the CRC-32 of the key as text has the remainder of the rows to hold out; never for a null key."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % parts == part, F.lit(False))
