"""BPE encoding with a pair occurrence index, and decoding.

The words that are new in a batch of texts lie one after the other in flat arrays. An index maps
every adjacent pair with a merge rank to all its positions; the ranks that occur are applied in
ascending order, each to all its positions at once, and the pairs that a merge makes are added to
the lists of their ranks. Positions that an earlier merge has changed are recognised when their
list is used. Texts are cut at white space, so that a word met again costs one look-up.

Null texts count as empty. A text without tokens has no ids. Texts may be of any length; the
vocabulary's own special tokens are recognised inside texts, as the tokenizers library does.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

# What the vocabulary file states about normalisation and cutting.
CONTRACTIONS = ["s", "t", "re", "ve", "m", "ll", "d"]
WORD_END = "</w>"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    printable = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


# Code points that no text holds: they stand for the end of a text and for special tokens.
TEXT_END, SPECIAL = 0xDBFF, 0xD800
OTHER_KIND, BLANK_KIND, LETTER_KIND, SINGLE_KIND = range(4)
MARK = re.compile(f"([{chr(SPECIAL)}-{chr(TEXT_END)}])")


# Where the Unicode versions of Python, of the regex module and of the library may differ, the library is asked.
LETTER_OR_NUMERAL = regex.compile(r"[\p{L}\p{N}]")


def code_points(cutter) -> tuple[np.ndarray, np.ndarray]:
    """For each code point its kind: part of a run of letters, alone (numerals, special tokens), blank,
    or other; and whether Python does not know it. ``cutter`` is the library's own way to cut a text."""
    kind, unknown = np.zeros(0x110000, np.uint8), np.zeros(0x110000, bool)
    for point in range(0x110000):
        letter = chr(point)
        category = unicodedata.category(letter)
        if category[0] == "L":
            kind[point] = LETTER_KIND
        elif category[0] == "N":
            kind[point] = SINGLE_KIND
        elif letter.isspace() and point not in range(0x1C, 0x20):  # Python's own blanks are not Unicode's
            kind[point] = BLANK_KIND
        elif category == "Cn":
            unknown[point] = True
            if LETTER_OR_NUMERAL.match(letter):
                words = [word for word, _ in cutter.pre_tokenize_str(f"a{letter}{letter}!")]
                kind[point] = SINGLE_KIND if len(words) == 4 else LETTER_KIND if len(words[-1]) == 1 else OTHER_KIND
    kind[SPECIAL:TEXT_END] = SINGLE_KIND
    kind[TEXT_END] = BLANK_KIND
    return kind, unknown


class Vocabulary:
    """Merge tables of a byte-level BPE file with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            stated = json.load(file)
        library = Tokenizer.from_file(path)
        self.normalizer = library.normalizer
        self.kinds, self.unknown = code_points(library.pre_tokenizer)
        model = stated["model"]
        ids = model["vocab"]
        self.specials = {x["content"]: x["id"] for x in stated["added_tokens"]}
        self.size = max([*ids.values(), *self.specials.values()]) + 1
        self.tokens = [""] * self.size
        for token, number in [*ids.items(), *self.specials.items()]:
            self.tokens[number] = token
        letters = byte_letters()
        self.inner = np.array([ids[x] for x in letters], np.int32)
        self.last = np.array([ids[x + WORD_END] for x in letters], np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.left = np.array([ids[a] for a, _ in pairs], np.int32)
        self.right = np.array([ids[b] for _, b in pairs], np.int32)
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int32)
        keys = self.left.astype(np.int64) * self.size + self.right
        self.rank_of = np.argsort(keys, kind="stable")
        self.keys = keys[self.rank_of]
        self.special_marks = {
            token: chr(SPECIAL + n) for n, token in enumerate(sorted(self.specials, key=len, reverse=True))
        }

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge rank of each pair, -1 where there is none."""
        wanted = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.rank_of[at], -1)


class PairIndex:
    """The symbols of many words, and for each merge rank the positions where its pair starts."""

    def __init__(self, vocabulary: Vocabulary, words: list[bytes]):
        self.vocabulary = vocabulary
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths)
        raw = np.frombuffer(b"".join(words), np.uint8)
        self.starts = ends - lengths
        self.symbols = vocabulary.inner[raw]
        self.symbols[ends - 1] = vocabulary.last[raw[ends - 1]]
        self.following = np.arange(1, len(raw) + 1, dtype=np.int32)
        self.following[ends - 1] = -1
        self.preceding = np.arange(-1, len(raw) - 1, dtype=np.int32)
        self.preceding[self.starts] = -1
        self.positions: dict[int, list[np.ndarray]] = {}
        self.active: list[int] = []
        self._add(np.flatnonzero(self.following >= 0))

    def _add(self, starts: np.ndarray) -> None:
        """Enter the pairs that begin at ``starts`` into the lists of their ranks."""
        ranks = self.vocabulary.ranks(self.symbols[starts], self.symbols[self.following[starts]])
        known = ranks >= 0
        ranks, starts = ranks[known], starts[known]
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        ranks, starts = ranks[order], starts[order]
        borders = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        begin = 0
        for rank, end in zip(ranks[np.r_[0, borders]].tolist(), [*borders.tolist(), len(ranks)]):
            if rank in self.positions:
                self.positions[rank].append(starts[begin:end])
            else:
                self.positions[rank] = [starts[begin:end]]
                heapq.heappush(self.active, rank)
            begin = end

    def _apply(self, rank: int) -> None:
        table, symbols, following = self.vocabulary, self.symbols, self.following
        lists = self.positions.pop(rank)
        at = lists[0] if len(lists) == 1 else np.concatenate(lists)
        a, b = table.left[rank], table.right[rank]
        second = following[at]
        at = at[(second >= 0) & (symbols[at] == a) & (symbols[second] == b)]
        if a == b:
            at = self._without_overlap(np.unique(at))
        if not len(at):
            return
        second = following[at]
        after = following[second]
        symbols[at] = table.merged[rank]
        symbols[second] = -1
        following[at] = after
        inside = after >= 0
        self.preceding[after[inside]] = at[inside]
        before = self.preceding[at]
        self._add(np.concatenate([before[before >= 0], at[inside]]))

    def _without_overlap(self, at: np.ndarray) -> np.ndarray:
        """Every other position of a run of equal symbols, from its left end."""
        if not len(at):
            return at
        chained = np.r_[False, self.following[at[:-1]] == at[1:]]
        step = np.arange(len(at))
        first = np.maximum.accumulate(np.where(chained, 0, step))
        return at[(step - first) % 2 == 0]

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        """Apply all ranks; the ids of all words, and where each word's ids begin (one more: the end)."""
        while self.active:
            self._apply(heapq.heappop(self.active))
        alive = self.symbols >= 0
        before = np.r_[0, np.cumsum(alive)]
        return self.symbols[alive], np.r_[before[self.starts], before[-1]]


class Encoder:
    """Ids of texts. Words stay known until more than ``most`` are; then all are forgotten.

    ``most`` bounds memory and changes no result.
    """

    def __init__(self, path: str, most: int = 250_000):
        self.vocabulary = Vocabulary(path)
        self.most = most
        self.forget()

    def forget(self) -> None:
        self.codes: dict[str, int] = {}  # word -> its code
        self.ids, self.ends = np.empty(0, np.int32), np.zeros(1, np.int64)  # ids of code c: ends[c] to ends[c + 1]

    def _normalised(self, texts: list[str]) -> str:
        joined = chr(TEXT_END).join([*texts, ""])
        if "<|" in joined:
            for token, mark in self.vocabulary.special_marks.items():
                joined = joined.replace(token, mark)
        if joined.isascii():
            return joined.lower()
        if self.vocabulary.unknown[_points(joined)].any():
            parts = MARK.split(joined)
            return "".join([x if MARK.fullmatch(x) else self.vocabulary.normalizer.normalize_str(x) for x in parts])
        if not unicodedata.is_normalized("NFC", joined):
            joined = unicodedata.normalize("NFC", joined)
        return joined.replace("Σ", "σ").lower()

    def _words(self, texts: list[str], fresh: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the words of all texts, and how many words each text has.

        Words without a code get the next one and are appended to ``fresh``.
        """
        joined = self._normalised(texts)
        points = _points(joined)
        starts, kind = word_starts(points, self.vocabulary.kinds[points])
        lengths = np.diff(starts, append=len(points))
        is_word = kind != BLANK_KIND
        text_ends = np.flatnonzero(points == TEXT_END)
        starts, lengths = starts[is_word], lengths[is_word]
        per_text = np.diff(np.searchsorted(starts, text_ends), prepend=0)
        first, which = distinct_ranges(points, starts, lengths)
        codes = np.empty(len(first), np.int64)
        known, total = self.codes, len(self.codes)
        for n, (begin, size) in enumerate(zip(starts[first].tolist(), lengths[first].tolist())):
            word = joined[begin : begin + size]
            code = known.setdefault(word, total)
            if code == total:
                total += 1
                fresh.append(word)
            codes[n] = code
        return codes[which], per_text

    def _learn(self, fresh: list[str]) -> None:
        """Encode words through the pair index of all of them."""
        marks = {mark: self.vocabulary.specials[token] for token, mark in self.vocabulary.special_marks.items()}
        special = np.array([marks.get(w, -1) if len(w) == 1 else -1 for w in fresh], np.int32)
        ordinary = [w.encode("utf-8") for w, known in zip(fresh, special.tolist()) if known < 0]
        lengths = np.ones(len(fresh), np.int64)
        found = np.empty(0, np.int32)
        if ordinary:
            found, borders = PairIndex(self.vocabulary, ordinary).merge()
            lengths[special < 0] = np.diff(borders)
        ids = np.repeat(special, lengths)
        ids[ids < 0] = found
        self.ids = np.concatenate([self.ids, ids])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(lengths)])

    def encode(self, texts: list[str], portion: int = 1 << 21) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of all texts of a portion, one after the other, and the number of ids of each text.

        A portion holds about ``portion`` characters (always whole texts).
        """
        if len(self.codes) > self.most:
            self.forget()
        fresh: list[str] = []
        found = []
        sizes = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts))) // portion
        borders = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), len(texts)]
        for begin, end in zip(borders, borders[1:]):
            if end > begin:
                found.append(self._words(texts[begin:end], fresh))
        if fresh:
            self._learn(fresh)
        for codes, per_text in found:
            begins, ends = self.ends[codes], self.ends[codes + 1]
            total = np.r_[0, np.cumsum(ends - begins)]
            borders = np.r_[0, np.cumsum(per_text)]
            yield self.ids[ragged(begins, ends)], np.diff(total[borders])

    def encode_each(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        for ids, counts in self.encode(texts):
            yield from np.split(ids, np.cumsum(counts)[:-1])


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def word_starts(points: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of one kind begin (words and blanks in turn), and their kinds.

    A lone apostrophe takes the letters of a contraction after it.
    """
    border = np.empty(len(points), bool)
    border[:1] = True
    border[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == SINGLE_KIND)
    quotes = np.flatnonzero(points[:-1] == ord("'"))
    quotes = quotes[border[quotes] & (kind[quotes + 1] == LETTER_KIND)]
    for quote in quotes.tolist():
        after = points[quote + 1 : quote + 3].tolist()
        for letters in CONTRACTIONS:
            if after[: len(letters)] == [ord(x) for x in letters]:
                border[quote + 1] = False
                rest = quote + 1 + len(letters)
                if rest < len(points):
                    border[rest] = True
                break
    starts = np.flatnonzero(border)
    return starts, kind[starts]


POWERS = np.cumprod(np.full(4096, 0x9E3779B97F4A7C15, np.uint64))


def distinct_ranges(points: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ones among ranges of ``points``: number of a first range, and for each range which one it is.

    Ranges meet by a hash and are then compared point by point, so the result is exact.
    """
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    inside = ragged(starts, starts + lengths)
    place = np.arange(len(inside)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    weighted = (points[inside].astype(np.uint64) + np.uint64(1)) * POWERS[place % len(POWERS)]
    hashes = np.add.reduceat(weighted, np.cumsum(lengths) - lengths)
    _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
    like = first[which]
    same = lengths[like] == lengths
    if same.all() and (points[inside] == points[np.repeat(starts[like], lengths) + place]).all():
        return first, which
    known: dict[bytes, int] = {}  # different ranges with one hash: compare them as bytes
    which = np.array([known.setdefault(points[b : b + n].tobytes(), len(known)) for b, n in zip(starts, lengths)])
    return np.unique(which, return_index=True)[1], which


def ragged(begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All indices of the ranges ``begins[i]`` to ``ends[i]``, one range after the other."""
    lengths = ends - begins
    offsets = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum())) + np.repeat(begins - offsets, lengths)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this worker process: words stay known from one task to the next."""
    if path not in _encoders:
        _encoders.clear()
        _encoders[path] = Encoder(path)
    return _encoders[path]


def decode(vocabulary: Vocabulary, ids: list[int]) -> str:
    """The text that the vocabulary's decode gives: it names no decoder, so tokens joined by a space."""
    tokens = vocabulary.tokens
    return " ".join([tokens[i] for i in ids])


def portions(batches: Iterable[pa.RecordBatch], column: str, most: int = 1 << 24) -> Iterator[pa.RecordBatch]:
    """Parts of Arrow batches with about ``most`` bytes of text each, so that memory stays bounded."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes, dtype=np.int64) // most
        borders = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), batch.num_rows]
        for begin, end in zip(borders, borders[1:]):
            if end > begin:
                yield batch.slice(begin, end - begin)


def digest_texts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode and decode every text: ``key``, n_tokens, ids_sha256, decoded_sha256.

    One row per row of ``docs``; other columns of the input are not carried.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(path)
        decimals = list(map(str, range(known.vocabulary.size)))
        for batch in portions(batches, "text"):
            texts = [x or "" for x in batch.column("text").to_pylist()]
            out = []
            for ids in known.encode_each(texts):
                numbers = ids.tolist()
                out.append((len(numbers), _sha(" ".join([decimals[i] for i in numbers])), _sha(decode(known.vocabulary, numbers))))
            count, ids_sha, decoded = map(list, zip(*out))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(count, pa.int64()), pa.array(ids_sha), pa.array(decoded)],
                ["key", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema[key].dataType.simpleString()
    named = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    done = named.mapInArrow(run, f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return done.withColumnRenamed("key", key)


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()
