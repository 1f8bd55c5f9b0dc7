"""Sums of edit distances between many sequences, thousands of pairs at a time.

Bit vectors (Myers, Hyyro) hold a column of the dynamic programme, one bit for each element of a
sequence. Here they lie side by side for all sequences of a block and for some that these are measured
against, so that a step is a handful of operations on whole numpy arrays, of the narrowest integers
that take the sequences. Longer sequences take several words, with the carry between them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa

WIDTHS = {8: np.uint8, 16: np.uint16, 32: np.uint32, 64: np.uint64}
WIDEST = 64
STEP_BYTES = 131_072  # of the arrays in one operation
TABLE_BYTES = 32_000_000  # of the masks kept for a group
SMALL_GROUP = 4  # a group goes to the next wider one if that has so many times its sequences


class Sequences:
    """Sequences of whole numbers, one after the other in ``elements``, the shortest first."""

    def __init__(self, elements: np.ndarray, lengths: np.ndarray, weights: np.ndarray):
        self.order = np.argsort(lengths, kind="stable")
        starts = np.cumsum(lengths) - lengths
        self.starts, self.lengths = starts[self.order], lengths[self.order].astype(np.int64)
        self.weights = weights[self.order].astype(np.float64)
        self.elements = elements

    def __len__(self) -> int:
        return len(self.lengths)

    def batches(self, size: int) -> Iterator[tuple[int, int]]:
        """At most ``size`` sequences of one length: the first, and the one after the last."""
        edges = [0, *(np.flatnonzero(np.diff(self.lengths)) + 1).tolist(), len(self)]
        for begin, end in zip(edges, edges[1:]):
            for first in range(begin, end, size):
                yield first, min(first + size, end)

    def columns(self, begin: int, end: int) -> Iterator[np.ndarray]:
        """The first elements of a batch, then the second ones, and so on."""
        for k in range(self.lengths[begin]):
            yield self.elements[self.starts[begin:end] + k]

    def in_given_order(self, values: np.ndarray) -> np.ndarray:
        out = np.empty(len(values), np.int64)
        out[self.order] = np.rint(values)
        return out

    def groups(self) -> list[_Group]:
        """The sequences by how many words of which width they take."""
        words = np.ones(len(self), np.int64)
        long = self.lengths > WIDEST
        words[long] = 2 ** np.ceil(np.log2(self.lengths[long] / WIDEST)).astype(np.int64)
        bits = np.full(len(self), WIDEST)
        for width in reversed(WIDTHS):
            bits[self.lengths <= width] = width
        for width, next_ in zip(WIDTHS, [*WIDTHS][1:]):
            narrow, wider = bits == width, (bits == next_) & ~long
            if SMALL_GROUP * narrow.sum() <= wider.sum():
                bits[narrow] = next_
        edges = [0, *(np.flatnonzero(np.diff(bits * words)) + 1).tolist(), len(self)]
        return [
            _Group(self, begin, end, int(bits[begin]), int(words[begin]))
            for begin, end in zip(edges, edges[1:])
            if begin < end
        ]


class _Group:
    """The sequences from ``begin`` to ``end``: for each element the bits at the places that have it."""

    def __init__(self, some: Sequences, begin: int, end: int, bits: int, words: int):
        self.begin, self.end, self.words, self.kind = begin, end, words, WIDTHS[bits]
        self.size, kind = end - begin, self.kind
        lengths = some.lengths[begin:end]
        row = np.repeat(np.arange(self.size), lengths)
        place = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        element = some.elements[np.repeat(some.starts[begin:end], lengths) + place]
        bit = np.left_shift(np.ones(len(row), kind), (place % bits).astype(kind))
        cell = (place // bits) * self.size + row
        order = np.lexsort((cell, element))
        element, cell, bit = element[order], cell[order], bit[order]
        # every element and word once, with all its bits
        fresh = np.flatnonzero((np.diff(element, prepend=-1) != 0) | (np.diff(cell, prepend=-1) != 0))
        self.bit = np.bitwise_or.reduceat(bit, fresh) if len(fresh) else bit
        self.cell, element = cell[fresh], element[fresh]
        self.known, self.first = np.unique(element, return_index=True)
        self.last = np.append(self.first, len(element))[1:]
        used = np.clip(lengths - bits * np.arange(words)[:, None], 0, bits)
        whole = np.array(2**bits - 1, kind)
        self.used = np.where(used == 0, kind(0), np.right_shift(whole, ((bits - used) % bits).astype(kind)))
        rows = len(self.known) + 1  # the last one is that of all other elements
        self.table = None
        if rows * words * self.size * np.dtype(kind).itemsize <= TABLE_BYTES:
            self.table = np.zeros((words, rows, self.size), kind)
            at = np.repeat(np.arange(rows - 1), self.last - self.first)
            self.table[self.cell // self.size, at, self.cell % self.size] = self.bit
        self.batch = max(1, STEP_BYTES // (self.size * words * np.dtype(kind).itemsize))

    def _masks(self, elements: np.ndarray, first: int, out: np.ndarray) -> None:
        rows = np.searchsorted(self.known, elements)
        found = rows < len(self.known)
        found[found] = self.known[rows[found]] == elements[found]
        rows[~found] = len(self.known)
        if self.table is not None:
            for word in range(self.words):
                out[word] = self.table[word, rows, first:]
            return
        for k, row in enumerate(rows.tolist()):
            mask = np.zeros((self.words, self.size), self.kind)
            if row < len(self.known):
                at = slice(self.first[row], self.last[row])
                mask.reshape(-1)[self.cell[at]] = self.bit[at]
            out[:, k] = mask[:, first:]

    def distances(self, others: Sequences, begin: int, end: int, first: int = 0) -> np.ndarray:
        """The distances of a batch of ``others`` to the sequences of the group from ``first`` on."""
        shape = (self.words, end - begin, self.size - first)
        plus, minus = np.full(shape, ~self.kind(0)), np.zeros(shape, self.kind)
        equal = np.empty(shape, self.kind)
        space = [np.empty(shape[1:], self.kind) for _ in range(3)]
        step = _step if self.words == 1 else _long_step
        for elements in others.columns(begin, end):
            self._masks(elements, first, equal)
            step(equal, plus, minus, *space)
        used = self.used[:, None, first:]
        up = np.bitwise_count(np.bitwise_and(plus, used, out=plus))
        down = np.bitwise_count(np.bitwise_and(minus, used, out=minus))
        if self.words == 1:
            found = np.subtract(up[0], down[0], dtype=np.float64)
        else:
            found = up.sum(0, dtype=np.float64) - down.sum(0, dtype=np.float64)
        found += others.lengths[begin]
        return found


def _step(equal, plus, minus, a, b, c):
    """One element further: where a column goes up and down, of the last column.

    ``b`` holds the complement of where a row goes up, so that the one which enters from above is the
    zero that an addition shifts in.
    """
    equal, plus, minus = equal[0], plus[0], minus[0]
    np.bitwise_and(equal, plus, out=a)
    np.add(a, plus, out=a)
    np.bitwise_xor(a, plus, out=a)
    np.bitwise_or(a, equal, out=a)
    np.bitwise_or(a, minus, out=a)  # diagonals that do not go up
    np.bitwise_or(a, plus, out=b)
    np.bitwise_xor(b, minus, out=b)
    np.add(b, b, out=b)
    np.bitwise_and(a, plus, out=c)  # where a row goes down
    np.add(c, c, out=c)
    np.bitwise_and(a, b, out=plus)
    np.bitwise_xor(a, plus, out=minus)
    np.bitwise_xor(b, plus, out=plus)
    np.bitwise_or(plus, c, out=plus)


def _long_step(equal, plus, minus, a, b, c):
    """The same word by word; how a row leaves a word is how it enters the next one."""
    one, top = np.uint64(1), np.uint64(WIDEST - 1)
    level, down = np.uint64(0), np.uint64(0)  # the row does not go up; goes down
    for e, p, m in zip(equal, plus, minus):
        e |= down
        a[...] = (((e & p) + p) ^ p) | e | m
        b[...] = (a | p) ^ m
        c[...] = a & p
        next_level, next_down = b >> top, c >> top
        b[...] = (b << one) | level
        c[...] = (c << one) | down
        both = a & b
        m[...] = a ^ both
        p[...] = (b ^ both) | c
        level, down = next_level, next_down


def across(one: Sequences, other: Sequences) -> tuple[np.ndarray, np.ndarray]:
    """Per sequence of either side its weighted sum of distances to those of the other side."""
    if len(one) > len(other):
        return across(other, one)[::-1]
    here, there = np.zeros(len(one)), np.zeros(len(other))
    for group in other.groups():
        at = slice(group.begin, group.end)
        for begin, end in one.batches(group.batch):
            found = group.distances(one, begin, end)
            here[begin:end] += found @ other.weights[at]
            there[at] += one.weights[begin:end] @ found
    return one.in_given_order(here), other.in_given_order(there)


def within(some: Sequences) -> np.ndarray:
    """Per sequence its weighted sum of distances to the others; each pair counts once."""
    sums = np.zeros(len(some))
    for group in some.groups():
        for begin, end in some.batches(group.batch):
            first = max(begin + 1 - group.begin, 0)
            if first >= group.size:
                break
            found = group.distances(some, begin, end, first)
            for k in range(begin, end):  # not those up to itself
                found[k - begin, : max(k + 1 - group.begin - first, 0)] = 0
            at = slice(group.begin + first, group.end)
            sums[begin:end] += found @ some.weights[at]
            sums[at] += some.weights[begin:end] @ found
    return some.in_given_order(sums)


def of_blocks(keep: Sequence[str], wide: str) -> Callable[[pa.Table], pa.Table]:
    """A function for rows of two blocks: per open one its sum of distances to those of the other block.

    Where ``_one`` and ``_two`` are the same block it is that to all others of the block, and in a
    ``_mixed`` group that to the rows which are not open.
    """

    def summed(table: pa.Table) -> pa.Table:
        one, two, mixed = (table[c][0].as_py() for c in ("_one", "_two", "_mixed"))
        codes, weights = table["code"].to_pylist(), table["w"].to_numpy()
        if mixed:
            side = ~table["_open"].to_numpy()
        else:
            side = table["_block"].to_numpy() != one
        first, second = np.flatnonzero(~side), np.flatnonzero(side)
        sides = [[codes[k] for k in rows] for rows in (first, second)]
        here, there = (
            Sequences(*found, weights[rows])
            for found, rows in zip(_numbers(sides, wide), (first, second))
        )
        if not mixed and one == two:
            rows, sums = first, within(here)
        else:
            rows = first if mixed else np.concatenate([first, second])
            sums = across(here, there)
            sums = sums[0] if mixed else np.concatenate(sums)
        found = table.select([*keep, "code"]).take(pa.array(rows))
        return found.append_column("total", pa.array(sums, pa.int64()))

    return summed


def _numbers(sides: list[list[str]], wide: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Elements and lengths of the codes of each side: one character each, or names after a mark."""
    if any(code.startswith(wide) for some in sides for code in some):
        split = [[code[1:].split(wide) if code.startswith(wide) else code for code in some] for some in sides]
        yield from numbered(split)
        return
    for some in sides:
        letters = "".join(some).encode("utf-32-le")
        yield np.frombuffer(letters, np.uint32).astype(np.int64), np.fromiter(map(len, some), np.int64, len(some))


def numbered(texts: Sequence[Sequence[Sequence[str]]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Elements and lengths of each list of sequences; the same element has the same number in all."""
    known: dict[str, int] = {}
    for some in texts:
        lengths = np.fromiter(map(len, some), np.int64, len(some))
        flat = (known.setdefault(e, len(known)) for one in some for e in one)
        yield np.fromiter(flat, np.int64, int(lengths.sum())), lengths
