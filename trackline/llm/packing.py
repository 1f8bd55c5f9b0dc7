"""Bounded-space online packing of tokenised documents into sequences of a fixed length.

Every partition keeps a fixed number of open windows. A document goes, in stretches of the full
length as long as it has them, into windows of its own; the rest goes best-fit into the open window
that it leaves least room in. When none has room for it, the fullest is emitted: filled up with the
head of the document, or padded where less than ``min_piece`` tokens are missing. What the windows
hold at the end of a partition is packed again, a fixed number of partitions together, until one
group is left. Every step is written to the shared folder and read back, so a lost executor only
repeats its own tasks.

Null texts count as empty: such a document is its end token alone. Repeated rows and repeated or null
keys are packed row by row. An empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from trackline.llm.bpe import encoder, portions
from trackline.session import materialized

LEVEL_BITS, GROUP_BITS = 56, 28  # sequence_id: level, then partition or group, then a running number


class Window:
    __slots__ = ("pieces", "used")

    def __init__(self) -> None:
        self.pieces: list[tuple] = []
        self.used = 0


class Packer:
    """Open windows of one partition or group; ``out`` collects pieces of emitted windows."""

    def __init__(self, size: int, open_windows: int, min_piece: int, first_id: int):
        self.size, self.most, self.min_piece = size, open_windows, min_piece
        self.first_id = self.next_id = first_id
        self.windows: list[tuple[int, int, Window]] = []  # by room left, then by age
        self.age = 0
        self.out: list[tuple] = []

    def add(self, doc, doc_tokens: int, start: int, ids: np.ndarray) -> None:
        while len(ids) >= self.size:
            self._emit([(doc, doc_tokens, start, ids[: self.size])])
            start, ids = start + self.size, ids[self.size :]
        while len(ids):
            at = bisect_left(self.windows, (len(ids),))
            if at == len(self.windows) and len(self.windows) < self.most:
                window = Window()
            elif at == len(self.windows):
                room, _, window = self.windows.pop(0)  # the fullest
                if room >= self.min_piece:
                    window.pieces.append((doc, doc_tokens, start, ids[:room]))
                    start, ids = start + room, ids[room:]
                self._emit(window.pieces)
                continue
            else:
                window = self.windows.pop(at)[2]
            window.pieces.append((doc, doc_tokens, start, ids))
            window.used += len(ids)
            if window.used == self.size:
                self._emit(window.pieces)
            else:
                self.age += 1
                insort(self.windows, (self.size - window.used, self.age, window))
            return

    def _emit(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc, doc_tokens, start, ids in pieces:
            self.out.append((doc, start, ids, doc_tokens, self.next_id, offset, True))
            offset += len(ids)
        self.next_id += 1

    def finish(self, last: bool) -> None:
        """Emit the open windows, or hand on their pieces where another level follows."""
        if last:
            for _, _, window in self.windows:
                self._emit(window.pieces)
        else:
            for _, _, window in self.windows:
                self.out += [(d, s, ids, n, self.first_id, 0, False) for d, n, s, ids in window.pieces]
        self.windows = []

    def taken(self, key: pa.DataType, with_ids: bool) -> pa.RecordBatch:
        """The collected pieces as Arrow; ids go along where they are wanted or still open."""
        rows, self.out = self.out, []
        raw = [np.ascontiguousarray(r[2], "<u4").tobytes() for r in rows]
        columns = [
            pa.array([r[0] for r in rows], key),
            pa.array([r[1] for r in rows], pa.int64()),
            pa.array([len(r[2]) for r in rows], pa.int64()),
            pa.array([zlib.crc32(x) for x in raw], pa.int64()),
            pa.array([r[3] for r in rows], pa.int64()),
            pa.array([r[4] for r in rows], pa.int64()),
            pa.array([r[5] for r in rows], pa.int64()),
            pa.array([r[6] for r in rows], pa.bool_()),
            pa.array([x if with_ids or not r[6] else None for x, r in zip(raw, rows)], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, COLUMNS)


COLUMNS = ["key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "emitted", "ids"]


def pack(
    docs: DataFrame,
    vocabulary: str,
    *,
    key: str = "doc_id",
    text: str = "text",
    size: int = 2048,
    end_id: int = 1,
    open_windows: int = 16,
    min_piece: int = 16,
    fan_in: int = 32,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of all documents: ``key``, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``with_ids`` adds the ids themselves (little-endian unsigned 32-bit integers as binary). At most
    ``open_windows * size`` ids of a partition, and ``fan_in`` times as many of a group, are held open.
    Other columns of ``docs`` are not carried.
    """
    kind = docs.schema[key].dataType.simpleString()
    schema = (
        f"key {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
        "sequence_id long, offset long, emitted boolean, ids binary"
    )

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        packer = Packer(size, open_windows, min_piece, part << GROUP_BITS)
        known, key_type = encoder(vocabulary), None
        for batch in portions(batches, "text"):
            key_type = batch.column("key").type
            keys = iter(batch.column("key").to_pylist())
            texts = [x or "" for x in batch.column("text").to_pylist()]
            for ids, counts in known.encode(texts):
                end = 0
                for count in counts.tolist():
                    own = np.append(ids[end : end + count], np.int32(end_id))
                    packer.add(next(keys), count + 1, 0, own)
                    end += count
                yield packer.taken(key_type, with_ids)
        known.forget()  # the worker process goes on to other tasks
        if key_type is not None:
            packer.finish(last=False)
            yield packer.taken(key_type, with_ids)

    def again(level: int, last: bool):
        def run(group: tuple, table: pa.Table) -> pa.Table:
            order = [("length", "descending"), ("key", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")]
            first = (level << LEVEL_BITS) + (group[0].as_py() << GROUP_BITS)
            packer = Packer(size, open_windows, min_piece, first)
            for row in table.sort_by(order).select(["key", "doc_tokens", "start", "ids"]).to_pylist():
                packer.add(row["key"], row["doc_tokens"], row["start"], np.frombuffer(row["ids"], "<u4"))
            packer.finish(last)
            return pa.Table.from_batches([packer.taken(table.schema.field("key").type, with_ids)])

        return run

    named = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    packed = materialized(named.mapInArrow(first_pass, schema))
    emitted, level, groups = [], 0, 0
    while groups != 1:
        left = packed.where("not emitted").withColumn("group", _group_of_id())
        emitted.append(packed.where("emitted"))
        if level == 0:
            groups = (left.agg(F.max("group")).first()[0] or 0) + 1
        level, groups = level + 1, -(-groups // fan_in)
        grouped = left.withColumn("group", F.pmod("group", F.lit(groups).cast("long"))).groupBy("group")
        packed = materialized(grouped.applyInArrow(again(level, groups == 1), schema))
    emitted.append(packed)
    out = emitted[0]
    for more in emitted[1:]:
        out = out.unionByName(more)
    columns = [F.col("key").alias(key), *COLUMNS[1:-2], *(["ids"] if with_ids else [])]
    return out.select(*columns)


def _group_of_id() -> F.Column:
    return F.shiftrightunsigned("sequence_id", GROUP_BITS).bitwiseAND(F.lit((1 << (LEVEL_BITS - GROUP_BITS)) - 1))
