"""Removal of lines that many documents share, with levelled sorted runs of line hashes.

Documents come in batches, those with the largest keys first. A batch's lines become a run: one row
per line hash with the number of its documents and the largest key among them, sorted by hash.
Before that the batch is merge-anti-joined with the runs: lines that a run already holds in enough
documents are settled (an earlier batch has their largest key) and are not added again. Whenever a
level has ``fan_in`` runs, they are compacted into one run of the next level. At the end the runs
together tell which lines are shared, and every document loses those lines that are not its own.

A line's key is the line without blanks of ASCII at its ends, A-Z in lower case; shorter keys than
``least`` code points are never dropped. Keys meet by 128 bits of a hash. A null or empty text is one
empty line. Documents are told apart by their key: repeated rows count as one document and lose the
same lines; null is a document smaller than all others. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from trackline.llm.bpe import portions
from trackline.session import materialized, scratch_dir

BLANKS = " \t\n\v\f\r"


def line_hash(line: str, least: int) -> bytes | None:
    """128 bits for the key of a line, none for short ones."""
    key = line.strip(BLANKS)
    if len(key) < least:
        return None
    return hashlib.md5(key.encode("utf-8").lower(), usedforsecurity=False).digest()


class Runs:
    """Levelled sorted runs of (hash, docs, last)."""

    def __init__(self, enough: int, fan_in: int):
        self.enough, self.fan_in = enough, fan_in
        self.levels: list[list[DataFrame]] = [[]]

    def all(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def add(self, lines: DataFrame) -> None:
        """Add a batch: distinct rows (hash, key), all keys smaller than those of earlier batches."""
        own = lines.groupBy("hash").agg(F.count("*").alias("docs"), F.max("key").alias("last"))
        for run in self.all():
            own = own.join(run.where(F.col("docs") >= self.enough).select("hash"), "hash", "left_anti")
        self._write(own, 0)

    def _write(self, run: DataFrame, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(materialized(run.sortWithinPartitions("hash")))
        if len(self.levels[level]) == self.fan_in:
            merged = merge(self.levels[level])
            self.levels[level] = []
            self._write(merged, level + 1)

    def shared(self) -> DataFrame:
        """Lines in enough documents: hash, and the largest key that has it."""
        return merge(self.all()).where(F.col("docs") >= self.enough).select("hash", "last")


def merge(runs: list[DataFrame]) -> DataFrame:
    rows = runs[0]
    for run in runs[1:]:
        rows = rows.unionByName(run)
    return rows.groupBy("hash").agg(F.sum("docs").alias("docs"), F.max("last").alias("last"))


def dedupe_lines(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    carry: list[str] | None = None,
    least: int = 20,
    enough: int = 3,
    batches: int = 4,
    fan_in: int = 2,
) -> DataFrame:
    """Each row of ``docs`` without its shared lines: ``key``, n_lines (before), n_dropped, kept.

    ``key`` is a number. ``carry`` names columns to bring along in a struct column "carried".
    """
    named = docs.select(
        F.col(key).alias("key"), F.col(text).alias("text"), F.struct(F.lit(1), *(carry or [])).alias("carried")
    )
    kind = docs.schema[key].dataType.simpleString()
    index = _line_index(named.select("key", "text"), kind, least, batches)
    runs = Runs(enough, fan_in)
    for number in reversed(range(batches)):
        runs.add(index.where(F.col("batch") == number).select("hash", "key").distinct())
    shared = materialized(runs.shared())
    drops = (
        index.join(shared, "hash")
        .where(~F.col("key").eqNullSafe(F.col("last")))
        .groupBy(F.col("key").alias("owner"))
        .agg(F.collect_set("hash").alias("drops"))
    )
    joined = named.join(drops, F.col("key").eqNullSafe(F.col("owner")), "left").select("key", "text", "drops", "carried")
    schema = f"key {kind}, n_lines long, n_dropped long, kept string, carried {joined.schema['carried'].dataType.simpleString()}"
    done = joined.mapInArrow(_rewriter(least), schema)
    out = [F.col("key").alias(key), "n_lines", "n_dropped", "kept"]
    return done.select(*out, *(["carried"] if carry else []))


def _line_index(named: DataFrame, kind: str, least: int, batches: int) -> DataFrame:
    """Rows (key, hash, batch): one for each long line of each row, written by batch of keys."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(rows, "text"):
            at, hashes = [], []
            for n, text in enumerate(batch.column("text")):
                found = {line_hash(x, least) for x in (text.as_py() or "").split("\n")} - {None}
                hashes += found
                at += [n] * len(found)
            keys = batch.column("key").take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([keys, pa.array(hashes, pa.binary())], ["key", "hash"])

    shares = [n / batches for n in range(1, batches)]
    borders = named.agg(F.percentile_approx("key", shares, 10_000)).first()[0] or []
    path = f"{scratch_dir(named.sparkSession)}/lines"
    rows = named.mapInArrow(run, f"key {kind}, hash binary").withColumn("batch", _batch_of(F.col("key"), borders))
    rows.write.partitionBy("batch").parquet(path)
    return named.sparkSession.read.schema(rows.schema).parquet(path)


def _batch_of(key: Column, borders: list) -> Column:
    """Number of the borders below the key; null keys are in the batch of the smallest."""
    number = F.lit(0)
    for border in borders:
        number = number + F.coalesce((key > border).cast("int"), F.lit(0))
    return number


def _rewriter(least: int):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(rows, "text"):
            lines, dropped, kept = [], [], []
            for text, drops in zip(batch.column("text"), batch.column("drops")):
                own = text.as_py() or ""
                parts = own.split("\n")
                lines.append(len(parts))
                gone = set(drops.as_py() or ())
                left = [x for x in parts if line_hash(x, least) not in gone] if gone else parts
                dropped.append(len(parts) - len(left))
                kept.append("\n".join(left) if gone else own)
            columns = [batch.column("key"), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(
                [*columns, batch.column("carried")], ["key", "n_lines", "n_dropped", "kept", "carried"]
            )

    return run


def sql(least: int = 20, enough: int = 3) -> str:
    """The same on a table ``documents`` (doc_id, text) in SQL, kept as its SHA-256."""
    return f"""
WITH lines AS (
  SELECT doc_id, unnest(range(len(parts))) AS place, unnest(parts) AS line, len(parts) AS n_lines
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), shared AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= {least}
  GROUP BY key HAVING count(DISTINCT doc_id) >= {enough}
)
SELECT k.doc_id, any_value(k.n_lines)::BIGINT AS n_lines,
       count(*) FILTER (s.key IS NOT NULL AND k.doc_id <> s.last)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(k.line, chr(10) ORDER BY k.place)
                       FILTER (s.key IS NULL OR k.doc_id = s.last), '')) AS kept_sha256
FROM keyed k LEFT JOIN shared s ON k.key = s.key
GROUP BY k.doc_id
"""
