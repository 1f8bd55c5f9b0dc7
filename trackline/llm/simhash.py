"""Near duplicates by SimHash fingerprints and the generalised pigeonhole principle.

Fingerprint bits are put into groups of bits that vary together. Two fingerprints within ``distance``
bits agree, in at least one group g, up to t(g) bits, if the thresholds t sum to distance + 1 less
the number of groups (t = -1 leaves a group out). Dynamic programming picks the thresholds, and the number of
groups, with the fewest estimated candidates, counted over all fingerprints. A group with threshold
0 is probed with its bits, one with threshold 1 with its bits less each bit in turn. Fingerprints
that meet are verified. A bucket above ``bucket`` fingerprints is split by the same principle on the bits
that are not fixed in it, as often as needed, so that all links are found without comparing huge
groups. Components of links are joined by ``components.stars``.

A text without words (null, empty or blank) has fingerprint zero and links like any other. Repeated
keys are rows of their own with one component. Other columns of the input come along if named. An
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from trackline.llm.components import stars
from trackline.session import materialized

BITS = 64
SEED = 42


def fingerprint(text: str | None, words: int = 3, block: int = 1 << 16) -> int:
    """Bit i is 1 if it is set in more than half of the hashes of the text's word shingles."""
    parts = (text or "").encode("utf-8").lower().split()  # of bytes: A-Z only, blanks of ASCII only
    if not parts:
        return 0
    words = min(words, len(parts))
    digest = xxhash.xxh64_intdigest
    shingles = zip(*(parts[i:] for i in range(words)))
    hashes = np.array([digest(b" ".join(s), SEED) for s in shingles], ">u8")
    counts = np.zeros(BITS, np.int64)
    for begin in range(0, len(hashes), block):
        some = hashes[begin : begin + block].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(some, axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprints(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, carry: list[str] | None = None
) -> DataFrame:
    """``key`` and print: the 64-bit fingerprint as a (signed) long; with ``carry`` a struct of these columns too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(x.as_py(), words) for x in batch.column("text")]
            signed = np.array(prints, np.uint64).view(np.int64)
            kept = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(signed)], [*kept, "print"])

    more = [F.struct(*carry).alias("carried")] if carry else []
    named = docs.select(F.col(key).alias("key"), *more, F.col(text).alias("text"))
    kinds = [f"{c} {named.schema[c].dataType.simpleString()}" for c in named.columns if c != "text"]
    return named.mapInArrow(run, ", ".join([*kinds, "print long"])).withColumnRenamed("key", key)


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    words: int = 3,
    distance: int = 2,
    bucket: int = 512,
    carry: list[str] | None = None,
) -> DataFrame:
    """One row per document: ``key``, fingerprint (16 hex digits), component_id (least key reachable).

    ``carry`` names columns to bring along in a struct column "carried"; then "component" (a fingerprint) tells
    components apart, also those whose documents share a key or have none.
    """
    printed = materialized(fingerprints(docs, key, text, words, carry))
    distinct = materialized(printed.groupBy("print").agg(F.min(key).alias("least")))
    near = stars(links(distinct.select("print"), distance, bucket))
    member = near.select(F.col("node").alias("print"), "root")
    member = member.unionByName(near.select(F.col("root").alias("print"), "root").distinct())
    # per component the least key of its fingerprints
    named = member.join(distinct, "print").groupBy("root").agg(F.min("least").alias("of_all"))
    renamed = member.join(named, "root").select("print", "root", "of_all")
    component = distinct.join(renamed, "print", "left").select(
        "print", F.coalesce("root", "print").alias("component"), F.coalesce("of_all", "least").alias("component_id")
    )
    component = materialized(component)  # so that the join below can be split where many share a print
    hexed = F.lower(F.lpad(F.hex("print"), BITS // 4, "0")).alias("fingerprint")
    more = ["component", "carried"] if carry else []
    return printed.join(component, "print").select(key, hexed, "component_id", *more)


def links(prints: DataFrame, distance: int, bucket: int) -> DataFrame:
    """Links that connect all distinct fingerprints within ``distance`` bits: columns a and b.

    Not every pair is a row: of the fingerprints connected within a bucket, each is linked to the least.
    """
    masks = probe_masks(prints, distance)
    probes = prints.select("print", F.explode(F.array(*map(F.lit, masks))).alias("mask"))
    out = None
    while True:
        probes = probes.withColumn("value", F.col("print").bitwiseAND(F.col("mask")))
        sizes = probes.groupBy("mask", "value").count().where(F.col("count") > bucket)
        large = materialized(sizes.drop("count"))
        if large.isEmpty():
            break
        marked = materialized(probes.join(large.withColumn("large", F.lit(True)), ["mask", "value"], "left"))
        found = _verified(marked.where("large is null"), distance)
        out = found if out is None else out.unionByName(found)
        split = _splits([m for (m,) in large.select("mask").distinct().collect()], distance)
        table = F.create_map(*[F.lit(x) for m, finer in split.items() for x in (m, finer)])
        probes = marked.where("large").select("print", F.explode(table[F.col("mask")]).alias("mask"))
    found = _verified(probes, distance)
    return found if out is None else out.unionByName(found)


def _verified(probes: DataFrame, distance: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty((0, 3), np.int64)
        for batch in batches:
            rows = np.column_stack([batch.column(c).to_numpy() for c in ("mask", "value", "print")])
            held = np.concatenate([held, rows])
            changes = np.flatnonzero((held[1:, :2] != held[:-1, :2]).any(axis=1)) + 1
            if len(changes):  # the last bucket may go on in the next batch
                yield _linked(held[: changes[-1]], distance)
                held = held[changes[-1] :]
        if len(held):
            yield _linked(held, distance)

    by_bucket = probes.repartition("mask", "value").sortWithinPartitions("mask", "value", "print")
    return by_bucket.select("mask", "value", "print").mapInArrow(run, "a long, b long")


def _linked(rows: np.ndarray, distance: int) -> pa.RecordBatch:
    """Compare the rows of each bucket (rows are sorted) and connect what is near."""
    prints = np.ascontiguousarray(rows[:, 2]).view(np.uint64)
    first = np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1)]
    number = np.cumsum(first)
    left = np.arange(len(rows))
    pairs = []
    step = 1
    while True:
        left = left[left < len(rows) - step]
        left = left[number[left] == number[left + step]]
        if not len(left):
            break
        near = np.bitwise_count(prints[left] ^ prints[left + step]) <= distance
        pairs.append((left[near], left[near] + step))
        step += 1
    least = np.arange(len(rows))
    if pairs:
        a, b = (np.concatenate(x) for x in zip(*pairs))
        while len(a) and (least[a] != least[b]).any():
            lower = np.minimum(least[a], least[b])
            np.minimum.at(least, least[a], lower)
            np.minimum.at(least, least[b], lower)
            least = least[least]
    moved = np.flatnonzero(least != np.arange(len(rows)))
    return pa.RecordBatch.from_arrays([pa.array(rows[moved, 2]), pa.array(rows[least[moved], 2])], ["a", "b"])


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _mask(bits: list[int]) -> int:
    """Bit 0 is the lowest."""
    return _signed(sum(1 << b for b in bits))


def _splits(masks: list[int], distance: int) -> dict[int, F.Column]:
    """For each mask the masks that also fix one of ``distance`` + 1 parts of the bits it leaves free."""
    out = {}
    for mask in masks:
        free = [b for b in range(BITS) if not mask >> b & 1]
        parts = [free[i :: distance + 1] for i in range(distance + 1)]
        out[mask] = F.array(*[F.lit(_signed((mask | _mask(p)) % (1 << BITS))) for p in parts])
    return out


def probe_masks(prints: DataFrame, distance: int) -> list[int]:
    """Masks of the bits to agree in: of all allotments the one with the least estimated work."""
    both = _together(prints)
    total = prints.count()
    counts = [-(-(distance + 1) // 2) + i for i in range(2)]  # fewest groups with thresholds up to 1, and one more
    grouped = {n: bit_groups(both, total, n) for n in counts if n <= distance + 1}
    meet = _meeting(prints, [_mask(bits) for groups in grouped.values() for bits in groups])
    best: tuple[float, list[int]] | None = None
    for n, groups in grouped.items():
        costs = []
        for bits in groups:
            pairs = meet[_mask(bits)]
            # index rows and estimated candidates; with one bit free about twice the pairs meet, for each such bit
            costs.append({-1: 0.0, 0: total + pairs, 1: len(bits) * (total + 2 * pairs)})
        cost, thresholds = allot(costs, distance + 1 - n)
        if best is None or cost < best[0]:
            masks = []
            for bits, threshold in zip(groups, thresholds):
                if threshold == 0:
                    masks.append(_mask(bits))
                elif threshold == 1:
                    masks += [_mask([b for b in bits if b != free]) for free in bits]
            best = cost, masks
    return best[1]


def allot(costs: list[dict[int, float]], total: int) -> tuple[float, list[int]]:
    """One threshold per group, summing to ``total``, with the least cost: dynamic programming over the groups."""
    states: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for options in costs:
        reached: dict[int, tuple[float, list[int]]] = {}
        for sum_so_far, (cost, chosen) in states.items():
            for threshold, more in options.items():
                at, now = sum_so_far + threshold, (cost + more, [*chosen, threshold])
                if at not in reached or now < reached[at]:
                    reached[at] = now
        states = reached
    return states[total]


def _together(prints: DataFrame) -> np.ndarray:
    """How many fingerprints have both bits i and j, over all fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = np.zeros((BITS, BITS))
        for batch in batches:
            values = np.ascontiguousarray(batch.column("print").to_numpy()).astype("<i8")
            bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            both += bits.T @ bits
        i, j = np.triu_indices(BITS)
        counts = both[i, j].astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(i * BITS + j), pa.array(counts)], ["cell", "n"])

    cells = prints.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    out = np.zeros((BITS, BITS))
    for cell, n in cells:
        out[cell // BITS, cell % BITS] = out[cell % BITS, cell // BITS] = n
    return out


def bit_groups(both: np.ndarray, total: int, groups: int) -> list[list[int]]:
    """Groups of about equal width; each grows by the bit that varies most with those it has."""
    share = both / max(total, 1)
    single = np.diag(share)
    spread = np.sqrt(np.outer(single * (1 - single), single * (1 - single)))
    tie = np.divide(np.abs(share - np.outer(single, single)), spread, out=np.zeros_like(share), where=spread > 0)
    np.fill_diagonal(tie, 0)
    left, out = list(range(BITS)), []
    for n in range(groups):
        width = len(left) if n == groups - 1 else BITS * (n + 1) // groups - BITS * n // groups
        seed = max(left, key=lambda b: (tie[b, left].sum(), -b))
        group = [seed]
        left.remove(seed)
        while len(group) < width:
            group.append(max(left, key=lambda b: (tie[b, group].sum(), -b)))
            left.remove(group[-1])
        out.append(sorted(group))
    return out


def _meeting(prints: DataFrame, masks: list[int]) -> dict[int, float]:
    """Pairs of fingerprints that agree under each mask, counted over all fingerprints."""
    masked = prints.select("print", F.explode(F.array(*map(F.lit, masks))).alias("mask"))
    sizes = masked.groupBy("mask", F.col("print").bitwiseAND(F.col("mask")).alias("value")).count()
    n = F.col("count").cast("double")
    found = sizes.groupBy("mask").agg(F.sum(n * (n - 1) / 2).alias("pairs")).collect()
    return dict.fromkeys(masks, 0.0) | {mask: pairs for mask, pairs in found}
