"""Near duplicates by HyperMinHash: banded compressed registers, corrected estimates, exact verification.

A document is the set of its word shingles (a shorter text is one shingle; a text without words, null or empty,
is the empty set and linked with nothing). The hashes of a set fall into 128 buckets by their first bits; a
register keeps of the least hash of its bucket the number of leading zeros (6 bits) and the 10 bits after the
leading one. An empty bucket takes the register of the first filled one in a random order of its own, so that two
registers agree with about the probability of the Jaccard similarity, also for small sets. Four registers
make a band (one long); sets that share one of the 32 bands are candidates. At similarity 0.8 no band is
shared with a probability of about 5e-8.

Candidates are estimated by the share of equal registers, corrected for registers that agree by chance, and those that
can be similar are verified with all their shingles. First every set meets the least one of each of its buckets.
Buckets that still hold several components are then compared inside: whole shingle sets come to the bucket, large
buckets are cut into pairs of chunks of bounded size, and a chunk gives at most one link for each
component in it, so that rows never grow with the square of a group (the comparing itself does, for sets that
share a band and are not connected).

Equal sets are one set from the start (128 bits of a digest). Rows are chosen, not ids: repeated keys are rows of
their own; a null key is a row whose component is named by the least key that is not null, if any. Other columns of the input are
not carried. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from trackline.llm.bpe import portions
from trackline.llm.components import stars
from trackline.session import materialized

SEED = 42
BUCKET_BITS, MANTISSA = 7, 10
REGISTERS = 1 << BUCKET_BITS
BANDS, WIDTH = 32, 4
_random = np.random.default_rng(SEED)
FACTORS = _random.integers(0, 1 << 64, 64, np.uint64) | np.uint64(1)
LENDERS = np.stack([_random.permutation(REGISTERS) for _ in range(REGISTERS)])
DEVIATIONS = 5.2  # about one pair in ten million lies further from its estimate


def shingles(text: str | None, words: int = 4) -> np.ndarray:
    """64-bit hashes of the different word shingles in ascending order."""
    parts = (text or "").encode("utf-8").lower().split()  # of bytes: A-Z only, blanks of ASCII only
    if not parts:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    single = np.array([digest(x, SEED) for x in parts], np.uint64)
    words = min(words, len(parts))
    count = len(parts) - words + 1
    mixed = np.zeros(count, np.uint64)
    for i in range(words):
        mixed += single[i : i + count] * FACTORS[i]
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
    return np.unique(mixed ^ (mixed >> np.uint64(31)))


def registers(hashes: np.ndarray) -> np.ndarray:
    """The registers (16 bits each) of a set that is not empty; ``hashes`` in ascending order."""
    bucket = (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])  # the least of each bucket
    rest = hashes[first] << np.uint64(BUCKET_BITS)
    zeros = np.minimum(63 - np.frexp(np.maximum(rest >> np.uint64(11), 1).astype(np.float64))[1] + 1 - 11, 63)
    after = rest << (zeros + 1).astype(np.uint64)
    kept = (zeros.astype(np.uint16) << np.uint16(MANTISSA)) | (after >> np.uint64(64 - MANTISSA)).astype(np.uint16)
    out = np.zeros(REGISTERS, np.uint16)
    filled = np.zeros(REGISTERS, bool)
    out[bucket[first]], filled[bucket[first]] = kept, True
    if len(first) < REGISTERS:
        lender = LENDERS[np.arange(REGISTERS), filled[LENDERS].argmax(1)]
        out = np.where(filled, out, out[lender])
    return out


def bands(found: np.ndarray) -> np.ndarray:
    return found.view(np.int64)  # four registers of 16 bits each


@functools.cache
def chance(one: int, other: int) -> float:
    """Probability that registers of unrelated sets of 2**one and 2**other elements agree."""
    zeros, width = np.arange(64 - BUCKET_BITS)[:, None], 2.0**-MANTISSA
    low = 2.0 ** -(zeros + 1) * (1 + np.arange(1 << MANTISSA) * width)
    high = low + 2.0 ** -(zeros + 1) * width
    cells = []
    for size in (one, other):
        each = max(2.0**size / REGISTERS, 1.0)
        cells.append(np.exp(each * np.log1p(-low)) - np.exp(each * np.log1p(-np.minimum(high, 1 - 1e-16))))
    return float((cells[0] * cells[1]).sum())


def estimate(equal: np.ndarray, sizes: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Jaccard similarity from numbers of equal registers and the sizes of the sets."""
    octaves = [np.round(np.log2(np.maximum(x, 1))).astype(np.int64) for x in (sizes, others)]
    (rows, row), (columns, column) = (np.unique(x, return_inverse=True) for x in octaves)
    by_chance = np.array([[chance(int(x), int(y)) for y in columns] for x in rows])
    by_chance = by_chance[row.reshape(sizes.shape), column.reshape(others.shape)]
    return (equal / REGISTERS - by_chance) / (1 - by_chance)


def least_estimate(similarity: float) -> float:
    """Registers that others borrow count repeatedly: half of them are taken as independent."""
    return similarity - DEVIATIONS * np.sqrt(similarity * (1 - similarity) / (REGISTERS / 2))


def similar(common: np.ndarray, sizes: np.ndarray, others: np.ndarray, similarity: float) -> np.ndarray:
    """Exact for similarities in whole hundredths."""
    percent = round(100 * similarity)
    return (common > 0) & (100 * common >= percent * (sizes + others - common))


def sketched(docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """Per row of ``docs``: row (a number), key, look (a hash of the text), high and low (a digest of the set), size, bands."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, "text"):
            high, low, sizes, found = [], [], [], []
            for x in batch.column("text"):
                hashes = shingles(x.as_py(), words)
                digest = xxhash.xxh128_intdigest(hashes.tobytes(), SEED)
                high.append(digest >> 64)
                low.append(digest & (1 << 64) - 1)
                sizes.append(len(hashes))
                found.append(bands(registers(hashes)) if len(hashes) else None)
            columns = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (high, low)]
            columns += [pa.array(sizes, pa.int64()), pa.array(found, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("look"), *columns], ["key", "look", "high", "low", "size", "bands"]
            )

    named = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("look"), F.col(text).alias("text"))
    found = named.mapInArrow(run, f"key {kind}, look long, high long, low long, size long, bands array<long>")
    return materialized(found.withColumn("row", F.monotonically_increasing_id()))


def shingled(docs: DataFrame, text: str, words: int, sets: DataFrame) -> DataFrame:
    """id and hashes (all shingles) of ``sets`` (id, look, high, low), from the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, "text"):
            high, low, found = [], [], []
            for x in batch.column("text"):
                hashes = shingles(x.as_py(), words)
                digest = xxhash.xxh128_intdigest(hashes.tobytes(), SEED)
                high.append(digest >> 64)
                low.append(digest & (1 << 64) - 1)
                found.append(hashes.tobytes())
            columns = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (high, low)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.binary())], ["high", "low", "hashes"])

    looks = sets.select("look").distinct()
    named = docs.select(F.xxhash64(text).alias("look"), F.col(text).alias("text")).join(looks, "look", "left_semi")
    one_each = named.groupBy("look").agg(F.min("text").alias("text")).select("text")
    found = one_each.mapInArrow(run, "high long, low long, hashes binary")
    return materialized(found.join(sets.select("high", "low", "id"), ["high", "low"]).select("id", "hashes"))


def verified(pairs: DataFrame, known: DataFrame, hashes: DataFrame, similarity: float) -> DataFrame:
    """The pairs a, b whose sets are similar: estimated first, then with all shingles."""
    least = least_estimate(similarity)

    def promising(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, other = (
                batch.column(c).flatten().to_numpy().reshape(-1, BANDS).view(np.uint16) for c in ("one", "other")
            )
            sizes, others = batch.column("size").to_numpy(), batch.column("size2").to_numpy()
            good = estimate((one == other).sum(1), sizes, others) >= least
            good &= 100 * np.minimum(sizes, others) >= round(100 * similarity) * np.maximum(sizes, others)
            yield batch.select(["a", "b"]).filter(pa.array(good))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for one, other in zip(batch.column("one"), batch.column("other")):
                x, y = (np.frombuffer(v.as_py(), np.uint64) for v in (one, other))
                common = len(np.intersect1d(x, y, assume_unique=True))
                good.append(bool(similar(np.int64(common), len(x), len(y), similarity)))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    def with_both(pairs: DataFrame, values: DataFrame, column: str) -> DataFrame:
        one = values.withColumnRenamed("id", "a").withColumnRenamed(column, "one")
        other = values.withColumnRenamed("id", "b").withColumnRenamed(column, "other").withColumnRenamed("size", "size2")
        return pairs.join(one, "a").join(other, "b")

    some = with_both(pairs, known.select("id", "size", "bands"), "bands")
    some = materialized(some.select("a", "b", "one", "other", "size", "size2").mapInArrow(promising, "a long, b long"))
    both = with_both(some, hashes, "hashes").select("a", "b", "one", "other")
    return materialized(both.mapInArrow(exact, "a long, b long"))


def inside(members: DataFrame, similarity: float) -> DataFrame:
    """Links a, b between roots of one chunk pair (columns band, value, pair; own, root, size, bands, hashes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        group = None
        for batch in batches:
            keys = np.column_stack([batch.column(c).to_numpy() for c in ("band", "value", "pair")])
            edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1), len(keys)]
            for begin, end in zip(edges, edges[1:]):
                if begin == end:
                    continue
                if held and tuple(keys[begin]) != group:
                    yield compared(pa.Table.from_batches(held), similarity)
                    held = []
                group = tuple(keys[begin])
                held.append(batch.slice(begin, end - begin))
        if held:
            yield compared(pa.Table.from_batches(held), similarity)

    dealt = members.repartition("band", "value", "pair").sortWithinPartitions("band", "value", "pair")
    return dealt.mapInArrow(run, "a long, b long")


def compared(group: pa.Table, similarity: float) -> pa.RecordBatch:
    """Each root of the group but the least of those it is connected with, and that least one.

    A group of two chunks compares one with the other, a group of one with itself.
    """
    own, roots, sizes = (group.column(c).to_numpy() for c in ("own", "root", "size"))
    left = np.flatnonzero(own == own[0])
    right = np.flatnonzero(own != own[0]) if len(left) < len(own) else left
    found = group.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, BANDS).view(np.uint16)
    equal = np.zeros((len(left), len(right)), np.uint8)
    for one, other in zip(found[left].T, found[right].T):
        equal += one[:, None] == other[None, :]
    good = estimate(equal, sizes[left, None], sizes[None, right]) >= least_estimate(similarity)
    good &= roots[left, None] != roots[None, right]
    left, right, good = left[good.any(1)], right[good.any(0)], good[np.ix_(good.any(1), good.any(0))]
    one = other = np.empty(0, np.int64)
    if len(left):
        sets = [[np.frombuffer(x, np.uint64) for x in group.column("hashes").take(i).to_pylist()] for i in (left, right)]
        near = good & similar(intersections(*sets), sizes[left, None], sizes[None, right], similarity)
        a, b = np.nonzero(near)
        one, other = roots[left[a]], roots[right[b]]
    nodes, places = np.unique(np.concatenate([one, other]), return_inverse=True)
    least = np.arange(len(nodes))
    a, b = places[: len(one)], places[len(one) :]
    while (least[a] != least[b]).any():
        lower = np.minimum(least[a], least[b])
        np.minimum.at(least, least[a], lower)
        np.minimum.at(least, least[b], lower)
        least = least[least]
    moved = np.flatnonzero(least != np.arange(len(nodes)))
    return pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(nodes[least[moved]])], ["a", "b"])


def intersections(one: list[np.ndarray], other: list[np.ndarray], block: int = 1 << 12) -> np.ndarray:
    """Sizes of the intersections of each of ``one`` with each of ``other``: products of blocks of incidence matrices."""
    shared = np.intersect1d(np.concatenate(one), np.concatenate(other))
    cells = []
    for sets in (one, other):
        owner, value = np.repeat(np.arange(len(sets)), [len(x) for x in sets]), np.concatenate(sets)
        column = np.searchsorted(shared, value)
        held = column < len(shared)
        held[held] = shared[column[held]] == value[held]
        order = np.argsort(column[held], kind="stable")
        cells.append((owner[held][order], column[held][order]))
    out = np.zeros((len(one), len(other)), np.int64)
    for begin in range(0, len(shared), block):
        parts = []
        for sets, (owner, column) in zip((one, other), cells):
            low, high = np.searchsorted(column, [begin, begin + block])
            part = np.zeros((len(sets), min(block, len(shared) - begin)), np.float32)
            part[owner[low:high], column[low:high] - begin] = 1
            parts.append(part)
        out += (parts[0] @ parts[1].T).astype(np.int64)
    return out


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    words: int = 4,
    similarity: float = 0.8,
    chunk_rows: int = 512,
    chunk_hashes: int = 1 << 20,
) -> DataFrame:
    """One row per document: ``key``, n_shingles, component_id (least key reachable), kept (it is that key)."""
    rows = sketched(docs, key, text, words)
    ids = materialized(
        rows.where("size > 0").groupBy("high", "low").agg(F.min("row").alias("id"), F.min("key").alias("least"))
    )
    known = materialized(rows.join(ids.select(F.col("id").alias("row")), "row").withColumnRenamed("row", "id").drop("key"))
    links = connected(docs, text, words, known, similarity, chunk_rows, chunk_hashes)
    root = stars(links).select(F.col("node").alias("id"), "root")
    rooted = materialized(ids.join(root, "id", "left").withColumn("root", F.coalesce("root", "id")))
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = materialized(rooted.join(names, "root").select("high", "low", "component_id"))
    component = F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("key"))
    found = rows.select("key", "high", "low", "size").join(named, ["high", "low"], "left")
    found = found.select(F.col("key").alias(key), F.col("size").alias("n_shingles"), component.alias("component_id"))
    return found.withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))


def connected(
    docs: DataFrame, text: str, words: int, known: DataFrame, similarity: float, chunk_rows: int, chunk_hashes: int
) -> DataFrame:
    """Links a, b that connect all similar sets among ``known`` (id, look, high, low, size, bands)."""
    probes = known.select("id", "size", F.posexplode("bands").alias("band", "value"))
    buckets = probes.groupBy("band", "value").agg(
        F.count("*").alias("n"), F.sum("size").alias("total"), F.min("id").alias("hub")
    )
    buckets = materialized(buckets.where("n > 1"))
    members = materialized(probes.join(buckets, ["band", "value"]))
    pairs = materialized(members.where("id > hub").select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct())
    near = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    hashes = shingled(docs, text, words, known.join(near, "id", "left_semi"))
    links = verified(pairs, known, hashes, similarity)

    root = stars(links).select(F.col("node").alias("id"), "root")
    rooted = members.join(root, "id", "left").withColumn("root", F.coalesce("root", "id"))
    rooted = materialized(rooted.select("band", "value", "id", "root", "n", "total"))
    several = rooted.groupBy("band", "value").agg(F.min("root").alias("one"), F.max("root").alias("other"))
    left = rooted.join(several.where("one < other").select("band", "value"), ["band", "value"], "left_semi")
    # every pair of chunks of a large bucket is a group of its own
    chunks = F.ceil(F.greatest(F.col("n") / chunk_rows, F.col("total") / chunk_hashes))
    own = F.pmod(F.xxhash64("id"), F.col("chunks"))
    pair = F.least("own", "every") * F.col("chunks") + F.greatest("own", "every")
    dealt = left.withColumn("chunks", chunks).withColumn("own", own)
    dealt = dealt.withColumn("every", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).withColumn("pair", pair)
    full = dealt.select("band", "value", "pair", "own", "id", "root").join(known.select("id", "size", "bands"), "id").join(hashes, "id")
    more = inside(full.select("band", "value", "pair", "own", "root", "size", "bands", "hashes"), similarity)
    return links.unionByName(materialized(more.distinct()))
