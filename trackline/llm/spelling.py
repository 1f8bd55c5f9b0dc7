"""Spelling variants: words one edit apart, found by pivotal bigrams, and the form each word leads to.

Words are runs of letters, counted over all documents. Two words are near if one inserted, deleted or replaced
code point makes one of the other. Each word's bigrams are put in order of rarity (rarest first, over all words);
its prefix is its first three, and all that equal the third. Among the prefix dynamic programming picks the two
rarest bigrams that do not overlap, the pivots. One edit spoils at most one of two disjoint bigrams, so of two near words
that with the rarer end of prefix has a pivot in the prefix of the other: pivots are joined with prefixes on the
bigram, the position and the length, where lengths may differ by one and positions by no more than the
lengths. Pairs that meet are compared by the sets of their letters, then verified by edit distance.

A word's form is its near word with the largest number of occurrences (ties: smallest in code-point order) if
that has at least twice as many; following forms ends at the root, in rounds that double the distance.

Null and empty texts have no words; a null key counts as an empty text in the drawing of letters to delete. Repeated
rows count repeatedly. Texts may be of any length. Extra columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from trackline.llm.bpe import portions
from trackline.session import materialized

# One byte for each code point of A-Z, a-z and U+00C0 to U+00FF; everything else is a blank.
LETTERS = bytes(ord(chr(b).lower()) if chr(b).isascii() and chr(b).isalpha() else b if b >= 0xC0 else 0x20 for b in range(256))
GRAM = 2
EDITS = 1
PREFIX = GRAM * EDITS + 1  # of so many bigrams at least EDITS + 1 are disjoint
MOVES = [(0, 0), (0, 1), (1, 1), (0, -1), (-1, -1)]  # of a bigram's position, and of the length


def runs_of(text: str | None) -> list[bytes]:
    """Runs of letters, A-Z in lower case, as Latin-1."""
    return (text or "").encode("latin-1", "replace").translate(LETTERS).split()


def words(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    one_in: int | None = None,
    shortest: int = 5,
    least: int = 3,
    held: int = 1 << 19,
) -> DataFrame:
    """word and n: all words with at least ``shortest`` code points and ``least`` occurrences.

    With ``one_in`` a run loses a code point where the CRC-32 of "<key>:<run>" is divisible by it: that at
    the CRC-32 modulo the length. A task holds at most about ``held`` different words at a time.
    """

    def ready(found: Counter) -> pa.RecordBatch:
        kept = [w for w in found if len(w) >= shortest]
        texts = pa.array([w.decode("latin-1") for w in kept], pa.string())
        return pa.RecordBatch.from_arrays([texts, pa.array([found[w] for w in kept], pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in portions(batches, "text"):
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text")):
                own = Counter(runs_of(text.as_py()))
                if not one_in:
                    found.update(own)
                    continue
                start = zlib.crc32(f"{'' if key is None else key}:".encode())
                for word, n in own.items():
                    drawn = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
                    if drawn % one_in == 0:
                        at = drawn % len(word)
                        word = word[:at] + word[at + 1 :]
                    found[word] += n
                if len(found) >= held:
                    yield ready(found)
                    found.clear()
        yield ready(found)

    counted = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def bigrams(word: str) -> list[str]:
    return [word[i : i + GRAM] for i in range(len(word) - GRAM + 1)]


def prefix_of(word: str, ranks: dict[str, int]) -> list[tuple[int, int]]:
    """(rank, position) of the rarest bigrams, rarest first: the first three and all equal to the third."""
    ordered = sorted((ranks[g], at) for at, g in enumerate(bigrams(word)))
    last = ordered[min(PREFIX, len(ordered)) - 1][0]
    return [x for x in ordered if x[0] <= last]


def pivots_of(prefix: list[tuple[int, int]], cost: list[int], count: int = EDITS + 1) -> list[tuple[int, int]]:
    """Disjoint (rank, position) of ``prefix`` with the least total cost of their ranks: dynamic programming by position.

    ``best[k]`` after a bigram: the cheapest choice of k disjoint ones so far, with its cost.
    """
    by_place = sorted((at, rank) for rank, at in prefix)
    best: list[list] = []  # for each bigram, choices of 0 .. count
    for i, (at, rank) in enumerate(by_place):
        before = best[-1] if best else [(0, [])] + [None] * count
        apart = i - 1
        while apart >= 0 and by_place[apart][0] > at - GRAM:
            apart -= 1
        clear = best[apart] if apart >= 0 else [(0, [])] + [None] * count
        row = [(0, [])]
        for k in range(1, count + 1):
            options = [before[k]] if before[k] else []
            if clear[k - 1]:
                options.append((clear[k - 1][0] + cost[rank], [*clear[k - 1][1], (rank, at)]))
            row.append(min(options) if options else None)
        best.append(row)
    return best[-1][count][1]


def gram_ranks(known: DataFrame) -> tuple[dict[str, int], list[int]]:
    """Rank of each bigram, rarest first, and how many words have it; bounded by the square of the alphabet."""
    grams = F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring(F.col("word"), i, GRAM))
    found = known.select(F.explode(grams).alias("gram")).groupBy("gram").count().collect()
    ordered = sorted((n, gram) for gram, n in found)
    return {gram: rank for rank, (_, gram) in enumerate(ordered)}, [n for n, _ in ordered]


def indexed(known: DataFrame) -> DataFrame:
    """Rows (word, n, letters, size, last, pivot, rank, at): a word's prefix, and its pivots once more as such."""
    ranks, cost = gram_ranks(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for place, word in enumerate(batch.column("word").to_pylist()):
                letters = 0
                for c in word:
                    letters |= 1 << ord(c) % 63
                prefix = prefix_of(word, ranks)
                for pivot, grams in ((False, prefix), (True, pivots_of(prefix, cost))):
                    rows += [(place, letters, len(word), prefix[-1][0], pivot, rank, at) for rank, at in grams]
            columns = list(zip(*rows)) or [()] * 7
            place = pa.array(columns[0], pa.int64())
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("word").take(place), batch.column("n").take(place), *map(pa.array, columns[1:], kinds)],
                ["word", "n", "letters", "size", "last", "pivot", "rank", "at"],
            )

    schema = "word string, n long, letters long, size int, last int, pivot boolean, rank int, at int"
    return known.mapInArrow(run, schema)


def near_pairs(known: DataFrame) -> DataFrame:
    """Distinct pairs of near words: word, n, other, other_n, in one of the two orders."""
    rows = materialized(indexed(known))
    parts = int(known.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # small rows, much work: not to be coalesced
    # position and length that a pivot may have in a near word: unmoved, or moved where the length changed before it
    moves = F.array(*[F.struct(F.lit(a).alias("moved"), F.lit(b).alias("longer")) for a, b in MOVES])
    own = rows.where("pivot").withColumn("move", F.explode(moves))
    own = own.select("word", "n", "letters", "last", "rank", (F.col("at") + F.col("move.moved")).alias("at"),
                     (F.col("size") + F.col("move.longer")).alias("size"))
    names = {"word": "other", "n": "other_n", "letters": "other_letters", "last": "other_last"}
    others = rows.where("not pivot").select("rank", "at", "size", *[F.col(c).alias(d) for c, d in names.items()])
    keys = ["rank", "at", "size"]
    met = own.repartition(parts, *keys).join(others.repartition(parts, *keys), keys)
    met = met.where(F.col("last") <= F.col("other_last"))
    met = met.where(F.bit_count(F.col("letters").bitwiseXOR(F.col("other_letters"))) <= 2 * EDITS)
    near = met.where(F.levenshtein("word", "other", EDITS) == 1)
    # ends of prefix may be equal: then both directions are found
    first = F.col("word") < F.col("other")
    pair = [(F.when(first, a).otherwise(b), F.when(first, b).otherwise(a)) for a, b in
            ((F.col("word"), F.col("other")), (F.col("n"), F.col("other_n")))]
    return near.select(pair[0][0].alias("word"), pair[1][0].alias("n"), pair[0][1].alias("other"),
                       pair[1][1].alias("other_n")).distinct()


def variants(known: DataFrame, ratio: int = 2) -> DataFrame:
    """Words (word, n) with form, root, n_near and form_n."""
    known = materialized(known)
    pairs = materialized(near_pairs(known))
    turned = pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    order = F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("other"))
    near = pairs.unionByName(turned).groupBy("word").agg(F.count("*").alias("n_near"), F.min(order).alias("best"))
    found = known.join(near, "word", "left")
    enough = -F.col("best.less") >= ratio * F.col("n")
    found = materialized(
        found.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(enough, F.col("best.other")).alias("form"),
                     F.when(enough, -F.col("best.less")).alias("form_n"))
    )
    roots = followed(found.where("form is not null").select("word", F.col("form").alias("root")))
    found = found.join(roots, "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def followed(steps: DataFrame) -> DataFrame:
    """word and root: the end of each path of ``steps`` (without cycles: forms have ever more occurrences)."""
    while True:
        steps = materialized(steps)
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = materialized(steps.join(ahead, "root", "left"))
        if joined.where("further is not null").isEmpty():
            return steps
        steps = joined.select("word", F.coalesce("further", "root").alias("root"))
