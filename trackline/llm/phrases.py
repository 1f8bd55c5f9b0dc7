"""Phrase mining with stripes: each prefix keys an associative counter of its next words.

A text is cut into pieces at punctuation and line breaks, and those into words at blanks and tabs; A-Z count as a-z.
For each length from 1 to ``longest`` a pass makes stripes (language, prefix, part): the occurrences of
the prefix and, for each promising next word, how often it follows. Stripes are merged elementwise, in sorted order,
one at a time. The stripe of the empty prefix counts words. One merged structure then gives the phrases with
their counts (prefix and next word), the counts of their parts (totals of prefixes), and the largest count among the longer
phrases that hold one (maximum of a stripe to the right, of the last words of prefix and next word to the left).

A next word is promising if the words up to it and those from the second on are both frequent: a phrase is
never more frequent than its parts, so nothing is lost. The frequent phrases of a length reach the next
pass as a bitmap of fixed size (``filter_bits``), however many they are; false positives only cost
work, and all counts are exact. Stripes of very frequent prefixes (a second bitmap, so that all tasks agree) and of the
empty one are cut into parts by a hash of the next word.

Null texts count as empty, a null language as "und" (together with that). Repeated rows count repeatedly. Texts
may be of any length; a portion of them is counted at a time. Extra columns are not read. An empty table gives an
empty result. Ties in score and count are ordered by the phrase.
"""

from __future__ import annotations

import functools
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from trackline.llm.bpe import portions
from trackline.session import materialized

SEED = 42
PARTS = 64
FACTORS = np.random.default_rng(SEED).integers(0, 1 << 64, 16, np.uint64) | np.uint64(1)
BREAK = b"."
SEPARATORS = bytes(BREAK[0] if chr(b) in ".,;:!?\n\v\f\r" else b for b in range(256))
STRIPE = "lang string, prefix string, part int, total long, nexts array<string>, counts array<long>"
COLUMNS = ["lang", "prefix", "part", "total", "nexts", "counts"]
# On the way to the merge: next words in one text (words have no blanks), counts as 32-bit numbers in one binary.
PACKED = "lang string, prefix string, part int, total long, nexts string, counts binary"


def hash_of(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, SEED)


def phrase_hashes(lang: str, words: list[np.ndarray]) -> np.ndarray:
    """64-bit hashes of phrases, from the hashes of their words."""
    mixed = np.full(len(words[0]), hash_of(lang.encode()) ^ len(words), np.uint64)
    for word, factor in zip(words, FACTORS):
        mixed = mixed + word * factor
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return mixed ^ (mixed >> np.uint64(29))


def in_bitmap(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes & np.uint64(64 * len(bitmap) - 1)
    return (bitmap[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def tokens(text: bytes) -> list[bytes]:
    """Words, with a mark at each border of pieces."""
    return text.lower().translate(SEPARATORS).replace(BREAK, b" . ").split()


def _stripes_of(lang: str, texts: list[str], length: int, frequent: np.ndarray | None, heavy: np.ndarray | None):
    """Stripes of a portion of texts of one language, as columns."""
    number: defaultdict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    number[BREAK] = 0
    words = tokens(b" . ".join(x.encode() for x in texts))
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    del words
    hashes = np.array([hash_of(w) for w in number], np.uint64)
    names = pa.array(list(number), pa.binary()).cast(pa.string())
    size = len(number)

    def windows(width: int) -> tuple[np.ndarray, np.ndarray]:
        """Where windows of ``width`` words lie inside a piece, and whether each is frequent."""
        inside = ids != 0
        count = max(len(ids) - width + 1, 0)
        ok = np.ones(count, bool)
        for i in range(width):
            ok &= inside[i : i + count]
        at = np.flatnonzero(ok)
        return at, in_bitmap(frequent, phrase_hashes(lang, [hashes[ids[at + i]] for i in range(width)])) if width else None

    if length == 1:
        counts = np.bincount(ids, minlength=size)[1:]
        nexts = np.arange(1, size)
        part = (hashes[1:] % np.uint64(PARTS)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        rows = np.arange(PARTS)
        totals = np.where(rows == 0, counts.sum(), 0)
        prefixes = pa.array([""] * PARTS)
        return _columns(lang, prefixes, rows, totals, np.searchsorted(part[order], [*rows, PARTS]), names, nexts[order], counts[order])

    width = length - 1
    at, good = windows(width)
    promising = np.zeros(len(ids) + 1, bool)  # by where a frequent window begins
    promising[at[good]] = True
    at = at[good]
    code = np.zeros(len(at), np.int64)
    for i in range(width):
        code = code * size + ids[at + i]
    values, prefix, totals = np.unique(code, return_inverse=True, return_counts=True)
    of_prefix = []
    for _ in range(width):
        values, last = np.divmod(values, size)
        of_prefix.insert(0, last)
    large = in_bitmap(heavy, phrase_hashes(lang, [hashes[x] for x in of_prefix])) if len(totals) else np.zeros(0, bool)
    # where the words from the second on are a frequent window too, the next word is promising
    go_on = promising[at + 1]
    begin, prefix = at[go_on], prefix[go_on]
    following = ids[begin + width]
    part = np.where(large[prefix], (hashes[following] % np.uint64(PARTS)).astype(np.int64), 0)
    cells, counts = np.unique((prefix * PARTS + part) * size + following, return_counts=True)
    stripe, following = np.divmod(cells, size)
    rows = np.union1d(stripe, np.arange(len(totals)) * PARTS)
    owner, part = np.divmod(rows, PARTS)
    texts_of = functools.reduce(
        lambda a, b: pc.binary_join_element_wise(a, b, " "), [names.take(pa.array(x[owner])) for x in of_prefix]
    )
    borders = np.searchsorted(stripe, [*rows, len(totals) * PARTS])
    return _columns(lang, texts_of, part, np.where(part == 0, totals[owner], 0), borders, names, following, counts)


def _columns(lang, prefixes, part, totals, borders, names, nexts, counts) -> pa.RecordBatch:
    words = pa.ListArray.from_arrays(pa.array(borders, pa.int32()), names.take(pa.array(nexts)))
    places = pa.py_buffer(np.asarray(borders, np.int32) * 4)
    packed = pa.Array.from_buffers(pa.binary(), len(part), [None, places, pa.py_buffer(np.asarray(counts, np.int32))])
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(part), pa.string()), prefixes.cast(pa.string()), pa.array(part, pa.int32()),
         pa.array(totals, pa.int64()), pc.binary_join(words, " "), packed],
        COLUMNS,
    )


def _unpacked(batch: pa.RecordBatch) -> pa.Table:
    """Packed stripes as arrays of next words and counts."""
    texts, packed = batch.column("nexts"), batch.column("counts")
    sizes = pc.binary_length(packed).to_numpy() // 4
    borders = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
    words = pc.split_pattern(texts.filter(pa.array(sizes > 0)), " ").flatten()  # no words are one empty text
    counts = np.frombuffer(b"".join(packed.to_pylist()), np.int32).astype(np.int64)
    lists = [pa.ListArray.from_arrays(borders, x) for x in (words, pa.array(counts))]
    return pa.table([*(batch.column(c) for c in COLUMNS[:4]), *lists], COLUMNS)


def merged(stripes: DataFrame, least: int) -> DataFrame:
    """One stripe per (lang, prefix, part), added up elementwise; next words below ``least`` occurrences go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last stripe so far; it may go on
        for batch in batches:
            rows = _unpacked(batch)
            done = _added_up(rows if held is None else pa.concat_tables([held, rows]))
            if done.num_rows > 1:
                yield from _frequent(done.slice(0, done.num_rows - 1), least).to_batches()
            held = done.slice(done.num_rows - 1) if done.num_rows else None
        if held is not None:
            yield from _frequent(held, least).to_batches()

    keys = ["lang", "prefix", "part"]
    return stripes.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, STRIPE)


def _added_up(rows: pa.Table) -> pa.Table:
    """Rows of equal keys (they are neighbours) as one each."""
    rows = rows.combine_chunks()
    if not rows.num_rows:
        return rows
    changed = np.zeros(rows.num_rows - 1, bool)
    for c in COLUMNS[:3]:
        column = rows.column(c).chunk(0)
        changed |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
    group = np.cumsum(np.r_[False, changed])
    first = np.flatnonzero(np.r_[True, changed])
    lists = rows.column("nexts").chunk(0)
    entries = pa.table({
        "group": pa.array(np.repeat(group, pc.list_value_length(lists).to_numpy())),
        "next": lists.flatten(),
        "count": rows.column("counts").chunk(0).flatten(),
    }).group_by(["group", "next"]).aggregate([("count", "sum")]).sort_by("group")
    totals = np.zeros(len(first), np.int64)
    np.add.at(totals, group, rows.column("total").to_numpy())
    return _table(rows.take(pa.array(first)), totals, entries["group"].to_numpy(), entries["next"], entries["count_sum"])


def _frequent(rows: pa.Table, least: int) -> pa.Table:
    rows = rows.combine_chunks()
    lists, counts = rows.column("nexts").chunk(0), rows.column("counts").chunk(0).flatten()
    kept = np.flatnonzero(counts.to_numpy() >= least)
    owner = np.repeat(np.arange(rows.num_rows), pc.list_value_length(lists).to_numpy())[kept]
    kept = pa.array(kept)
    return _table(rows, rows.column("total").to_numpy(), owner, lists.flatten().take(kept), counts.take(kept))


def _table(keys: pa.Table, totals: np.ndarray, owner: np.ndarray, nexts, counts) -> pa.Table:
    borders = pa.array(np.searchsorted(owner, np.arange(len(totals) + 1)), pa.int32())
    flat = [x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in (nexts, counts)]
    lists = [pa.ListArray.from_arrays(borders, x) for x in flat]
    return pa.table([*(keys.column(c) for c in COLUMNS[:3]), pa.array(totals), *lists], COLUMNS)


def bitmap(phrases: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of 2**bits bits of the hashes of ``phrases`` (lang, phrase); its size is all that reaches the driver."""
    mask = np.uint64((1 << bits) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.empty(batch.num_rows, np.uint64)
            phrases = [x.split(" ") for x in batch.column("phrase").to_pylist()]
            langs, sizes = np.array(batch.column("lang").to_pylist(), object), np.array([len(x) for x in phrases])
            for lang, size in set(zip(langs, sizes)):  # few of both
                at = np.flatnonzero((langs == lang) & (sizes == size))
                words = [np.array([hash_of(phrases[i][k].encode()) for i in at], np.uint64) for k in range(size)]
                found[at] = phrase_hashes(lang, words)
            at = found & mask
            cells = (at >> np.uint64(6)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cells), pa.array((np.uint64(1) << (at & np.uint64(63))).view(np.int64))], ["cell", "bits"]
            )

    cells = phrases.mapInArrow(run, "cell long, bits long").groupBy("cell").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[cells["cell"].to_numpy()] = cells["bits"].to_numpy().view(np.uint64)
    return out


def stripes(
    docs: DataFrame, lang: str = "lang", text: str = "text", longest: int = 4, least: int = 30,
    filter_bits: int = 26, heavy: int = 100_000, portion: int = 1 << 23,
) -> list[DataFrame]:
    """Merged stripes for phrases of 1 to ``longest`` words; next words in them occur ``least`` times or more."""
    named = docs.select(F.coalesce(lang, F.lit("und")).alias("lang"), F.coalesce(text, F.lit("")).alias("text"))
    context = docs.sparkSession.sparkContext
    out: list[DataFrame] = []
    filters = None
    for length in range(1, longest + 1):
        made = merged(named.mapInArrow(_counter(length, filters, portion), PACKED), least)
        out.append(materialized(made))
        if length < longest:
            found = materialized(entries(out[-1]).select("lang", F.array_join("words", " ").alias("phrase"), "a"))
            both = bitmap(found, filter_bits), bitmap(found.where(F.col("a") >= heavy), filter_bits)
            filters = context.broadcast(both)
    return out


def _counter(length: int, filters, portion: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, heavy = filters.value if filters else (None, None)
        for batch in portions(batches, "text", portion):
            of_lang = defaultdict(list)
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                of_lang[lang].append(text)
            while of_lang:
                lang, texts = of_lang.popitem()
                yield _stripes_of(lang, texts, length, frequent, heavy)

    return run


def entries(stripes: DataFrame) -> DataFrame:
    """lang, words (an array) and a (occurrences) of the phrases in stripes."""
    each = stripes.select("lang", "prefix", F.explode(F.arrays_zip("nexts", "counts")).alias("entry"))
    before = F.filter(F.split("prefix", " "), lambda w: w != "")
    return each.select(
        "lang", F.concat(before, F.array(F.col("entry.nexts"))).alias("words"), F.col("entry.counts").alias("a")
    )


def _phrase(words: Column) -> Column:
    return F.array_join(words, " ")


def collocations(
    docs: DataFrame, lang: str = "lang", text: str = "text", longest: int = 4, least: int = 30, share: int = 80,
    top: int = 2000, **how,
) -> DataFrame:
    """Per language the ``top`` phrases by score: lang, rank, phrase, a, l, r, n, score.

    score: 2 000 000 a / (l + r) for the weakest cut into a first part and a rest, rounded down. A phrase goes
    if a longer one that holds it has ``share`` percent of its occurrences or more.
    """
    levels = stripes(docs, lang, text, longest, least, **how)
    n = levels[0].groupBy("lang").agg(F.sum("total").alias("n"))
    joined = functools.reduce(DataFrame.unionByName, levels[1:])
    found = entries(joined).withColumn("phrase", _phrase(F.col("words")))
    totals = joined.where("part = 0").select("lang", F.col("prefix").alias("phrase"), "total")
    # the largest count of a phrase longer by one word: longer ones still are in those, and no more frequent
    size = F.size("words")
    right = joined.where(F.size("counts") > 0).select("lang", F.col("prefix").alias("phrase"), F.array_max("counts").alias("most"))
    left = found.where(size > 2).select("lang", _phrase(F.slice("words", 2, size - 1)).alias("phrase"), F.col("a").alias("most"))
    most = right.unionByName(left).groupBy("lang", "phrase").agg(F.max("most").alias("most"))
    kept = found.join(most, ["lang", "phrase"], "left")
    held = 100 * _wide(F.coalesce("most", F.lit(0))) >= share * _wide(F.col("a"))
    kept = materialized(kept.where(~held).select("lang", "phrase", "words", "a"))

    cut = kept.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
    cut = cut.withColumn("first", _phrase(F.slice("words", 1, F.col("k"))))
    cut = cut.withColumn("rest", _phrase(F.slice("words", F.col("k") + 1, size - F.col("k")))).drop("words")
    cut = cut.join(totals.select("lang", F.col("phrase").alias("first"), F.col("total").alias("l")), ["lang", "first"])
    cut = cut.join(totals.select("lang", F.col("phrase").alias("rest"), F.col("total").alias("r")), ["lang", "rest"])
    score = F.expr("CAST(2000000 AS DECIMAL(10,0)) * CAST(a AS DECIMAL(20,0)) DIV (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))")
    weakest = F.min(F.struct(score.cast("long").alias("score"), "k", "l", "r")).alias("weakest")
    scored = cut.groupBy("lang", "phrase", "a").agg(weakest).select("lang", "phrase", "a", "weakest.*")
    best = _best(_best(scored, top, F.col("lang"), F.pmod(F.xxhash64("phrase"), F.lit(PARTS))), top, F.col("lang"))
    return best.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _wide(value: Column) -> Column:
    return value.cast("decimal(20,0)")


def _best(scored: DataFrame, top: int, *within: Column) -> DataFrame:
    order = Window.partitionBy(*within).orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return scored.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)


def sql(longest: int = 4, least: int = 30, share: int = 80, top: int = 2000) -> str:
    """The same on a table ``documents`` (lang, text) in SQL."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), '{upper}', '{lower}'), '[.,;:!?\\n\\v\\f\\r]')) AS piece
  FROM documents
), worded AS (
  SELECT lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda x: x <> '') AS words FROM pieces
), grams AS (
  SELECT lang, size, unnest(list_transform(range(1, len(words) - size + 2), lambda i: words[i : i + size - 1])) AS words
  FROM worded, range(1, {longest + 1}) AS s(size)
), counted AS (
  SELECT lang, words, len(words) AS size, count(*) AS f FROM grams GROUP BY ALL
), candidates AS (
  SELECT *, array_to_string(words, ' ') AS phrase FROM counted WHERE size >= 2 AND f >= {least}
), kept AS (
  SELECT c.* FROM candidates c WHERE NOT EXISTS (
    SELECT 1 FROM candidates x WHERE x.lang = c.lang AND x.size > c.size
      AND 100 * x.f::HUGEINT >= {share} * c.f::HUGEINT AND contains(' ' || x.phrase || ' ', ' ' || c.phrase || ' '))
), cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, k, x.f AS l, y.f AS r, ((2000000 * c.f::HUGEINT) // (x.f + y.f))::BIGINT AS score
  FROM kept c, range(1, {longest}) AS t(k), counted x, counted y
  WHERE k < c.size AND x.lang = c.lang AND x.words = c.words[1 : k] AND y.lang = c.lang AND y.words = c.words[k + 1 :]
), weakest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM weakest
)
SELECT lang, rank, phrase, a, l, r, n, score
FROM ranked JOIN (SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE size = 1 GROUP BY lang) USING (lang)
WHERE rank <= {top}
"""
