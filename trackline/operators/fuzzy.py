"""Best dictionary entry for a misspelled name.

The score of two texts is 100 * (1 - edit distance / length of the longer one), ignoring
case. So the longer length bounds the edits of a pair that can reach the cutoff, and each edit
spoils at most two pairs of letters (bigrams): a certain number of bigrams stands in both
texts, shifted by the edits at most. With a common order of the bigrams, rarest first, the
rarest of those is among the first few of either text. These few, the prefix, are indexed once
per text with their positions, so that the rows of a text grow with its length; names and entries
meet on a rare bigram at about the same place in texts of about the same length, and only
those are compared. Where lengths leave no common bigram, single letters take their place.
No pair that reaches the cutoff is missed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CUTOFF = 70


def fuzzy_match(
    names: DataFrame, dictionary: DataFrame, *, name: str, entry: str, cutoff: int = CUTOFF
) -> DataFrame:
    """One row per distinct name: ``match`` and ``score``, null where nothing reaches ``cutoff``.

    Of equal scores the first entry in alphabetical order wins.
    """
    wanted = names.select(F.col(name).alias("name")).na.drop().distinct()
    wanted = wanted.withColumn("text", F.lower("name"))
    # of entries that differ in case only the first stands for all
    entries = dictionary.select(F.col(entry).alias("entry")).na.drop()
    entries = entries.groupBy(F.lower("entry").alias("text")).agg(F.min("entry").alias("entry"))
    pairs = _meeting(wanted.select("text").distinct(), entries.select("text"), cutoff)
    longer = F.greatest(F.length("text"), F.length("other"))
    close = (
        pairs.withColumn("_edits", F.levenshtein("text", "other"))
        .filter(100 * (longer - F.col("_edits")) >= cutoff * longer)
        .select("text", "other", (100 * (1 - F.col("_edits") / longer)).alias("score"))
        .join(entries.withColumnRenamed("text", "other"), "other")
    )
    best = F.min_by(F.struct("entry", "score"), F.struct(-F.col("score"), F.col("entry")))
    found = wanted.join(close.groupBy("text").agg(best.alias("_best")), "text", "left")
    return found.select(
        F.col("name").alias(name),
        F.col("_best.entry").alias("match"),
        F.col("_best.score").alias("score"),
    )


def _meeting(names: DataFrame, entries: DataFrame, cutoff: int) -> DataFrame:
    """Pairs (text, other) of distinct texts that share a rare gram where similar ones would."""
    held = _grams(entries, cutoff)
    rarity = held.groupBy("_width", "_gram").agg(F.count(F.lit(1)).alias("_texts"))
    # a name looks into the length classes of all its partners
    first, last = (_class(bound, cutoff) for bound in _partner_lengths(F.col("_length"), cutoff))
    probes = prefixes(names, rarity, cutoff).withColumn("_class", F.explode(F.sequence(first, last)))
    index = prefixes(entries, rarity, cutoff).withColumn("_class", _class(F.col("_length"), cutoff))
    index = index.select(
        "_width", "_gram", "_class", *[F.col(c).alias(c + "2") for c in ("_at", "_length")],
        F.col("text").alias("other"),
    )
    longer = F.greatest("_length", "_length2")
    edits = _edits(longer, cutoff)
    return (
        probes.join(index, ["_width", "_gram", "_class"])
        .filter(F.col("_width") == _width(longer, cutoff))
        .filter(F.abs(F.col("_length") - F.col("_length2")) <= edits)
        .filter(F.abs(F.col("_at") - F.col("_at2")) <= edits)
        .select("text", "other")
        .distinct()
    )


def prefixes(texts: DataFrame, rarity: DataFrame, cutoff: int) -> DataFrame:
    """The grams a text is probed with: ``text``, _length, _width, _gram and its place _at.

    ``rarity`` tells in how many entries a gram stands. Grams as rare as the last one belong to
    the prefix as well, so that it holds all occurrences of what it holds.
    """
    order = F.struct(F.coalesce("_texts", F.lit(0)).alias("rank"), "_gram", "_at")
    ordered = (
        _grams(texts, cutoff)
        .join(rarity, ["_width", "_gram"], "left")
        .groupBy("text", "_width", "_length", "_count")
        .agg(F.sort_array(F.collect_list(order)).alias("_all"))
    )
    last = F.get("_all", F.least(F.size("_all"), F.col("_count")) - 1)
    kept = F.filter(
        "_all",
        lambda g: F.struct(g["rank"], g["_gram"]) <= F.struct(F.col("_last.rank"), F.col("_last._gram")),
    )
    return ordered.withColumn("_last", last).select(
        "text", "_length", "_width", F.inline(kept)
    ).drop("rank")


def _grams(texts: DataFrame, cutoff: int) -> DataFrame:
    """All grams of the widths a text needs, with the size of its prefix for each width.

    Of n grams at least k stand in any partner, where k depends on the longer length of the two;
    the rarest of those is among the first n - k + 1.
    """
    length, width = F.col("_length"), F.col("_width")
    _, longest = _partner_lengths(length, cutoff)
    fewest = F.array_min(
        F.transform(
            F.sequence(length, longest),
            lambda longer: F.when(_width(longer, cutoff) == width, _common(longer, width, cutoff)),
        )
    )
    place = F.explode(F.sequence(F.lit(1), length - width + 1))
    return (
        texts.select("text", F.length("text").alias("_length"))
        .filter(length > 0)
        .withColumn("_width", F.explode(F.array(F.lit(1), F.lit(2))))
        .withColumn("_count", length - width + 2 - fewest)  # null: no partner needs this width
        .filter((F.col("_count") > 0) & (length >= width))
        .withColumn("_at", place)
        .withColumn("_gram", F.substr("text", F.col("_at"), width))
    )


def _edits(longer: Column, cutoff: int) -> Column:
    """Most edits between two texts that reach the cutoff."""
    return F.floor(longer * (100 - cutoff) / 100).cast("int")


def _partner_lengths(length: Column, cutoff: int) -> tuple[Column, Column]:
    return F.ceil(length * cutoff / 100).cast("int"), F.floor(length * 100 / cutoff).cast("int")


def _common(longer: Column, width: Column, cutoff: int) -> Column:
    """So many grams at least stand in both of two texts that reach the cutoff."""
    return longer - width + 1 - width * _edits(longer, cutoff)


def _width(longer: Column, cutoff: int) -> Column:
    """Two letters where that leaves a common gram, else one, which always does."""
    return F.when(_common(longer, F.lit(2), cutoff) > 0, 2).otherwise(1)


def _class(length: Column, cutoff: int) -> Column:
    """Length classes so wide that partners are at most one apart (two at their borders)."""
    if cutoff == 100:
        return length
    return F.floor(F.log(length.cast("double")) / math.log(100 / cutoff)).cast("int")


def attach_model(
    aircraft: DataFrame,
    matches: DataFrame,
    dictionary: DataFrame,
    *,
    key: str,
    model: str = "model",
    entry: str = "name",
) -> DataFrame:
    """Each aircraft with a model once, with the dictionary entry of its match, or "else".

    Of several rows of an aircraft the least one is kept, by model and then the other columns.
    """
    others = [c for c in aircraft.columns if c not in (key, model)]
    known = (
        aircraft.filter(F.col(model).isNotNull())
        .groupBy(key)
        .agg(F.min(F.struct(model, *others)).alias("_row"))
        .select(key, "_row.*")
    )
    return (
        known.join(matches.select(model, "match"), model, "left")
        .join(dictionary.withColumnRenamed(entry, "match"), "match", "left")
        .na.fill("else", ["match"])
    )
