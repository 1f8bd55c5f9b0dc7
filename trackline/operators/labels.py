"""Give trips an airline, a label, and features to learn the label from."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackline.functions.sun import DAY, sun
from trackline.operators.ranking import hashed_sample


def most_frequent(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The most frequent value per key; equal counts go to the smaller value."""
    counts = df.na.drop(subset=[*keys, value]).groupBy(*keys, value).agg(
        F.count(F.lit(1)).alias("_n")
    )
    return counts.groupBy(*keys).agg(
        F.min_by(value, F.struct(-F.col("_n"), F.col(value))).alias(value)
    )


def attach_airline(trips: DataFrame, airlines: DataFrame, entity: str = "entity") -> DataFrame:
    """Trips whose entity has an airline, with that airline."""
    return trips.join(airlines, entity)


def attach_type(trips: DataFrame, types: DataFrame, airline: str = "airline") -> DataFrame:
    """All trips, with the type of their airline where it is known."""
    return trips.join(types, airline, "left")


def label_fill(
    trips: DataFrame, predicted: DataFrame, *, key: str, label: str = "type"
) -> DataFrame:
    """Keep known labels and take the predicted one where there is none.

    Of several predictions for a key the most frequent one counts, the smaller of two.
    """
    guesses = predicted.groupBy(key).agg(F.mode(label, deterministic=True).alias("_guess"))
    return (
        trips.join(guesses, key, "left")
        .withColumn(label, F.coalesce(label, "_guess"))
        .drop("_guess")
    )


def daylight_features(
    trips: DataFrame,
    *,
    start: Sequence[str] = ("t0", "start_lon", "start_lat"),
    end: Sequence[str] = ("t1", "end_lon", "end_lat"),
) -> DataFrame:
    """Add for either end whether it is by day, and the days since sunrise and sunset."""
    ends = {"start": start, "end": end}
    suns = {f"_{e}": sun(F.col(t), F.col(lon), F.col(lat)) for e, (t, lon, lat) in ends.items()}
    added = {}
    for name, (t, _, _) in ends.items():
        rise, set_, time = F.col(f"_{name}.rise"), F.col(f"_{name}.set"), F.col(t)
        added |= {
            f"{name}area": ((rise < time) & (time <= set_)).cast("int"),
            f"{name}_sunrise": (time - rise) / DAY,
            f"{name}_sunset": (time - set_) / DAY,
        }
    return trips.withColumns(suns).withColumns(added).drop(*suns)


def sigma_clip(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Drop rows more than three deviations off in any feature, clip the rest to two.

    Rows that lack one of the features go as well, as nothing tells how far off they are.
    The two numbers per feature are fetched first, so the limits are constants that the
    scan can filter by.
    """
    stats = df.agg(
        *[F.struct(F.avg(f).alias("mean"), F.stddev_pop(f).alias("sd")).alias(f) for f in features]
    ).first()
    clipped = {}
    for feature in features:
        mean, sd = stats[feature]["mean"], stats[feature]["sd"]
        if mean is None:  # no value at all
            return df.limit(0)
        df = df.filter(F.col(feature).between(mean - 3 * sd, mean + 3 * sd))
        low, high = F.lit(mean - 2 * sd), F.lit(mean + 2 * sd)
        clipped[feature] = F.least(F.greatest(F.col(feature), low), high)
    return df.withColumns(clipped)


def balance_sample(
    trips: DataFrame,
    *,
    ratio: float = 3.5,
    label: str = "type",
    entity: str = "entity",
    order: Sequence[str] = ("t0", "flight"),
    seed: str = "",
) -> DataFrame:
    """All positive trips, and ``ratio`` times as many negative ones of different entities.

    A negative entity is represented by its first trip; which entities are taken depends on
    a hash of the entity, so the sample is the same in every run.
    """
    positive = trips.filter(F.col(label) == 1)
    first = F.min_by(F.struct(*trips.columns), F.struct(*order)).alias("_row")
    negative = trips.filter(F.col(label) == 0).groupBy(entity).agg(first).select("_row.*")
    n = math.floor(ratio * positive.count())
    return positive.unionByName(hashed_sample(negative, entity, n, seed))
