"""From loose points to trips: segmentation, cleaning, quality, features, packing."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackline.functions.geo import haversine_km
from trackline.operators import slices

TRIP = ("entity", "seg")
ORDER = ("t", "id")


def segment_tracks(
    points: DataFrame,
    *,
    entity: str = "entity",
    order: Sequence[str] = ORDER,
    lon: str = "lon",
    lat: str = "lat",
    alt: str = "alt",
    out: str = "seg",
    gap_seconds: float = 1200,
    climb: float = 1500,
    jump_km: float = 40,
    floor_alt: float = 3000,
    edge: int = 5,
    valley: int = 3,
    align: str = "own",
    hot: DataFrame | None = None,
) -> DataFrame:
    """Number the trips of each entity by counting breaks along time.

    A low point (below ``floor_alt``) starts a new trip after a long gap, a sudden climb,
    a jump in space, or at the bottom of a valley in altitude; never within ``edge`` points
    of the entity's first or last point. Units are those of the columns: seconds,
    kilometres, and whatever altitude is in. ``align="shifted"`` puts the count of point i
    on point i-4 and leaves the last nine points without one. ``hot`` takes the result of
    ``hot_keys`` where several operators share it.
    """
    t = order[0]
    offsets = {
        "_prev_t": (t, -1),
        "_prev_alt": (alt, -1),
        "_prev_lon": (lon, -1),
        "_prev_lat": (lat, -1),
        "_before": (alt, -valley),
        "_after": (alt, valley),
        "_first_edge": (t, -edge),
        "_last_edge": (t, edge),
    }
    jump = haversine_km(F.col(lat), F.col(lon), F.col("_prev_lat"), F.col("_prev_lon"))
    cause = (
        (F.col(t) - F.col("_prev_t") > gap_seconds)
        | (F.col(alt) - F.col("_prev_alt") > climb)
        | (jump > jump_km)
        | ((F.col("_before") > F.col(alt)) & (F.col("_after") > F.col(alt)))
    )
    inner = F.col("_first_edge").isNotNull() & F.col("_last_edge").isNotNull()
    breaks = F.coalesce(inner & (F.col(alt) < floor_alt) & cause, F.lit(False))

    def compute(rows: DataFrame, slice_col: str | None) -> DataFrame:
        flagged = slices.neighbours(rows, [entity], order, offsets, slice_col)
        flagged = flagged.withColumn("_break", breaks.cast("bigint")).drop(*offsets)
        counted = slices.running_total(flagged, [entity], order, "_break", out, slice_col)
        if align == "shifted":
            counted = _shift_labels(counted, entity, order, out, slice_col)
        return counted.drop("_break")

    points = points.na.drop(subset=[entity, t])
    return slices.per_key(points, t, _hot(points, [entity], t, hot), compute)


def _hot(points: DataFrame, keys: Sequence[str], t: str, hot: DataFrame | None) -> DataFrame:
    return slices.hot_keys(points, keys, t) if hot is None else hot


def _shift_labels(
    rows: DataFrame, entity: str, order: Sequence[str], out: str, slice_col: str | None
) -> DataFrame:
    wanted = {"_four": (out, 4), "_nine": (out, 9), "_prev": (out, -1)}
    shifted = F.when(F.col("_nine").isNotNull(), F.col("_four")).when(
        F.col("_prev").isNull(), F.lit(0)
    )
    return (
        slices.neighbours(rows, [entity], order, wanted, slice_col)
        .withColumn(out, shifted)
        .drop(*wanted)
    )


def dedupe_points(
    points: DataFrame,
    *,
    keys: Sequence[str] = TRIP,
    order: Sequence[str] = ORDER,
    position: Sequence[str] = ("lat", "lon", "alt"),
    decimals: int = 4,
) -> DataFrame:
    """Round the position and keep the earliest point at each place of a trip."""
    rounded = points.withColumns({c: F.round(c, decimals) for c in position})
    group = [*keys, *position]
    rest = [c for c in points.columns if c not in group]
    earliest = F.min_by(F.struct(*rest), F.struct(*order))
    return (
        rounded.groupBy(*group)
        .agg(earliest.alias("_row"))
        .select(*[F.col(f"_row.{c}").alias(c) if c in rest else c for c in points.columns])
    )


def track_features(
    points: DataFrame,
    *,
    keys: Sequence[str] = TRIP,
    order: Sequence[str] = ORDER,
    lon: str = "lon",
    lat: str = "lat",
    alt: str = "alt",
) -> DataFrame:
    """One row per trip: ends in time and space, height, distance, duration, mean speed."""
    t, at = order[0], F.struct(*order)
    ends = points.groupBy(*keys).agg(
        F.min(t).alias("start"),
        F.max(t).alias("end"),
        F.min_by(lon, at).alias("start_lon"),
        F.max_by(lon, at).alias("end_lon"),
        F.min_by(lat, at).alias("start_lat"),
        F.max_by(lat, at).alias("end_lat"),
        F.greatest(F.lit(0.0), F.max(alt)).alias("max_alt"),
    )
    return ends.withColumns(
        {
            "distance": haversine_km(
                F.col("start_lat"), F.col("start_lon"), F.col("end_lat"), F.col("end_lon")
            ),
            "time": F.col("end") - F.col("start"),
        }
    ).withColumn("avg_speed", F.try_divide("distance", "time"))


def track_quality(
    points: DataFrame,
    *,
    keys: Sequence[str] = TRIP,
    order: Sequence[str] = ORDER,
    alt: str = "alt",
    min_points: int = 100,
    floor_alt: float = 3000,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Per trip: number of points and whether it climbs from and descends to the ground."""
    edge = slices.per_key(
        points.select(*keys, *order, alt),
        order[0],
        _hot(points, keys, order[0], hot),
        lambda rows, s: slices.end_rows(rows, keys, order, 6, 5, s),
    )

    def at(rank: str, position: int) -> Column:
        return F.max(F.when(F.col(rank) == position, F.col(alt)))

    ends = edge.groupBy(*keys).agg(
        F.max("_size").alias("n"),
        *[at("_rank", i).alias(f"_a{i}") for i in (1, 2, 4, 6)],
        *[at("_back", i).alias(f"_z{i}") for i in (1, 3, 5)],
    )
    rules = [
        F.col("n") >= min_points,
        F.col("_a1") < floor_alt,
        F.col("_z1") < floor_alt,
        F.col("_a2") < F.col("_a4"),
        F.col("_a4") < F.col("_a6"),
        F.col("_z5") > F.col("_z3"),
        F.col("_z3") > F.col("_z1"),
    ]
    return ends.select(
        *keys,
        "n",
        F.coalesce(reduce(lambda a, b: a & b, rules), F.lit(False)).alias("quality"),
    )


def collect_tracks(
    points: DataFrame,
    *,
    keys: Sequence[str] = TRIP,
    order: Sequence[str] = ORDER,
    fields: Sequence[str] = ("lon", "lat", "alt"),
    block_rows: int = 4096,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Pack a trip's points into sorted arrays of at most ``block_rows`` elements.

    One array of structs keeps the fields of a point together. ``block`` numbers the
    pieces of a trip, so that a trip of any length never becomes a single row.
    """

    def compute(rows: DataFrame, slice_col: str | None) -> DataFrame:
        numbered = slices.running_total(
            rows.withColumn("_one", F.lit(1)), keys, order, "_one", "_n", slice_col
        )
        return (
            numbered.withColumn("block", F.floor((F.col("_n") - 1) / block_rows))
            .groupBy(*keys, "block")
            .agg(F.array_sort(F.collect_list(F.struct(*order, *fields))).alias("points"))
        )

    return slices.per_key(
        points.select(*keys, *order, *fields),
        order[0],
        _hot(points, keys, order[0], hot),
        compute,
    )


def explode_tracks(tracks: DataFrame, *, points: str = "points") -> DataFrame:
    """One row per point of packed trips."""
    others = [c for c in tracks.columns if c != points]
    return tracks.select(*others, F.inline(points))


def track_extent(
    points: DataFrame, *, keys: Sequence[str] = TRIP, t: str = "t"
) -> DataFrame:
    """First and last whole second of each trip."""
    return points.groupBy(*keys).agg(
        F.min(t).cast("bigint").alias("first"), F.max(t).cast("bigint").alias("last")
    )
