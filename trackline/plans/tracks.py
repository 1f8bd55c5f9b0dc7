"""Queries on points and trips."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackline.functions.geo import haversine_km
from trackline.operators import slices, tracks
from trackline.plans.registry import query
from trackline.plans.views import SQL, Inputs
from trackline.session import materialized

# The given events are a day apart where transponder messages are seconds apart.
GAP_SECONDS = 86400
MIN_POINTS = 8

R = 6378.137


def sql_round(x: str, decimals: int) -> str:
    """Round half up on the shortest decimal text of a double, as Spark does."""
    text = f"CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 20))"
    return f"CAST(round({text}, {decimals}) AS DOUBLE)"


def sql_haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"2 * {R} * asin(sqrt(least(1.0, pow(sin(radians({lat1} - {lat2}) / 2), 2) + "
        f"cos(radians({lat1})) * cos(radians({lat2})) * "
        f"pow(sin(radians({lon1} - {lon2}) / 2), 2))))"
    )


SQL["segments"] = (
    "points",
    f"""SELECT id, entity, t, lon, lat, alt,
           CAST(sum(b) OVER (PARTITION BY entity ORDER BY t, id
                             ROWS UNBOUNDED PRECEDING) AS BIGINT) AS seg
    FROM (SELECT *, CASE WHEN lag(t, 5) OVER w IS NOT NULL AND lead(t, 5) OVER w IS NOT NULL
                 AND alt < 3000
                 AND (t - lag(t) OVER w > {GAP_SECONDS} OR alt - lag(alt) OVER w > 1500
                      OR {sql_haversine("lat", "lon", "lag(lat) OVER w", "lag(lon) OVER w")} > 40
                      OR (lag(alt, 3) OVER w > alt AND lead(alt, 3) OVER w > alt))
                 THEN 1 ELSE 0 END AS b
          FROM points WINDOW w AS (PARTITION BY entity ORDER BY t, id))""",
)
SQL["features"] = (
    "segments",
    f"""SELECT *, distance / nullif(time, 0) AS avg_speed FROM (
        SELECT *, {sql_haversine("start_lat", "start_lon", "end_lat", "end_lon")} AS distance,
               "end" - start AS time
        FROM (SELECT entity, seg, min(t) AS start, max(t) AS "end",
                     arg_min(lon, id) AS start_lon, arg_max(lon, id) AS end_lon,
                     arg_min(lat, id) AS start_lat, arg_max(lat, id) AS end_lat,
                     greatest(0.0::DOUBLE, max(alt)) AS max_alt
              FROM segments GROUP BY entity, seg))""",
)


def hot(i: Inputs) -> DataFrame:
    """Entities too large for one task; their trips are the only ones that can be."""
    return i.once("hot", lambda: materialized(slices.hot_keys(i.points(), ["entity"], "t")))


def segments(i: Inputs) -> DataFrame:
    return tracks.segment_tracks(i.points(), gap_seconds=GAP_SECONDS, hot=hot(i))


def features(i: Inputs) -> DataFrame:
    return tracks.track_features(segments(i))


@query("segment_tracks", "SELECT id, entity, seg FROM segments", "segments")
def _segment_tracks(i: Inputs) -> DataFrame:
    return segments(i).select("id", "entity", "seg")


@query(
    "segment_tracks_shifted",
    """SELECT id, entity, CASE WHEN lead(seg, 9) OVER w IS NOT NULL THEN lead(seg, 4) OVER w
                               WHEN lag(seg) OVER w IS NULL THEN 0 END AS seg
       FROM segments WINDOW w AS (PARTITION BY entity ORDER BY t, id)""",
    "segments",
)
def _segment_tracks_shifted(i: Inputs) -> DataFrame:
    return tracks.segment_tracks(
        i.points(), gap_seconds=GAP_SECONDS, align="shifted"
    ).select("id", "entity", "seg")


@query(
    "track_features",
    """SELECT entity, seg, start, "end", start_lon, end_lon, start_lat, end_lat, max_alt,
              round(distance, 6) AS distance, time, round(avg_speed, 9) AS avg_speed
       FROM features""",
    "features",
)
def _track_features(i: Inputs) -> DataFrame:
    return features(i).withColumns(
        {"distance": F.round("distance", 6), "avg_speed": F.round("avg_speed", 9)}
    )


@query(
    "haversine",
    f"""SELECT id, round({sql_haversine("lat", "lon", "lag(lat) OVER w", "lag(lon) OVER w")}, 6)
              AS step_km
       FROM points WINDOW w AS (PARTITION BY entity ORDER BY t, id)""",
    "points",
)
def _haversine(i: Inputs) -> DataFrame:
    def steps(rows: DataFrame, slice_col: str | None) -> DataFrame:
        back = {"_lat": ("lat", -1), "_lon": ("lon", -1)}
        return slices.neighbours(rows, ["entity"], ["t", "id"], back, slice_col)

    step = haversine_km(F.col("lat"), F.col("lon"), F.col("_lat"), F.col("_lon"))
    return slices.per_key(i.points(), "t", hot(i), steps).select(
        "id", F.round(step, 6).alias("step_km")
    )


@query(
    "dedupe_points",
    f"""SELECT min(id) AS id, entity, seg, min(t) AS t, lon1 AS lon, lat1 AS lat, alt1 AS alt
       FROM (SELECT *, {sql_round("lon", 1)} AS lon1, {sql_round("lat", 1)} AS lat1,
                    {sql_round("alt", 1)} AS alt1 FROM segments)
       GROUP BY entity, seg, lon1, lat1, alt1""",
    "segments",
)
def _dedupe_points(i: Inputs) -> DataFrame:
    return tracks.dedupe_points(segments(i), decimals=1)


@query(
    "track_quality",
    f"""SELECT entity, seg, n, coalesce(n >= {MIN_POINTS} AND a1 < 3000 AND z1 < 3000
              AND a2 < a4 AND a4 < a6 AND z5 > z3 AND z3 > z1, FALSE) AS quality
       FROM (SELECT entity, seg, count(*) AS n,
                    max(alt) FILTER (r = 1) AS a1, max(alt) FILTER (r = 2) AS a2,
                    max(alt) FILTER (r = 4) AS a4, max(alt) FILTER (r = 6) AS a6,
                    max(alt) FILTER (z = 1) AS z1, max(alt) FILTER (z = 3) AS z3,
                    max(alt) FILTER (z = 5) AS z5
             FROM (SELECT *, row_number() OVER (PARTITION BY entity, seg ORDER BY t, id) AS r,
                          row_number() OVER (PARTITION BY entity, seg
                                             ORDER BY t DESC, id DESC) AS z FROM segments)
             GROUP BY entity, seg)""",
    "segments",
)
def _track_quality(i: Inputs) -> DataFrame:
    return tracks.track_quality(segments(i), min_points=MIN_POINTS, hot=hot(i))


@query(
    "collect_tracks",
    """SELECT entity, seg, block, count(*) AS n,
              string_agg(CAST(id AS VARCHAR), ',' ORDER BY t, id) AS ids
       FROM (SELECT *, (row_number() OVER (PARTITION BY entity, seg ORDER BY t, id) - 1) // 16
                       AS block FROM segments)
       GROUP BY entity, seg, block""",
    "segments",
)
def _collect_tracks(i: Inputs) -> DataFrame:
    packed = tracks.collect_tracks(segments(i), block_rows=16, hot=hot(i))
    return packed.select(
        "entity",
        "seg",
        "block",
        F.size("points").cast("bigint").alias("n"),
        F.array_join(F.transform("points", lambda p: p["id"].cast("string")), ",").alias("ids"),
    )


@query("explode_tracks", "SELECT entity, seg, id, t, lon, lat, alt FROM segments", "segments")
def _explode_tracks(i: Inputs) -> DataFrame:
    packed = tracks.collect_tracks(segments(i), hot=hot(i))
    return tracks.explode_tracks(packed).drop("block")


@query(
    "track_extent",
    """SELECT entity, seg, CAST(floor(min(t)) AS BIGINT) AS "first",
              CAST(floor(max(t)) AS BIGINT) AS "last"
       FROM segments GROUP BY entity, seg""",
    "segments",
)
def _track_extent(i: Inputs) -> DataFrame:
    return tracks.track_extent(segments(i))


@query("union_days", "SELECT id, entity, t, lon, lat, alt FROM points", "points")
def _union_days(i: Inputs) -> DataFrame:
    """Early and late days read apart and put together again."""
    points = i.points()
    is_early = F.coalesce(F.col("t") < 1705276800, F.lit(False))  # no time: with the late ones
    early, late = points.filter(is_early), points.filter(~is_early)
    return early.unionByName(late)
