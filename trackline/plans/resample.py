"""Queries on the time grid."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackline.operators import labels, resample
from trackline.plans.registry import query
from trackline.plans.tracks import segments, sql_round
from trackline.plans.views import SQL, Inputs
from trackline.session import materialized

STEP = 3600  # the given points are hours apart

SQL["ticks"] = (
    "segments",
    f"""SELECT entity, seg, CAST(round(t / {STEP}) AS BIGINT) AS tick,
               arg_min(lon, id) AS lon, arg_min(lat, id) AS lat, arg_min(alt, id) AS alt
        FROM segments GROUP BY entity, seg, CAST(round(t / {STEP}) AS BIGINT)""",
)
SQL["grid"] = (
    "ticks",
    """SELECT entity, seg, unnest(generate_series(lo, hi)) AS tick
       FROM (SELECT entity, seg, min(tick) AS lo, max(tick) AS hi FROM ticks
             GROUP BY entity, seg)""",
)
SQL["laid"] = (
    "grid ticks",
    """SELECT grid.*, ticks.tick AS known, lon, lat, alt
       FROM grid LEFT JOIN ticks USING (entity, seg, tick)""",
)
SQL["filled"] = (
    "laid",
    "SELECT entity, seg, tick, known, lon, lat, alt, "
    + ", ".join(
        f"last_value({c} IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        f" AS prev_{c}, first_value({c} IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND"
        f" UNBOUNDED FOLLOWING) AS next_{c}"
        for c in ("known", "lon", "lat", "alt")
    )
    + " FROM laid WINDOW w AS (PARTITION BY entity, seg ORDER BY tick)",
)
SQL["interpolated"] = (
    "filled",
    "SELECT entity, seg, tick, "
    + ", ".join(
        f"""CASE WHEN prev_known = next_known THEN {c} ELSE prev_{c} + (next_{c} - prev_{c})
            / (next_known - prev_known) * (tick - prev_known) END AS {c}"""
        for c in ("lon", "lat", "alt")
    )
    + " FROM filled",
)
SQL["airline_types"] = (
    "flights airlines",
    """SELECT airline, arg_min(type, rank) AS type FROM (
         SELECT airline, type, row_number() OVER (PARTITION BY airline
                                                  ORDER BY count(*) DESC, type) AS rank
         FROM flights JOIN airlines USING (entity) WHERE type IS NOT NULL
         GROUP BY airline, type) GROUP BY airline""",
)


def ticks(i: Inputs) -> DataFrame:
    return resample.time_bucket(segments(i), step=STEP)


def airline_types(i: Inputs) -> DataFrame:
    flights = labels.attach_airline(i.flights(), i.airlines())
    return labels.most_frequent(flights, ["airline"], "type")


@query("time_bucket", "SELECT * FROM ticks", "ticks")
def _time_bucket(i: Inputs) -> DataFrame:
    return ticks(i)


@query("time_grid", "SELECT * FROM grid", "grid")
def _time_grid(i: Inputs) -> DataFrame:
    return resample.time_grid(ticks(i))


@query("grid_join", "SELECT * FROM laid", "laid")
def _grid_join(i: Inputs) -> DataFrame:
    return resample.grid_join(materialized(ticks(i)))


@query("ffill_bfill", "SELECT * FROM filled", "filled")
def _ffill_bfill(i: Inputs) -> DataFrame:
    return resample.fill_gaps(materialized(ticks(i)))


@query(
    "interpolate",
    f"""SELECT entity, seg, tick, {sql_round("lon", 6)} AS lon, {sql_round("lat", 6)} AS lat,
               {sql_round("alt", 6)} AS alt FROM interpolated""",
    "interpolated",
)
def _interpolate(i: Inputs) -> DataFrame:
    rows = resample.interpolate(materialized(ticks(i)))
    return rows.withColumns({c: F.round(c, 6) for c in resample.VALUES})


@query(
    "resampled_labelled",
    f"""SELECT entity, seg, tick * {STEP} AS t, airline, type, {sql_round("lon", 4)} AS lon,
               {sql_round("lat", 4)} AS lat, {sql_round("alt", 4)} AS alt
        FROM interpolated JOIN airlines USING (entity) JOIN airline_types USING (airline)""",
    "interpolated airlines airline_types",
)
def _resampled_labelled(i: Inputs) -> DataFrame:
    return resample.resampled_labelled(
        materialized(ticks(i)), i.airlines(), airline_types(i), step=STEP
    )
