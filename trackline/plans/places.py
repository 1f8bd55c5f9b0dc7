"""Queries that match points and trips with places."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackline.operators import nearest
from trackline.plans.registry import query
from trackline.plans.tracks import features, sql_haversine, sql_round
from trackline.plans.views import SQL, Inputs
from trackline.session import materialized

SQL["spots"] = (
    "places",
    f"""SELECT min(name) AS name, lat, lon FROM (
          SELECT name, {sql_round("lat", 2)} AS lat, {sql_round("lon", 2)} AS lon FROM places)
        GROUP BY lat, lon""",
)


def sql_nearest(points: str, key: str, lat: str, lon: str) -> str:
    """All pairs and the best one of each point: the plain definition."""
    return f"""SELECT {key}, best.name AS place_name, best.lat AS place_lat,
                      best.lon AS place_lon, best.km AS place_km
        FROM (SELECT {key}, arg_min({{'name': s.name, 'lat': s.lat, 'lon': s.lon, 'km': s.km}},
                                    {{'km': s.km, 'name': s.name}}) AS best
              FROM (SELECT {key}, spots.*,
                           {sql_haversine("p.lat2", "p.lon2", "spots.lat", "spots.lon")} AS km
                    FROM (SELECT *, {sql_round(lat, 2)} AS lat2, {sql_round(lon, 2)} AS lon2
                          FROM {points}) p, spots) s
              GROUP BY {key})"""


def rounded(df: DataFrame, *columns: str, decimals: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, decimals) for c in columns})


@query(
    "nearest_place",
    f"""SELECT entity, seg, place_name, place_lat, place_lon, round(place_km, 6) AS place_km
        FROM ({sql_nearest("features", "entity, seg", "start_lat", "start_lon")})""",
    "features spots",
)
def _nearest_place(i: Inputs) -> DataFrame:
    trips = materialized(features(i))
    found = nearest.nearest_place(trips, i.places(), lat="start_lat", lon="start_lon")
    return rounded(
        found.select("entity", "seg", "place_name", "place_lat", "place_lon", "place_km"),
        "place_km",
    )


@query(
    "nearest_place_grid",
    f"""SELECT id, place_name, place_lat, place_lon, round(place_km, 6) AS place_km
        FROM ({sql_nearest("points", "id", "lat", "lon")})""",
    "points spots",
)
def _nearest_place_grid(i: Inputs) -> DataFrame:
    found = nearest.nearest_place(i.points(), i.places())
    return rounded(
        found.select("id", "place_name", "place_lat", "place_lon", "place_km"), "place_km"
    )
