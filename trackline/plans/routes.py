"""Queries on routes and their main trips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackline.operators import labels, medoid, routes, tracks
from trackline.plans.places import rounded, sql_nearest
from trackline.plans.registry import query
from trackline.plans.resample import airline_types
from trackline.plans.tracks import sql_round
from trackline.plans.views import SQL, Inputs
from trackline.session import materialized

CELL = {"lon": 0, "lat": -1}

SQL["journey_cells"] = (
    "journeys",
    f"""SELECT entity, seg, cell, min(id) AS visit
        FROM (SELECT *, chr(75 + CAST({sql_round("lon", 0)} AS INTEGER)) AS cell FROM journeys)
        GROUP BY entity, seg, cell""",
)
SQL["journey_routes"] = (
    "journeys",
    "SELECT entity, seg, CASE WHEN entity % 3 = 0 THEN 1 ELSE 0 END AS type, "
    + ", ".join(
        f"""concat(CAST(CAST({sql_round(f"{pick}(lon, id)", -1)} AS INTEGER) AS VARCHAR), ',',
                   CAST(CAST({sql_round(f"{pick}(lat, id)", -1)} AS INTEGER) AS VARCHAR))
            AS "{name}" """
        for name, pick in (("start", "arg_min"), ("end", "arg_max"))
    )
    + " FROM journeys GROUP BY entity, seg",
)
SQL["coded"] = (
    "journey_cells journey_routes",
    """SELECT r.*, code FROM journey_routes r JOIN (
         SELECT entity, seg, string_agg(cell, '' ORDER BY visit) AS code
         FROM journey_cells GROUP BY entity, seg) USING (entity, seg)
       WHERE (r.start, r."end") IN (SELECT (start, "end") FROM journey_routes
                                    GROUP BY start, "end" HAVING sum(type) <> 0)""",
)
SQL["medoids"] = (
    "coded",
    """SELECT * FROM (
         SELECT a.entity, a.seg, a.start, a."end", a.type,
                CAST(sum(levenshtein(a.code, b.code)) AS BIGINT) AS total
         FROM coded a JOIN coded b ON a.start = b.start AND a."end" = b."end"
         GROUP BY ALL)
       QUALIFY total = min(total) OVER (PARTITION BY start, "end")""",
)


def journey_routes(i: Inputs) -> DataFrame:
    ends = tracks.track_features(i.journeys())

    def band(end: str) -> Column:
        return F.concat_ws(
            ",", *[F.round(f"{end}_{c}", -1).cast("int").cast("string") for c in ("lon", "lat")]
        )

    return ends.select("entity", "seg", band("start").alias("start"), band("end").alias("end")).join(
        i.journey_types(), ["entity", "seg"]
    )


def coded(i: Inputs) -> DataFrame:
    """Journeys on routes with some labelled journey, as text over the cells passed."""
    trips = materialized(routes.routes_with_label(materialized(journey_routes(i))))
    cells = medoid.visited_cells(i.journeys(), cell=CELL)
    return materialized(medoid.coded_sequences(materialized(cells), trips))


def medoids(i: Inputs) -> DataFrame:
    return medoid.route_medoid(coded(i))


@query(
    "place_filter",
    """SELECT 'a' AS rule, name FROM places
       WHERE kind NOT IN ('closed', 'heliport') AND continent = 'EU'
       UNION ALL
       SELECT 'b', name FROM places WHERE kind NOT IN ('closed', 'heliport')
          AND continent = 'EU' AND country NOT IN ('C2', 'C20')
       UNION ALL
       SELECT 'c', name FROM places WHERE kind NOT IN ('closed', 'heliport')""",
    "places",
)
def _place_filter(i: Inputs) -> DataFrame:
    rules = {
        "a": routes.place_filter(i.places()),
        "b": routes.place_filter(
            i.places(),
            without_kinds=("closed", "heliport", "seaplane_base", "small_airport", "balloonport"),
            without_countries=("C2", "C20"),
        ),
        "c": routes.place_filter(i.places(), continent=None),
    }
    first, *rest = [p.select(F.lit(k).alias("rule"), "name") for k, p in rules.items()]
    for part in rest:
        first = first.unionByName(part)
    return first


@query(
    "route_endpoints",
    f"""SELECT flight, s.place_name AS start_place_name, e.place_name AS end_place_name,
               round(s.place_km, 6) AS start_place_km, round(e.place_km, 6) AS end_place_km
        FROM ({sql_nearest("flights", "flight", "start_lat", "start_lon")}) s
        JOIN ({sql_nearest("flights", "flight", "end_lat", "end_lon")}) e USING (flight)""",
    "flights spots",
)
def _route_endpoints(i: Inputs) -> DataFrame:
    found = routes.route_endpoints(i.flights(), i.places())
    return rounded(
        found.select(
            "flight", "start_place_name", "end_place_name", "start_place_km", "end_place_km"
        ),
        "start_place_km",
        "end_place_km",
    )


@query(
    "attach_callsign",
    "SELECT flight, entity, airline FROM flights JOIN airlines USING (entity)",
    "flights airlines",
)
def _attach_callsign(i: Inputs) -> DataFrame:
    return labels.attach_airline(i.flights(), i.airlines()).select("flight", "entity", "airline")


@query(
    "attach_type",
    """SELECT flight, airline, airline_types.type AS airline_type
       FROM flights JOIN airlines USING (entity) LEFT JOIN airline_types USING (airline)""",
    "flights airlines airline_types",
)
def _attach_type(i: Inputs) -> DataFrame:
    flights = labels.attach_airline(i.flights().drop("type"), i.airlines())
    typed = labels.attach_type(flights, airline_types(i))
    return typed.select("flight", "airline", F.col("type").alias("airline_type"))


@query(
    "route_share",
    """SELECT start, "end", CAST(sum(type) AS BIGINT) AS labelled, count(type) AS trips,
              round(sum(type) / count(type), 9) AS share
       FROM routes GROUP BY start, "end" HAVING sum(type) <> 0""",
    "routes",
)
def _route_share(i: Inputs) -> DataFrame:
    return rounded(routes.route_share(i.routes()), "share", decimals=9)


@query(
    "routes_with_label",
    """SELECT entity, seg, start, "end", type FROM journey_routes
       QUALIFY sum(type) OVER (PARTITION BY start, "end") <> 0""",
    "journey_routes",
)
def _routes_with_label(i: Inputs) -> DataFrame:
    return routes.routes_with_label(journey_routes(i))


@query(
    "edit_distance",
    """SELECT entity, seg, CAST(levenshtein(code, first_value(code) OVER (
                 PARTITION BY start, "end" ORDER BY entity, seg)) AS INTEGER) AS distance
       FROM coded""",
    "coded",
)
def _edit_distance(i: Inputs) -> DataFrame:
    """Distance of each journey to the first one of its route, on arrays of cells."""
    trips = routes.routes_with_label(materialized(journey_routes(i)))
    cells = medoid.visited_cells(i.journeys(), cell=CELL)
    known = materialized(trips.join(medoid.token_sequences(cells), ["entity", "seg"]))
    first = known.groupBy("start", "end").agg(
        F.min_by("tokens", F.struct("entity", "seg")).alias("first")
    )
    distance = medoid.edit_distance(F.col("tokens"), F.col("first"))
    return known.join(first, ["start", "end"]).select(
        "entity", "seg", distance.alias("distance")
    )


@query("route_medoid", "SELECT * FROM medoids", "medoids")
def _route_medoid(i: Inputs) -> DataFrame:
    return medoids(i).drop("code")


@query(
    "medoid_label_mix",
    """SELECT start, "end", CAST(sum(type) AS BIGINT) AS labelled FROM medoids
       GROUP BY start, "end" """,
    "medoids",
)
def _medoid_label_mix(i: Inputs) -> DataFrame:
    return medoid.medoid_label_mix(medoids(i))


@query(
    "medoid_points",
    "SELECT id, entity, seg, lon, lat, alt FROM journeys JOIN medoids USING (entity, seg)",
    "journeys medoids",
)
def _medoid_points(i: Inputs) -> DataFrame:
    return medoid.medoid_points(i.journeys(), medoids(i)).drop("t")
