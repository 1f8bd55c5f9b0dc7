"""Queries that go through files and JSON text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackline.operators import report, routes
from trackline.plans.registry import query
from trackline.plans.views import Inputs
from trackline.session import scratch_dir
from trackline.sources import readers, writers


@query(
    "csv_roundtrip",
    "SELECT event_id, user_id, event_type, value FROM events WHERE event_type <> 'error'",
)
def _csv_roundtrip(i: Inputs) -> DataFrame:
    """Errors are written without a number, so their lines do not fit the schema."""
    value = F.when(F.col("event_type") == "error", "none").otherwise(F.col("value").cast("string"))
    events = i.table("events").select("event_id", "user_id", "event_type", value.alias("value"))
    path = f"{scratch_dir(i.spark)}/events"
    writers.write_csv(events, path)
    schema = "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE"
    return readers.good_lines(readers.read_dirty_csv(i.spark, path, schema))


@query(
    "gzip_csv",
    """SELECT event_type, count(*) AS n, CAST(sum(user_id) AS BIGINT) AS users FROM events
       GROUP BY event_type""",
)
def _gzip_csv(i: Inputs) -> DataFrame:
    """Counts over compressed files, whose rows are dealt out before the work."""
    path = f"{scratch_dir(i.spark)}/events"
    events = i.table("events").select("event_id", "user_id", "event_type")
    writers.write_csv(events, path, compression="gzip")
    schema = "event_id BIGINT, user_id BIGINT, event_type STRING"
    read = readers.read_csv(i.spark, f"{path}/*.csv.gz", schema, spread=8)
    return read.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("user_id").alias("users"))


@query(
    "csv_append",
    """SELECT event_id, '类型 ' || event_type AS kind FROM events""",
)
def _csv_append(i: Inputs) -> DataFrame:
    """Two runs that add to one folder, in an encoding other than Unicode."""
    path = f"{scratch_dir(i.spark)}/kinds"
    kinds = i.table("events").select("event_id", F.concat(F.lit("类型 "), "event_type").alias("kind"))
    even = F.coalesce(F.col("event_id") % 2 == 0, F.lit(False))
    for half in (even, ~even):
        writers.write_csv(kinds.filter(half), path, mode="append", encoding="GBK")
    schema = "event_id BIGINT, kind STRING"
    return readers.read_csv(i.spark, path, schema, encoding="GBK", multi_line=True)


@query("json_props", "SELECT event_id, CAST(props ->> '$.k' AS INTEGER) AS k FROM events")
def _json_props(i: Inputs) -> DataFrame:
    return readers.parse_json(i.table("events").select("event_id", "props"), "props", "k INT")


@query(
    "json_export",
    """SELECT flight, type, 'start' AS event, CAST(floor(t0) AS BIGINT) AS time,
              printf('%.3f', start_lon) AS lon, printf('%.3f', start_lat) AS lat FROM flights
       UNION ALL
       SELECT flight, type, 'end', CAST(floor(t1) AS BIGINT), printf('%.3f', end_lon),
              printf('%.3f', end_lat) FROM flights""",
    "flights",
)
def _json_export(i: Inputs) -> DataFrame:
    """Trip ends written as JSON records and read back."""
    path = f"{scratch_dir(i.spark)}/events"
    writers.write_json(report.endpoint_events(i.flights()), path)
    schema = "flight BIGINT, type INT, event STRING, time BIGINT, lon STRING, lat STRING"
    return readers.read_json_records(i.spark, path, schema)


@query(
    "place_export",
    """SELECT to_json({'name': name, 'lon': printf('%.3f', lon), 'lat': printf('%.3f', lat)})::VARCHAR
              AS json
       FROM places WHERE kind NOT IN ('closed', 'heliport') AND continent = 'EU'""",
    "places",
)
def _place_export(i: Inputs) -> DataFrame:
    places = routes.place_filter(i.places()).select("name", "lon", "lat")
    return writers.json_text(report.fixed_decimals(places, ["lon", "lat"]))


@query(
    "positional_states",
    """SELECT id AS event, CAST(entity AS VARCHAR) AS id, event_type AS callsign, lon, lat,
              alt, entity % 2 = 0 AS on_ground
       FROM points JOIN events ON id = event_id WHERE event_type NOT IN ('error', 'signup')""",
    "points",
)
def _positional_states(i: Inputs) -> DataFrame:
    """Each event as a response with one aircraft; errors have no name, sign-ups no position."""
    points = i.points().join(
        i.table("events").select(F.col("event_id").alias("id"), "event_type"), "id"
    )
    kind = F.col("event_type")
    name = F.when(kind == "error", "").otherwise(kind)
    lon = F.when(kind == "signup", "null").otherwise(F.col("lon").cast("string"))
    text = F.format_string(
        '{"states": [["%s", "%s", null, 0, 0, %s, %s, null, %s, 1.5, 90, 0, null, %s]]}',
        F.col("entity").cast("string"),
        name,
        lon,
        F.col("lat").cast("string"),
        (F.col("entity") % 2 == 0).cast("string"),
        F.col("alt").cast("string"),
    )
    responses = points.select(F.col("id").alias("event"), text.alias("response"))
    states = readers.parse_states(responses, "response")
    return states.select("event", "id", "callsign", "lon", "lat", "alt", "on_ground")


@query("file_census")
def _file_census(i: Inputs) -> DataFrame:
    return readers.file_census(i.spark, i.sf_dir)
