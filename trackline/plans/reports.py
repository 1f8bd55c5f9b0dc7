"""Queries that count, rank and describe."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackline.functions.geo import haversine_km
from trackline.operators import labels, ranking, report, routes
from trackline.plans.places import rounded
from trackline.plans.registry import query
from trackline.plans.resample import STEP, airline_types, ticks
from trackline.plans.tracks import sql_haversine, sql_round
from trackline.plans.views import SQL, Inputs
from trackline.operators import resample
from trackline.session import materialized

MIDDLE = 1705276800  # 15 January 2024, in the middle of the events
SHIPPED = 883612800  # 1 January 1998, in the middle of the orders

SQL["trips"] = (
    "flights airlines",
    f"""SELECT f.*, airline, t1 - t0 AS time,
               {sql_haversine("start_lat", "start_lon", "end_lat", "end_lon")} AS distance
        FROM flights f JOIN airlines USING (entity)""",
)
SQL["clean"] = (
    "trips",
    """SELECT flight, type, least(max_alt, 60000) AS max_alt, time, distance FROM trips
       WHERE time > 1800 AND time < 80000 AND distance >= 100 AND type IS NOT NULL
         AND max_alt IS NOT NULL""",
)
SQL["payloads"] = (
    "models",
    """SELECT *, coalesce(TRY_CAST(replace(split_part(payload, ' ', 1), ',', '') AS INTEGER),
                          103000) AS kg FROM models""",
)
SQL["resampled"] = (
    "interpolated airlines airline_types",
    f"""SELECT entity, seg, tick * {STEP} AS t, airline, type, {sql_round("lon", 4)} AS lon,
               {sql_round("lat", 4)} AS lat, {sql_round("alt", 4)} AS alt
        FROM interpolated JOIN airlines USING (entity) JOIN airline_types USING (airline)""",
)


SQL["yearly"] = (
    "trips",
    """SELECT *, year(make_timestamp(CAST(t0 * 1000000 AS BIGINT))) AS year,
              strftime(make_timestamp(CAST(t0 * 1000000 AS BIGINT)), '%Y-%m-%d') AS day
       FROM trips WHERE type IS NOT NULL""",
)
SQL["top_yearly"] = (
    "yearly",
    """SELECT year, type, airline, count(*) AS n FROM yearly GROUP BY year, type, airline
       QUALIFY row_number() OVER (PARTITION BY year, type ORDER BY count(*) DESC, airline) <= 5""",
)
SQL["clean_yearly"] = (
    "yearly",
    """SELECT year, flight, type, least(max_alt, 60000) AS max_alt, time, distance FROM yearly
       WHERE time > 1800 AND time < 80000 AND distance >= 100 AND max_alt IS NOT NULL""",
)


def trips(i: Inputs) -> DataFrame:
    """Flights with airline, duration and distance."""
    ends = haversine_km(
        F.col("start_lat"), F.col("start_lon"), F.col("end_lat"), F.col("end_lon")
    )
    return labels.attach_airline(i.flights(), i.airlines()).withColumns(
        {"time": F.col("t1") - F.col("t0"), "distance": ends}
    )


def yearly(i: Inputs) -> DataFrame:
    """Trips with a label, and their year."""
    return trips(i).filter("type IS NOT NULL").withColumn("year", report.year("t0"))


def clean_yearly(i: Inputs) -> DataFrame:
    columns = ("year", "flight", "type", "max_alt", "time", "distance")
    return report.clean_features(yearly(i).select(*columns))


def clean(i: Inputs) -> DataFrame:
    return report.clean_features(trips(i).select("flight", "type", "max_alt", "time", "distance"))


def payloads(i: Inputs) -> DataFrame:
    return i.models().withColumn("kg", report.parse_quantity("payload", 103000))


def resampled(i: Inputs, at: int) -> DataFrame:
    return resample.resampled_labelled(
        materialized(ticks(i)), i.airlines(), airline_types(i), step=STEP, at=at
    )


@query(
    "top_airlines",
    """SELECT airline, count(*) AS n FROM trips WHERE type = 1 GROUP BY airline
       ORDER BY n DESC, airline LIMIT 5""",
    "trips",
)
def _top_airlines(i: Inputs) -> DataFrame:
    return ranking.top_by_count(trips(i).filter("type = 1"), "airline", 5)


@query(
    "airline_by_day",
    """SELECT airline, strftime(make_timestamp(CAST(t0 * 1000000 AS BIGINT)), '%Y-%m-%d') AS day,
              count(*) AS trips
       FROM trips WHERE type = 1 AND airline IN (
            SELECT airline FROM trips WHERE type = 1 GROUP BY airline
            ORDER BY count(*) DESC, airline LIMIT 5)
       GROUP BY ALL""",
    "trips",
)
def _airline_by_day(i: Inputs) -> DataFrame:
    cargo = trips(i).filter("type = 1")
    return report.airline_by_day(cargo, ranking.top_by_count(cargo, "airline", 5))


@query(
    "hourly_counts",
    """SELECT CAST(floor(t1 / 3600) AS BIGINT) * 3600 AS hour, airline, type, count(*) AS trips
       FROM trips GROUP BY ALL""",
    "trips",
)
def _hourly_counts(i: Inputs) -> DataFrame:
    return report.hourly_counts(trips(i), keys=["airline", "type"])


@query(
    "place_volume",
    """SELECT name, count(*) AS volume FROM (
         SELECT unnest([start, "end"]) AS name FROM routes WHERE type = 1 AND start <> "end")
       GROUP BY name ORDER BY volume DESC, name LIMIT 10""",
    "routes",
)
def _place_volume(i: Inputs) -> DataFrame:
    return report.place_volume(i.routes())


@query(
    "adjacency",
    """SELECT name, size, imports FROM (
         SELECT name, count(*) AS size FROM (
           SELECT unnest([start, "end"]) AS name FROM routes) GROUP BY name)
       LEFT JOIN (SELECT name, string_agg("end" || ':' || n, ';' ORDER BY "end") AS imports
                  FROM (SELECT start AS name, "end", count(*) AS n FROM routes GROUP BY ALL)
                  GROUP BY name) USING (name)""",
    "routes",
)
def _adjacency(i: Inputs) -> DataFrame:
    text = F.transform(
        "imports", lambda p: F.concat_ws(":", p["name"], p["trips"].cast("string"))
    )
    return routes.adjacency(i.routes()).withColumn("imports", F.array_join(text, ";"))


@query(
    "place_sets",
    """SELECT name, max(type) = 1 AS labelled FROM (
         SELECT unnest([start, "end"]) AS name, type FROM routes) GROUP BY name""",
    "routes",
)
def _place_sets(i: Inputs) -> DataFrame:
    return routes.place_sets(i.routes())


@query(
    "volume_asof",
    f"""SELECT name, type, count(*) AS n,
               CASE WHEN type = 1 THEN 'Cargo' ELSE 'Passenger' END AS type_name
        FROM (SELECT unnest([start, "end"]) AS name, type FROM routes WHERE t < {SHIPPED})
        GROUP BY name, type""",
    "routes",
)
def _volume_asof(i: Inputs) -> DataFrame:
    ends = i.routes().select(F.explode(F.array("start", "end")).alias("name"), "type", "t")
    return report.volume_asof(ends, SHIPPED)


SQL["sliders"] = ("routes", "SELECT DISTINCT t AS moment FROM routes WHERE CAST(t / 86400 AS BIGINT) % 5 = 0")


@query(
    "volume_series",
    """SELECT moment, name, type, count(*) AS n,
              CASE WHEN type = 1 THEN 'Cargo' ELSE 'Passenger' END AS type_name
       FROM sliders JOIN (SELECT unnest([start, "end"]) AS name, type, t FROM routes) ON t < moment
       GROUP BY moment, name, type""",
    "routes sliders",
)
def _volume_series(i: Inputs) -> DataFrame:
    """Volumes of all places at several hundred positions of the slider."""
    counted = materialized(i.routes().groupBy("start", "end", "type", "t").agg(F.count(F.lit(1)).alias("trips")))
    ends = counted.select(F.explode(F.array("start", "end")).alias("name"), "type", "t", "trips")
    sliders = counted.filter((F.col("t") / 86400).cast("bigint") % 5 == 0)
    return report.volume_series(ends, sliders.select(F.col("t").alias("moment")), at="moment", n="trips")


@query(
    "quantile_sketch",
    " UNION ALL ".join(
        f"""SELECT type, {q}::DOUBLE AS level, count(max_alt) AS n, TRUE AS near FROM flights
            GROUP BY type"""
        for q in (0.05, 0.25, 0.5, 0.75, 0.95)
    ),
    "flights",
)
def _quantile_sketch(i: Inputs) -> DataFrame:
    """Quantiles per label from the sketches of days, and whether their ranks are as near as stated."""
    days = i.flights().withColumn("day", report.day("t0"))
    kept = materialized(ranking.quantile_sketches(days, "max_alt", ["type", "day"]))
    found = ranking.sketch_quantiles(kept, (0.05, 0.25, 0.5, 0.75, 0.95), ["type"])
    ranks = i.flights().select(F.col("type").alias("_type"), "max_alt").join(
        found, F.col("_type").eqNullSafe(F.col("type"))
    )
    below, upto = (F.count_if(c) / F.count("max_alt") for c in (F.col("max_alt") < F.col("value"), F.col("max_alt") <= F.col("value")))
    error = ranking.SKETCH_ERROR
    near = (below <= F.col("level") + error) & (upto >= F.col("level") - error)
    return ranks.groupBy("type", "level", "n").agg(near.alias("near"))


@query("snapshot", f"SELECT * FROM resampled WHERE floor(t) = {MIDDLE}", "resampled")
def _snapshot(i: Inputs) -> DataFrame:
    return report.snapshot(resampled(i, MIDDLE), MIDDLE)


@query(
    "snapshot_airlines",
    f"""SELECT airline, count(*) AS n FROM resampled WHERE floor(t) = {MIDDLE} AND type = 0
        GROUP BY airline""",
    "resampled",
)
def _snapshot_airlines(i: Inputs) -> DataFrame:
    return report.airline_bars(report.snapshot(resampled(i, MIDDLE), MIDDLE), 0)


@query(
    "cargo_by_time",
    "SELECT t, CAST(sum(type) AS BIGINT) AS labelled FROM routes GROUP BY t",
    "routes",
)
def _cargo_by_time(i: Inputs) -> DataFrame:
    return report.label_by_time(i.routes())


@query(
    "altitude_bands",
    """SELECT CAST(floor(max_alt / 5000) AS BIGINT) * 5000 AS band,
              CASE WHEN type = 1 THEN 'Cargo' ELSE 'Passenger' END AS type_name, count(*) AS n
       FROM flights GROUP BY ALL""",
    "flights",
)
def _altitude_bands(i: Inputs) -> DataFrame:
    return report.altitude_bands(i.flights(), alt="max_alt")


@query(
    "time_extent",
    """SELECT min(t) AS "first", max(t) AS "last", count(DISTINCT t) AS times
       FROM (SELECT CAST(floor(unnest([t0, t1])) AS BIGINT) AS t FROM flights)""",
    "flights",
)
def _time_extent(i: Inputs) -> DataFrame:
    return report.time_extent(i.flights())


@query(
    "endpoint_events",
    """SELECT flight, type, 'start' AS event, CAST(floor(t0) AS BIGINT) AS time,
              printf('%.3f', start_lon) AS lon, printf('%.3f', start_lat) AS lat FROM flights
       UNION ALL
       SELECT flight, type, 'end', CAST(floor(t1) AS BIGINT), printf('%.3f', end_lon),
              printf('%.3f', end_lat) FROM flights""",
    "flights",
)
def _endpoint_events(i: Inputs) -> DataFrame:
    return report.endpoint_events(i.flights())


@query(
    "histogram",
    """SELECT type, bin, round(lo + bin * width, 6) AS lo, n,
              round(n / (sum(n) OVER (PARTITION BY type) * width), 12) AS density
       FROM (SELECT type, least(CAST(floor((max_alt - lo) / width) AS BIGINT), 9) AS bin,
                    count(*) AS n, any_value(lo) AS lo, any_value(width) AS width
             FROM clean, (SELECT min(max_alt) AS lo, (max(max_alt) - min(max_alt)) / 10 AS width
                          FROM clean)
             GROUP BY ALL)""",
    "clean",
)
def _histogram(i: Inputs) -> DataFrame:
    found = report.histogram(clean(i), "max_alt", 10, by=["type"])
    return rounded(rounded(found, "lo"), "density", decimals=12)


@query(
    "kde",
    f"""SELECT point, round(lo + step * point, 6) AS x,
               round(sum(exp(((kg - (lo + step * point)) / h) ** 2 / -2))
                     / (any_value(n) * h * sqrt(2 * pi())), 9) AS density
        FROM payloads, (SELECT min(kg) - (max(kg) - min(kg)) / 2.0::DOUBLE AS lo, count(*) AS n,
                               (max(kg) - min(kg)) * 2.0::DOUBLE / {report.KDE_POINTS - 1} AS step,
                               stddev_samp(kg) * count(*) ** -0.2 AS h FROM payloads),
             (SELECT CAST(unnest(range({report.KDE_POINTS})) AS INTEGER) AS point)
        GROUP BY point, lo, step, h""",
    "payloads",
)
def _kde(i: Inputs) -> DataFrame:
    found = report.kernel_density(payloads(i), "kg")
    return rounded(rounded(found, "x"), "density", decimals=9)


LEVELS = (0.05, 0.25, 0.5, 0.75, 0.95)


@query(
    "quantiles",
    " UNION ALL ".join(
        f"""SELECT 'kg' AS feature, {q}::DOUBLE AS level,
                   round(quantile_cont(CAST(kg AS DOUBLE), {q}), 6) AS value FROM payloads
            UNION ALL SELECT 'max_alt', {q}::DOUBLE,
                   round(quantile_cont(max_alt, {q}), 6) FROM flights"""
        for q in LEVELS
    ),
    "payloads flights",
)
def _quantiles(i: Inputs) -> DataFrame:
    kg = ranking.quantiles(payloads(i), "kg", LEVELS).withColumn("feature", F.lit("kg"))
    alt = ranking.quantiles(i.flights(), "max_alt", LEVELS).withColumn(
        "feature", F.lit("max_alt")
    )
    return rounded(kg.unionByName(alt), "value")


@query(
    "describe_text",
    """SELECT model, sum(n) AS count, count(*) AS "unique",
              arg_min(owner, rank) AS top, max(n) AS freq
       FROM (SELECT model, owner, count(*) AS n, row_number() OVER (
                    PARTITION BY model ORDER BY count(*) DESC, owner) AS rank
             FROM models GROUP BY model, owner)
       GROUP BY model""".replace("sum(n)", "CAST(sum(n) AS BIGINT)"),
    "models",
)
def _describe_text(i: Inputs) -> DataFrame:
    return report.describe_text(i.models(), "model", "owner")


@query(
    "clean_features",
    """SELECT flight, type, max_alt, time, round(distance, 6) AS distance FROM clean""",
    "clean",
)
def _clean_features(i: Inputs) -> DataFrame:
    return rounded(clean(i), "distance")


@query(
    "feature_means",
    """SELECT type, round(avg(max_alt), 6) AS max_alt, round(avg(time), 6) AS time,
              round(avg(distance), 6) AS distance FROM clean GROUP BY type""",
    "clean",
)
def _feature_means(i: Inputs) -> DataFrame:
    features = ("max_alt", "time", "distance")
    return rounded(report.feature_means(clean(i), features), *features)


@query("parse_quantity", "SELECT part, kg FROM payloads", "payloads")
def _parse_quantity(i: Inputs) -> DataFrame:
    return payloads(i).select("part", "kg")


@query(
    "recode_label",
    "SELECT flight, CASE WHEN type = 1 THEN 1 ELSE 0 END AS type FROM flights",
    "flights",
)
def _recode_label(i: Inputs) -> DataFrame:
    return i.flights().select("flight", report.recode("type").alias("type"))


@query(
    "top_owners",
    """SELECT 'cargo' AS whose, * FROM (SELECT owner, count(*) AS n FROM models WHERE type = 1
              GROUP BY owner ORDER BY n DESC, owner LIMIT 10)
       UNION ALL
       SELECT 'all', * FROM (SELECT owner, count(*) AS n FROM models
              GROUP BY owner ORDER BY n DESC, owner LIMIT 10)""",
    "models",
)
def _top_owners(i: Inputs) -> DataFrame:
    cargo = ranking.top_by_count(i.models().filter("type = 1"), "owner", 10)
    every = ranking.top_by_count(i.models(), "owner", 10)
    return cargo.withColumn("whose", F.lit("cargo")).unionByName(
        every.withColumn("whose", F.lit("all"))
    )


@query("top_airlines_by_year", "SELECT * FROM top_yearly", "top_yearly")
def _top_airlines_by_year(i: Inputs) -> DataFrame:
    """Five airlines of each label and year."""
    return ranking.top_by_group(yearly(i), ["year", "type"], "airline", 5)


@query(
    "airline_by_day_by_year",
    """SELECT year, type, airline, day, count(*) AS trips
       FROM yearly SEMI JOIN top_yearly USING (year, type, airline) GROUP BY ALL""",
    "yearly top_yearly",
)
def _airline_by_day_by_year(i: Inputs) -> DataFrame:
    """Trips per day of the five airlines of each label and year."""
    found = yearly(i)
    top = ranking.top_by_group(found, ["year", "type"], "airline", 5)
    return (
        found.join(top.drop("n"), ["year", "type", "airline"], "left_semi")
        .groupBy("year", "type", "airline", report.day("t0").alias("day"))
        .agg(F.count(F.lit(1)).alias("trips"))
    )


@query(
    "feature_means_by_year",
    """SELECT year, type, round(avg(max_alt), 6) AS max_alt, round(avg(time), 6) AS time,
              round(avg(distance), 6) AS distance FROM clean_yearly GROUP BY year, type""",
    "clean_yearly",
)
def _feature_means_by_year(i: Inputs) -> DataFrame:
    features = ("max_alt", "time", "distance")
    return rounded(report.feature_means(clean_yearly(i), features, by=["year"]), *features)


@query(
    "histogram_by_year",
    """SELECT year, type, bin, round(lo + bin * width, 6) AS lo, n,
              round(n / (sum(n) OVER (PARTITION BY year, type) * width), 12) AS density
       FROM (SELECT year, type, least(CAST(floor((distance - lo) / width) AS BIGINT), 9) AS bin,
                    count(*) AS n, any_value(lo) AS lo, any_value(width) AS width
             FROM clean_yearly, (SELECT min(distance) AS lo,
                                        (max(distance) - min(distance)) / 10 AS width
                                 FROM clean_yearly)
             GROUP BY ALL)""",
    "clean_yearly",
)
def _histogram_by_year(i: Inputs) -> DataFrame:
    found = report.histogram(clean_yearly(i), "distance", 10, by=["year", "type"])
    return rounded(rounded(found, "lo"), "density", decimals=12)
