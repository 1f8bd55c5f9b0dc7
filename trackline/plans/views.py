"""Roles played by the given tables: points, places, flights, routes, journeys, messages.

Every view exists twice: as a DataFrame (``Inputs``) and as SQL text (``SQL``) that the
checks run in another engine. Columns and formulas are the same on both sides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def epoch_seconds(column: str) -> Column:
    """Seconds since 1970 of a timestamp without zone, with microseconds."""
    return F.expr(
        f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {column}) / 1e6"
    )


class Inputs:
    """The given tables of one folder, and the views over them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    def once(self, name: str, make) -> DataFrame:
        """What ``make`` returns, made at the first call."""
        if f"({name})" not in self._tables:
            self._tables[f"({name})"] = make()
        return self._tables[f"({name})"]

    def points(self) -> DataFrame:
        """One timestamped position per event; the user is the moving entity."""
        return self.table("events").select(
            F.col("event_id").alias("id"),
            F.col("user_id").alias("entity"),
            epoch_seconds("ts").alias("t"),
            (F.lit(-10.0) + (F.col("event_id") % 10000).cast("double") * 3 / 1000).alias("lon"),
            (F.lit(40.0) + (F.col("user_id") % 15) + F.col("value") / 1000).alias("lat"),
            (F.col("value") * 100).alias("alt"),
        )

    def places(self) -> DataFrame:
        key = F.col("s_suppkey")
        return self.table("supplier").select(
            F.col("s_name").alias("name"),
            (F.lit(35.0) + (key * 7 % 300).cast("double") / 10).alias("lat"),
            (F.lit(-10.0) + (key * 13 % 400).cast("double") / 10).alias("lon"),
            F.when(key % 5 == 0, "closed")
            .when(key % 5 == 1, "heliport")
            .otherwise("airport")
            .alias("kind"),
            F.when(F.col("s_nationkey") % 2 == 0, "EU").otherwise("NA").alias("continent"),
            F.concat(F.lit("C"), F.col("s_nationkey").cast("string")).alias("country"),
        )

    def flights(self) -> DataFrame:
        entity, order = F.col("o_custkey"), F.col("o_orderkey")
        t0 = epoch_seconds("o_orderdate")
        return self.table("orders").select(
            order.alias("flight"),
            entity.alias("entity"),
            (F.lit(35.0) + (entity * 7 % 300).cast("double") / 10).alias("start_lat"),
            (F.lit(-10.0) + (entity * 13 % 400).cast("double") / 10).alias("start_lon"),
            (F.lit(35.0) + (order * 11 % 300).cast("double") / 10).alias("end_lat"),
            (F.lit(-10.0) + (order * 17 % 400).cast("double") / 10).alias("end_lon"),
            t0.alias("t0"),
            (t0 + 1200 + (order % 24) * 3600).alias("t1"),
            (F.col("o_totalprice") / 5).alias("max_alt"),
            F.when(order % 7 == 0, F.lit(None))
            .when(F.col("o_orderstatus") == "F", 1)
            .otherwise(0)
            .cast("int")
            .alias("type"),
        )

    def airlines(self) -> DataFrame:
        """Airline code per entity."""
        return self.table("customer").select(
            F.col("c_custkey").alias("entity"),
            F.substring("c_mktsegment", 1, 3).alias("airline"),
        )

    def routes(self) -> DataFrame:
        """One labelled flight between two nations per line item."""
        nation = self.table("nation").select("n_nationkey", "n_name")
        origin = nation.select(
            F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("start")
        )
        target = nation.select(
            F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("end")
        )
        # the small tables meet first, so that the line items are dealt out for two joins only
        origins = (
            self.table("orders")
            .select("o_orderkey", "o_custkey")
            .join(
                self.table("customer").select("c_custkey", "c_nationkey").join(origin, "c_nationkey"),
                F.col("o_custkey") == F.col("c_custkey"),
            )
            .select("o_orderkey", "start")
        )
        targets = self.table("supplier").select("s_suppkey", "s_nationkey").join(target, "s_nationkey")
        return (
            self.table("lineitem")
            .select("l_orderkey", "l_suppkey", "l_returnflag", "l_shipdate")
            .join(origins, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(targets.select("s_suppkey", "end"), F.col("l_suppkey") == F.col("s_suppkey"))
            .select(
                "start",
                "end",
                (F.col("l_returnflag") == "R").cast("int").alias("type"),
                epoch_seconds("l_shipdate").alias("t"),
            )
        )

    def journeys(self) -> DataFrame:
        """The points, keyed by entity and week."""
        return self.points().withColumn("seg", F.floor(F.col("t") / 604800))

    def journey_types(self) -> DataFrame:
        """Label per journey."""
        return self.journeys().select(
            "entity", "seg", F.when(F.col("entity") % 3 == 0, 1).otherwise(0).alias("type")
        ).distinct()

    def models(self) -> DataFrame:
        """Misspelled model names, one per part."""
        return self.table("part").select(
            F.col("p_partkey").alias("part"),
            F.regexp_replace("p_name", "l", "").alias("model"),
            F.col("p_brand").alias("owner"),
            F.when(
                F.col("p_partkey") % 10 != 0,
                F.concat(F.col("p_size").cast("string"), F.lit(",000 kg")),
            ).alias("payload"),
            F.when(F.col("p_type") == "SMALL", 1).otherwise(0).alias("type"),
        )

    def model_names(self) -> DataFrame:
        """The dictionary of right model names."""
        return self.table("part").select(F.col("p_name").alias("name")).distinct()

    def model_dictionary(self) -> DataFrame:
        """The dictionary with what a model carries and how far it goes, as texts; some lack one."""
        size, price = F.min("p_size"), F.floor(F.min("p_retailprice")).cast("bigint")
        known = self.table("part").groupBy(F.col("p_name").alias("name"))
        return known.agg(size.alias("_size"), price.alias("_price")).select(
            "name",
            F.when(
                F.col("_size") % 10 != 0, F.concat(F.col("_size").cast("string"), F.lit(",000 kg"))
            ).alias("payload"),
            F.when(
                F.col("_price") % 7 != 0, F.concat(F.col("_price").cast("string"), F.lit(" km"))
            ).alias("range"),
        )

    def scores(self) -> DataFrame:
        """A fixed score per labelled document, and its true label."""
        return self.table("documents").join(self.table("labels"), "doc_id").select(
            "doc_id",
            ((F.col("n_chars") % 97).cast("double") / 97).alias("score"),
            F.col("quality").alias("truth"),
        )


# name -> (views it reads, SQL)
SQL: dict[str, tuple[str, str]] = {
    "points": (
        "",
        """SELECT event_id AS id, user_id AS entity, epoch_us(ts) / 1e6 AS t,
                  -10.0::DOUBLE + CAST(event_id % 10000 AS DOUBLE) * 3 / 1000 AS lon,
                  40.0::DOUBLE + user_id % 15 + value / 1000 AS lat, value * 100 AS alt
           FROM events""",
    ),
    "places": (
        "",
        """SELECT s_name AS name,
                  35.0::DOUBLE + CAST((s_suppkey * 7) % 300 AS DOUBLE) / 10 AS lat,
                  -10.0::DOUBLE + CAST((s_suppkey * 13) % 400 AS DOUBLE) / 10 AS lon,
                  CASE s_suppkey % 5 WHEN 0 THEN 'closed' WHEN 1 THEN 'heliport'
                       ELSE 'airport' END AS kind,
                  CASE WHEN s_nationkey % 2 = 0 THEN 'EU' ELSE 'NA' END AS continent,
                  concat('C', CAST(s_nationkey AS VARCHAR)) AS country
           FROM supplier""",
    ),
    "flights": (
        "",
        """SELECT flight, entity, start_lat, start_lon, end_lat, end_lon, t0,
                  t0 + 1200 + (flight % 24) * 3600 AS t1, max_alt, type
           FROM (SELECT o_orderkey AS flight, o_custkey AS entity,
                  35.0::DOUBLE + CAST((o_custkey * 7) % 300 AS DOUBLE) / 10 AS start_lat,
                  -10.0::DOUBLE + CAST((o_custkey * 13) % 400 AS DOUBLE) / 10 AS start_lon,
                  35.0::DOUBLE + CAST((o_orderkey * 11) % 300 AS DOUBLE) / 10 AS end_lat,
                  -10.0::DOUBLE + CAST((o_orderkey * 17) % 400 AS DOUBLE) / 10 AS end_lon,
                  epoch_us(o_orderdate) / 1e6 AS t0, o_totalprice / 5 AS max_alt,
                  CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 1
                       ELSE 0 END AS type
           FROM orders)""",
    ),
    "airlines": (
        "",
        "SELECT c_custkey AS entity, substr(c_mktsegment, 1, 3) AS airline FROM customer",
    ),
    "routes": (
        "",
        """SELECT o.n_name AS "start", d.n_name AS "end",
                  CAST(l_returnflag = 'R' AS INTEGER) AS type, epoch_us(l_shipdate) / 1e6 AS t
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey
           JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
           JOIN nation o ON o.n_nationkey = c_nationkey
           JOIN nation d ON d.n_nationkey = s_nationkey""",
    ),
    "journeys": (
        "points",
        "SELECT *, CAST(floor(t / 604800) AS BIGINT) AS seg FROM points",
    ),
    "models": (
        "",
        """SELECT p_partkey AS part, replace(p_name, 'l', '') AS model, p_brand AS owner,
                  CASE WHEN p_partkey % 10 <> 0
                       THEN concat(CAST(p_size AS VARCHAR), ',000 kg') END AS payload,
                  CASE WHEN p_type = 'SMALL' THEN 1 ELSE 0 END AS type
           FROM part""",
    ),
    "model_names": ("", "SELECT DISTINCT p_name AS name FROM part"),
    "model_dictionary": (
        "",
        """SELECT name, CASE WHEN size % 10 <> 0 THEN size || ',000 kg' END AS payload,
                  CASE WHEN price % 7 <> 0 THEN price || ' km' END AS range
           FROM (SELECT p_name AS name, min(p_size) AS size,
                        CAST(floor(min(p_retailprice)) AS BIGINT) AS price
                 FROM part GROUP BY p_name)""",
    ),
    "scores": (
        "",
        """SELECT doc_id, CAST(n_chars % 97 AS DOUBLE) / 97 AS score, quality AS truth
           FROM documents JOIN labels USING (doc_id)""",
    ),
}
