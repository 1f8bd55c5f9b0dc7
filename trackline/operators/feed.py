"""From raw transponder messages to counts, airlines and positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackline.functions import cpr
from trackline.functions import messages as msg
from trackline.operators import slices
from trackline.operators.labels import most_frequent

MAX_PAIR_SECONDS = 10


def checked(messages: DataFrame, raw: str = "raw") -> DataFrame:
    """Add ``reject``: why a message cannot be used, null for a good one.

    Good is hex text of one of the two lengths whose parity field is zero or right.
    """
    text = F.col(raw)
    field = msg.parity(text)
    reason = (
        F.when(text.isNull() | ~F.length(text).isin(msg.SHORT, msg.LONG), "length")
        .when(~text.rlike("^[0-9a-fA-F]+$"), "hex")
        .when((field != 0) & (field != msg.checksum(text)), "parity")
    )
    return messages.withColumn("reject", reason)


def feed_gate(messages: DataFrame, raw: str = "raw") -> DataFrame:
    """The good messages."""
    return checked(messages, raw).filter("reject IS NULL").drop("reject")


def reject_report(messages: DataFrame, raw: str = "raw") -> DataFrame:
    """Number of messages per reason, null for the good ones."""
    return checked(messages, raw).groupBy("reject").agg(F.count(F.lit(1)).alias("n"))


def with_kind(messages: DataFrame, raw: str = "raw") -> DataFrame:
    """Well-formed messages with protocol and, for extended squitters, type as text."""
    text = F.col(raw)
    well_formed = text.rlike(f"^([0-9a-fA-F]{{{msg.SHORT}}}|[0-9a-fA-F]{{{msg.LONG}}})$")
    return messages.filter(well_formed).withColumns(
        {
            "protocol": msg.protocol_name(msg.downlink_format(text)),
            "msg_type": msg.type_name(msg.type_code(text)),
        }
    )


def census(messages: DataFrame, column: str) -> DataFrame:
    """Messages per value of a column."""
    return messages.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def null_census(messages: DataFrame, column: str) -> DataFrame:
    """Messages with and without a value."""
    return messages.groupBy(F.col(column).isNotNull().alias("known")).agg(
        F.count(F.lit(1)).alias("n")
    )


def identifications(messages: DataFrame, raw: str = "raw") -> DataFrame:
    """Entity and airline code of every good identification message."""
    text = F.col(raw)
    return (
        feed_gate(messages, raw)
        .filter(msg.type_code(text).between(1, 4))
        .select(
            msg.entity_id(text).alias("entity"), msg.identity(text, 3).alias("airline")
        )
        .na.drop()
    )


def entity_airline(messages: DataFrame, raw: str = "raw") -> DataFrame:
    """The airline code each entity gives most often."""
    return most_frequent(identifications(messages, raw), ["entity"], "airline")


def message_multiplicity(messages: DataFrame, raw: str = "raw") -> DataFrame:
    """How many entities sent how many identifications."""
    per_entity = identifications(messages, raw).groupBy("entity").agg(
        F.count(F.lit(1)).alias("messages")
    )
    return per_entity.groupBy("messages").agg(F.count(F.lit(1)).alias("entities"))


def positions(messages: DataFrame, raw: str = "raw", t: str = "t") -> DataFrame:
    """Coded airborne positions of the good extended squitters."""
    text = F.col(raw)
    altitude = msg.bits(text, 40, 12)
    step = F.shiftleft(F.shiftright(altitude, 5), 4).bitwiseOR(altitude.bitwiseAND(F.lit(15)))
    return (
        feed_gate(messages, raw)
        .filter(msg.type_code(text).between(9, 18))
        .select(
            msg.entity_id(text).alias("entity"),
            F.col(t).alias("t"),
            F.col(raw).alias("raw"),
            msg.bits(text, 53, 1).alias("odd"),
            (msg.bits(text, 54, 17) / cpr.SCALE).alias("y"),
            (msg.bits(text, 71, 17) / cpr.SCALE).alias("x"),
            F.when(altitude.bitwiseAND(F.lit(16)) != 0, step * 25.0 - 1000)
            .otherwise(msg.coded_altitude(altitude))
            .alias("alt"),
        )
    )


def _text_number(raw: str) -> Column:
    """A number that grows with the text of an entity's messages: all but the entity, 60 bits."""
    text = F.lower(raw)
    digits = F.concat(F.substring(text, 1, 2), F.rpad(F.substring(text, 9, 13), 13, "0"))
    return F.coalesce(F.conv(digits, 16, 10).try_cast("double"), F.lit(0.0))


def pair_latest(
    coded: DataFrame,
    *,
    max_seconds: float = MAX_PAIR_SECONDS,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Each position with the newest even and odd one of its entity up to it, if close in time.

    Positions of one time are in the order of their text. A burst of very many is cut by it.
    """

    def of(parity: int) -> Column:
        return F.when(F.col("odd") == parity, F.struct("t", "y", "x"))

    parts = coded.withColumns({"_even": of(0), "_odd": of(1), "_number": _text_number("raw")})
    wanted = {"even": "_even", "odd_one": "_odd"}

    def compute(rows: DataFrame, slice_col: str | None) -> DataFrame:
        return slices.nearest_known(
            rows, ["entity"], ["t", "_number", "raw"], wanted, forward=True, slice_col=slice_col
        )

    hot = slices.hot_keys(parts, ["entity"], "t", tie="_number") if hot is None else hot
    paired = slices.per_key(parts, "t", hot, compute, tie="_number").drop("_even", "_odd", "_number")
    gap = F.abs(F.col("even.t") - F.col("odd_one.t"))
    return paired.filter(gap <= max_seconds)


def position_fix(pairs: DataFrame) -> DataFrame:
    """Longitude, latitude and altitude at the newer message of each pair.

    Pairs whose messages lie in different latitude zones give no position.
    """
    is_odd = F.col("odd") == 1
    even_lat, odd_lat = cpr.latitudes(F.col("even.y"), F.col("odd_one.y"))
    zones = cpr.longitude_zones(F.col("_even_lat"))
    lon = cpr.longitude(F.col("even.x"), F.col("odd_one.x"), F.col("_zones"), is_odd)
    return (
        pairs.withColumns({"_even_lat": even_lat, "_odd_lat": odd_lat})
        .withColumn("_zones", zones)
        .filter(F.col("_zones") == cpr.longitude_zones(F.col("_odd_lat")))
        .withColumns({"lat": F.when(is_odd, F.col("_odd_lat")).otherwise(F.col("_even_lat")),
                      "lon": lon})
        .filter(F.col("lat").between(-90, 90))
        .select("entity", "t", "lon", "lat", "alt")
    )
