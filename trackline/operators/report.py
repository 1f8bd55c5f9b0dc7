"""Counts, volumes, snapshots and distributions over trips and points."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackline.operators import slices
from trackline.operators.routes import ROUTE
from trackline.session import materialized

KDE_POINTS = 100


def day(t: str) -> Column:
    """UTC date of an epoch second, as text; no session time zone is involved."""
    days = F.floor(F.col(t) / 86400).cast("int")
    return F.date_add(F.lit("1970-01-01").cast("date"), days).cast("string")


def year(t: str) -> Column:
    """UTC year of an epoch second."""
    return F.substring(day(t), 1, 4).cast("int")


def floor_time(t: str, step: int) -> Column:
    """The last multiple of ``step`` seconds, such as the full hour, up to a time."""
    return F.floor(F.col(t) / step) * step


def type_name(label: str) -> Column:
    return F.when(F.col(label) == 1, "Cargo").otherwise("Passenger")


def recode(label: str) -> Column:
    """1 stays, everything else including null becomes 0."""
    return F.when(F.col(label) == 1, 1).otherwise(0)


def airline_by_day(
    trips: DataFrame, airlines: DataFrame, *, airline: str = "airline", t: str = "t0"
) -> DataFrame:
    """Trips per day of the given airlines."""
    return (
        trips.join(airlines.select(airline), airline, "left_semi")
        .groupBy(airline, day(t).alias("day"))
        .agg(F.count(F.lit(1)).alias("trips"))
    )


def hourly_counts(trips: DataFrame, *, keys: Sequence[str], t: str = "t1") -> DataFrame:
    """Trips per full hour and ``keys``."""
    return trips.groupBy(floor_time(t, 3600).alias("hour"), *keys).agg(F.count(F.lit(1)).alias("trips"))


def place_volume(
    trips: DataFrame, n: int = 10, *, route: Sequence[str] = ROUTE, label: str = "type"
) -> DataFrame:
    """Places with the most departures and arrivals of labelled trips between two places."""
    start, end = route
    legs = (
        trips.filter((F.col(label) == 1) & (F.col(start) != F.col(end)))
        .groupBy(start, end)
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return (
        legs.select(F.explode(F.array(start, end)).alias("name"), "_n")
        .groupBy("name")
        .agg(F.sum("_n").alias("volume"))
        .orderBy(F.desc("volume"), "name")
        .limit(n)
    )


def volume_asof(
    events: DataFrame, until: float, *, name: str = "name", label: str = "type", t: str = "t"
) -> DataFrame:
    """Events per place and label before a time."""
    return (
        events.filter(F.col(t) < until)
        .groupBy(name, label)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("type_name", type_name(label))
    )


def volume_series(
    events: DataFrame,
    times: DataFrame,
    *,
    name: str = "name",
    label: str = "type",
    t: str = "t",
    at: str = "at",
    n: str | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Events per place and label before each of many times, in one pass over the events.

    ``times`` has a column ``at``. A row of ``events`` counts ``n`` times if that column is named; those of
    one place, label and time are added up before anything is sorted. An event counts from the first of the times after it; those
    counts are added up along the times of a place. Places have rows from their first event on.
    An event without a time counts nowhere.
    """
    known = times.select(F.col(at).cast("double").alias(at)).na.drop().distinct()
    every = Window.orderBy(at)  # the times of a report, not of the events
    known = materialized(known.withColumn("_slot", F.row_number().over(every)))
    marks = known.select(F.col(at).alias("_t"), F.lit(0).alias("_kind"), "_slot")
    rows = (
        events.filter(F.col(t).isNotNull())
        .select(F.col(t).cast("double").alias("_t"), name, label, F.lit(1) if n is None else F.col(n))
        .toDF("_t", name, label, "_n")
        .groupBy("_t", name, label)
        .agg(F.sum("_n").alias("_n"), F.lit(1).alias("_kind"))
    )
    both = marks.unionByName(rows, allowMissingColumns=True).withColumn("_all", F.lit(0))
    both = materialized(both)

    def compute(part: DataFrame, slice_col: str | None) -> DataFrame:
        return slices.nearest_known(
            part, ["_all"], ["_t", "_kind"], {"_first": "_slot"}, forward=False, slice_col=slice_col
        )

    hot = slices.hot_keys(both, ["_all"], "_t") if hot is None else hot
    counted = (
        slices.per_key(both, "_t", hot, compute)
        .filter((F.col("_kind") == 1) & F.col("_first").isNotNull())
        .groupBy(name, label, "_first")
        .agg(F.sum("_n").alias("_n"))
    )
    along = Window.partitionBy(name, label).orderBy("_first")
    last = known.agg(F.max("_slot")).scalar()
    until = F.coalesce(F.lead("_first").over(along) - 1, last)
    totals = counted.select(
        name, label, F.sum("_n").over(along).alias("n"), "_first", until.alias("_until")
    ).withColumn("_slot", F.explode(F.sequence("_first", "_until")))
    return totals.join(known, "_slot").select(at, name, label, "n", type_name(label).alias("type_name"))


def snapshot(points: DataFrame, at: int, *, t: str = "t") -> DataFrame:
    """Points whose whole second is ``at``."""
    return points.filter(F.floor(t) == at)


def airline_bars(
    points: DataFrame, value: int, *, airline: str = "airline", label: str = "type"
) -> DataFrame:
    """Points per airline for one label."""
    return (
        points.filter(F.col(label) == value).groupBy(airline).agg(F.count(F.lit(1)).alias("n"))
    )


def label_by_time(df: DataFrame, *, t: str = "t", label: str = "type") -> DataFrame:
    return df.groupBy(t).agg(F.sum(label).alias("labelled"))


def altitude_bands(
    points: DataFrame, *, alt: str = "alt", label: str = "type", width: int = 5000
) -> DataFrame:
    """Points per altitude band and label."""
    band = (F.floor(F.col(alt) / width) * width).alias("band")
    return points.groupBy(band, type_name(label).alias("type_name")).agg(
        F.count(F.lit(1)).alias("n")
    )


def endpoint_events(
    trips: DataFrame,
    *,
    keep: Sequence[str] = ("flight", "type"),
    start: Sequence[str] = ("t0", "start_lon", "start_lat"),
    end: Sequence[str] = ("t1", "end_lon", "end_lat"),
    decimals: int = 3,
) -> DataFrame:
    """Start and end of each trip as two rows, positions as text with fixed decimals."""

    def event(which: str, t: str, lon: str, lat: str) -> Column:
        text = f"%.{decimals}f"
        return F.struct(
            F.lit(which).alias("event"),
            F.col(t).cast("bigint").alias("time"),
            F.format_string(text, F.col(lon)).alias("lon"),
            F.format_string(text, F.col(lat)).alias("lat"),
        )

    return trips.select(*keep, F.inline(F.array(event("start", *start), event("end", *end))))


def fixed_decimals(df: DataFrame, columns: Sequence[str], decimals: int = 3) -> DataFrame:
    """Numbers as text with a fixed number of decimals."""
    return df.withColumns({c: F.format_string(f"%.{decimals}f", F.col(c)) for c in columns})


def time_extent(trips: DataFrame, *, start: str = "t0", end: str = "t1") -> DataFrame:
    """First, last and number of distinct whole seconds at which a trip starts or ends."""
    times = trips.select(F.explode(F.array(F.floor(start), F.floor(end))).alias("t"))
    return times.agg(
        F.min("t").alias("first"), F.max("t").alias("last"), F.count_distinct("t").alias("times")
    )


def clean_features(
    trips: DataFrame,
    *,
    alt: str = "max_alt",
    time: str = "time",
    distance: str = "distance",
    max_alt: float = 60000,
    times: tuple[float, float] = (1800, 80000),
    min_distance: float = 100,
) -> DataFrame:
    """Cap the altitude; drop trips of odd duration, of short distance, or with any null."""
    low, high = times
    return trips.withColumns(
        {
            alt: F.least(F.col(alt), F.lit(max_alt)),
            time: F.when((F.col(time) > low) & (F.col(time) < high), F.col(time)),
            distance: F.when(F.col(distance) >= min_distance, F.col(distance)),
        }
    ).na.drop()


def feature_means(
    trips: DataFrame, features: Sequence[str], label: str = "type", by: Sequence[str] = ()
) -> DataFrame:
    return trips.groupBy(*by, label).agg(*[F.avg(f).alias(f) for f in features])


def histogram(
    df: DataFrame, column: str, bins: int = 10, *, by: Sequence[str] = ()
) -> DataFrame:
    """Counts and densities over equal bins between minimum and maximum, the same per group."""
    known = df.select(*by, F.col(column).cast("double").alias("_x")).filter("_x IS NOT NULL")
    lo, hi = known.agg(F.min("_x"), F.max("_x")).first()
    lo, width = lo or 0.0, ((hi or 0.0) - (lo or 0.0)) / bins
    position = F.floor((F.col("_x") - lo) / width) if width else F.lit(0)
    bin_ = F.least(position, F.lit(bins - 1)).cast("bigint")
    counts = known.groupBy(*by, bin_.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    sizes = counts.groupBy(*by).agg(F.sum("n").alias("_all"))
    joined = counts.join(sizes, list(by)) if by else counts.withColumn(
        "_all", sizes.select("_all").scalar()
    )
    return joined.select(
        *by,
        "bin",
        (F.lit(lo) + F.col("bin") * width).alias("lo"),
        "n",
        F.try_divide(F.col("n"), F.col("_all") * width).alias("density"),
    )


def kernel_density(df: DataFrame, column: str, points: int = KDE_POINTS) -> DataFrame:
    """Gaussian density on an even grid reaching half a range beyond the data.

    The bandwidth is the sample deviation times n ** -0.2. Equal values are counted first;
    every grid point is then one sum over them, in a single pass.
    """
    values = df.select(F.col(column).cast("double").alias("x")).na.drop()
    counts = values.groupBy("x").agg(F.count(F.lit(1)).alias("w"))
    lo, hi, n, sd = values.agg(
        F.min("x"), F.max("x"), F.count("x"), F.stddev_samp("x")
    ).first()
    if not sd:  # no value, or only one
        return counts.limit(0).select(
            F.lit(0).alias("point"), "x", F.col("x").alias("density")
        )
    first, step = lo - (hi - lo) / 2, (hi - lo) * 2 / (points - 1)
    bandwidth = sd * n**-0.2
    norm = n * bandwidth * math.sqrt(2 * math.pi)

    def bump(k: int) -> Column:
        z = (F.col("x") - (first + step * k)) / bandwidth
        return F.sum(F.col("w") * F.exp(z * z / -2))

    sums = counts.agg(F.array(*[bump(k) for k in range(points)]).alias("_sums"))
    return sums.select(F.posexplode("_sums").alias("point", "_sum")).select(
        "point",
        (F.lit(first) + F.col("point") * step).alias("x"),
        (F.col("_sum") / norm).alias("density"),
    )


def describe_text(df: DataFrame, by: str, column: str) -> DataFrame:
    """Per group: values, distinct values, the most frequent one and how often it is there."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(by, column).agg(
        F.count(F.lit(1)).alias("_n")
    )
    best = F.min_by(F.struct(column, "_n"), F.struct(-F.col("_n"), F.col(column)))
    return (
        counts.groupBy(by)
        .agg(
            F.sum("_n").alias("count"),
            F.count(F.lit(1)).alias("unique"),
            best.alias("_best"),
        )
        .select(
            by,
            "count",
            "unique",
            F.col(f"_best.{column}").alias("top"),
            F.col("_best._n").alias("freq"),
        )
    )


def parse_quantity(text: str, default: int) -> Column:
    """The number at the start of a text like "103,000 kg"; ``default`` where there is none."""
    number = F.regexp_replace(F.split(text, " ")[0], ",", "")
    return F.coalesce(number.try_cast("int"), F.lit(default))
