"""Published vectors and small tables worked out by hand."""

import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from trackline.functions import cpr
from trackline.functions import messages as msg
from trackline.functions.geo import haversine_km
from trackline.functions.sun import sun
from trackline.operators import feed, labels, medoid, report, resample, tracks


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


MESSAGES = [
    # text, reason, format, sender, type code
    ("8d70605c990d8c14b00428000000", None, 17, "70605c", 19),
    ("8d4840d6202cc371c32ce0576098", None, 17, "4840d6", 4),
    ("8d4840d6202cc371c32ce0576099", "parity", 17, "4840d6", 4),
    ("8D4840D6202CC371C32CE0576098", None, 17, "4840d6", 4),
    ("8d4840d6202cc371c32ce057609", "length", None, None, None),
    ("8d4840d6202cc371c32ce05760zz", "hex", None, None, None),
    (None, "length", None, None, None),
]


def test_messages(spark):
    df = spark.createDataFrame([(m[0],) for m in MESSAGES], "raw string")
    text = F.col("raw")
    got = feed.checked(df).select(
        "raw",
        "reject",
        msg.downlink_format(text).alias("df"),
        msg.entity_id(text).alias("entity"),
        msg.type_code(text).alias("tc"),
    ).collect()
    for row, (_, reason, *fields) in zip(got, MESSAGES):
        assert row.reject == reason
        if reason in (None, "parity"):
            assert [row.df, row.entity, row.tc] == fields


def test_call_sign_and_kinds(spark):
    texts = ["8d4840d6202cc371c32ce0576098", "02e19690e94ab2", "a800149ec65632b0a80187fa5e1e"]
    df = spark.createDataFrame([(t,) for t in texts], "raw string")
    first, short, reply = feed.with_kind(df).withColumn("who", msg.identity(F.col("raw"))).collect()
    assert first.who.rstrip() == "KLM1023"
    assert first.msg_type == "Identification messages"
    assert (short.protocol, short.msg_type) == ("Short air-air ACAS", None)
    assert reply.protocol == "Comm-B identify reply"


def test_position_of_the_published_pair(spark):
    pair = [("8D40621D58C386435CC412692AD6", 1.0), ("8D40621D58C382D690C8AC2863A7", 2.0)]
    df = spark.createDataFrame(pair, "raw string, t double")
    fix = feed.position_fix(feed.pair_latest(feed.positions(df))).collect()
    assert len(fix) == 1
    assert fix[0].entity == "40621d"
    assert fix[0].lat == pytest.approx(52.2572, abs=1e-4)
    assert fix[0].lon == pytest.approx(3.91937, abs=1e-5)
    assert fix[0].alt == 38000


def test_old_messages_do_not_pair(spark):
    pair = [("8D40621D58C386435CC412692AD6", 1.0), ("8D40621D58C382D690C8AC2863A7", 12.0)]
    df = spark.createDataFrame(pair, "raw string, t double")
    assert feed.pair_latest(feed.positions(df)).count() == 0


@pytest.mark.parametrize("lat, zones", [(0.0, 59), (52.2572, 36), (-33.9, 49), (87.0, 2), (88, 1)])
def test_longitude_zones(spark, lat, zones):
    assert one(spark, n=cpr.longitude_zones(F.lit(float(lat)))).n == zones


DEMO = [
    ("15409a", 31.0, 5), ("15409a", 37.0, 15), ("15409a", 33.0, 21),
    ("15409b", 33.0, 3), ("15409b", 34.0, 14), ("15409b", 10.0, 26), ("15409b", 5.0, 2),
]


def test_interpolation_table(spark):
    df = spark.createDataFrame(DEMO, "entity string, lon double, tick bigint")
    got = resample.interpolate(df, keys=["entity"], values=["lon"])
    found = {(r.entity, r.tick): r.lon for r in got.collect()}
    assert len(found) == 17 + 25
    assert found["15409a", 10] == 34.0
    assert found["15409b", 8] == pytest.approx(33 + 5 / 11)
    assert all(found[e, t] == lon for e, lon, t in DEMO)
    filled = resample.fill_gaps(df, keys=["entity"], values=["lon"])
    x = [F.col(c).cast("double") for c in ("tick", "prev_known", "next_known")]
    line = resample.between(*x, F.col("prev_lon"), F.col("next_lon"))
    for r in filled.select("entity", "tick", line.alias("lon")).collect():
        assert r.lon == pytest.approx(found[r.entity, r.tick])


def test_wild_times_are_generated_in_blocks(spark):
    df = spark.createDataFrame([("a", 0), ("a", 20_000)], "entity string, tick bigint")
    grid = resample.time_grid(df, keys=["entity"], step=3)
    assert (grid.count(), grid.distinct().count()) == (6667, 6667)


def test_sun(spark):
    t = 1474156800 + 12 * 3600  # noon of 18 September 2016
    row = one(spark, s=sun(F.lit(t), F.lit(4.9), F.lit(52.37))).s
    assert row.rise - 1474156800 == pytest.approx((5 * 60 + 20) * 60, abs=60)
    assert row.set - 1474156800 == pytest.approx((17 * 60 + 48) * 60, abs=60)
    june = one(spark, s=sun(F.lit(1466424000), F.lit(15.0), F.lit(78.0)))
    assert june.s is None


def test_daylight_is_null_without_a_sunrise(spark):
    df = spark.createDataFrame(
        [(1466424000.0, 15.0, 78.0, 1474200000.0, 4.9, 52.37)],
        "t0 double, start_lon double, start_lat double, t1 double, end_lon double, end_lat double",
    )
    row = labels.daylight_features(df).first()
    assert (row.startarea, row.start_sunrise, row.endarea) == (None, None, 1)


@pytest.mark.parametrize(
    "a, b, d", [("kitten", "sitting", 3), ("", "abc", 3), ("abc", "", 3), ("", "", 0), ("ab", "ab", 0)]
)
def test_edit_distance(spark, a, b, d):
    df = spark.createDataFrame([(list(a), list(b))], "a array<string>, b array<string>")
    assert df.select(medoid.edit_distance(F.col("a"), F.col("b")).alias("d")).first().d == d


def test_haversine(spark):
    quarter = one(spark, d=haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(90.0))).d
    assert quarter == pytest.approx(6378.137 * math.pi / 2)
    across = one(spark, d=haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0))).d
    assert across == pytest.approx(6378.137 * math.pi)


def test_quality_needs_all_rules(spark):
    good = [100, 500, 900, 2000, 5000, 9000, 9000, 9000, 5000, 2000, 900, 500, 100]
    bad = [*good[:-1], 4000]
    data = [(n, 0, float(k), k, float(a)) for n, alts in (("good", good), ("bad", bad))
            for k, a in enumerate(alts)]
    df = spark.createDataFrame(data, "entity string, seg int, t double, id int, alt double")
    got = {r.entity: r.quality for r in tracks.track_quality(df, min_points=13).collect()}
    assert got == {"good": True, "bad": False}
    short = tracks.track_quality(df, min_points=14).filter("quality").count()
    assert short == 0


def test_zero_duration_has_no_speed(spark):
    df = spark.createDataFrame(
        [("a", 0, 1.0, 1, 5.0, 50.0, -10.0)],
        "entity string, seg int, t double, id int, lon double, lat double, alt double",
    )
    row = tracks.track_features(df).first()
    assert (row.time, row.avg_speed, row.max_alt, row.distance) == (0.0, None, 0.0, 0.0)


def test_parse_quantity(spark):
    df = spark.createDataFrame([("103,000 kg",), ("5500",), (None,), ("unknown",)], "x string")
    got = [r[0] for r in df.select(report.parse_quantity("x", 7)).collect()]
    assert got == [103000, 5500, 7, 7]


def test_shifted_labels_of_a_short_track(spark):
    data = [("a", float(k), k, 5.0, 50.0, 10.0) for k in range(6)]
    df = spark.createDataFrame(
        data, "entity string, t double, id int, lon double, lat double, alt double"
    )
    got = rows(tracks.segment_tracks(df, align="shifted").select("id", "seg"))
    assert sorted(got) == [(0, 0)] + [(k, None) for k in range(1, 6)]


def test_altitudes_in_the_older_code(spark):
    """Steps of 100 feet, each one bit away from the next, from -1200 feet up."""
    from trackline.functions.messages import coded_altitude

    codes = spark.range(4096).filter("id & 16 = 0").select("id", coded_altitude(F.col("id")).alias("feet"))
    by_feet = {int(r.feet): r.id for r in codes.filter("feet IS NOT NULL").collect()}
    feet = sorted(by_feet)
    assert feet == list(range(-1200, 126_800, 100))
    assert all((by_feet[a] ^ by_feet[b]).bit_count() == 1 for a, b in zip(feet, feet[1:]))
