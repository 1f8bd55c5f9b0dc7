"""Operators that avoid comparing everything, against comparing everything."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackline.operators import fuzzy, labels, medoid, ml, nearest, ranking, routes, slices


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_nearest_place_all_over_the_globe(spark):
    rng = random.Random(1)

    def spot():
        return round(math.degrees(math.asin(rng.uniform(-1, 1))), 2), round(rng.uniform(-180, 180), 2)

    places = [(f"p{k:03d}", *spot()) for k in range(150)]
    places += [("north", 89.9, 10.0), ("south", -89.95, 0.0), ("east", 10.0, 179.95)]
    places += [(f"c{k:03d}", 50 + rng.random(), 5 + rng.random()) for k in range(100)]
    points = [(k, *spot()) for k in range(300)]
    points += [(400, 89.99, -170.0), (401, -90.0, 0.0), (402, 10.0, -179.99), (403, 50.51, 5.49)]
    points += [(500, None, 3.0)]
    got = nearest.nearest_place(
        spark.createDataFrame(points, "id int, lat double, lon double"),
        spark.createDataFrame(places, "name string, lat double, lon double"),
    ).collect()
    assert len(got) == len(points)

    def km(a, b, c, d):
        a, b, c, d = map(math.radians, (a, b, c, d))
        h = math.sin((a - c) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((b - d) / 2) ** 2
        return 2 * 6378.137 * math.asin(math.sqrt(min(1, h)))

    rounded = [(name, round(lat, 2), round(lon, 2)) for name, lat, lon in places]
    for r in got:
        if r.lat is None:
            assert r.place_name is None
            continue
        best = min(km(r.lat, r.lon, lat, lon) for _, lat, lon in rounded)
        assert r.place_km == pytest.approx(best, abs=1e-6)


def test_medoid(spark):
    rng = random.Random(2)
    trips = []
    for route, n, wild in (("a", 60, 0.15), ("b", 40, 0.9), ("c", 1, 0.1)):
        base = [chr(97 + k) for k in range(12)]
        for k in range(n):
            code = [c for c in base if rng.random() > wild / 2]
            if rng.random() < wild:
                rng.shuffle(code)
            trips.append((route, "z", k, "".join(code) or "a"))
    trips += [("a", "z", 100 + k, "abcdefghijkl") for k in range(30)]
    df = spark.createDataFrame(trips, "start string, end string, id int, code string")
    got = {(r.start, r.id, r.total) for r in medoid.route_medoid(df).collect()}
    want = set()
    for route in "abc":
        mine = [(k, code) for r, _, k, code in trips if r == route]
        totals = {k: sum(levenshtein(code, other) for _, other in mine) for k, code in mine}
        want |= {(route, k, t) for k, t in totals.items() if t == min(totals.values())}
    assert got == want


def test_medoid_bound_is_a_bound(spark):
    rng = random.Random(3)
    codes = ["".join(rng.choices("abcde", k=rng.randint(1, 9))) for _ in range(80)]
    df = spark.createDataFrame([("r", c) for c in codes], "route string, code string")
    sequences = df.groupBy("route", "code").agg(F.count(F.lit(1)).alias("w"))
    for r in medoid._bounded(sequences, ["route"]).collect():
        assert r._bound <= sum(levenshtein(r.code, c) for c in codes)


@pytest.mark.parametrize("cutoff", [50, 70, 90])
def test_fuzzy_match(spark, cutoff):
    rng = random.Random(4)
    words = ["".join(rng.choices("abcd", k=rng.randint(1, 14))) for _ in range(60)]

    def spoil(word):
        letters = list(word)
        for _ in range(rng.randint(0, 5)):
            at = rng.randrange(len(letters) + 1)
            letters[at : at + rng.randint(0, 1)] = rng.choices("abcd", k=rng.randint(0, 1))
        return "".join(letters).title() or "a"

    names = sorted({spoil(w) for w in words for _ in range(4)})
    got = fuzzy.fuzzy_match(
        spark.createDataFrame([(n,) for n in names], "name string"),
        spark.createDataFrame([(w,) for w in words], "word string"),
        name="name",
        entry="word",
        cutoff=cutoff,
    )
    found = {r.name: (r.match, r.score) for r in got.collect()}
    assert set(found) == set(names)
    for name in names:
        scores = {
            w: 100 * (1 - levenshtein(name.lower(), w) / max(len(name), len(w))) for w in words
        }
        best = min(scores, key=lambda w: (-scores[w], w))
        if round(scores[best], 9) >= cutoff:
            assert found[name][0] == best
            assert found[name][1] == pytest.approx(scores[best])
        else:
            assert found[name] == (None, None)


@pytest.mark.parametrize("values", [[3.0], [1.0, 2.0], [5.0] * 40 + [1.0, 9.0], None])
def test_quantiles(spark, values):
    rng = np.random.default_rng(5)
    values = list(map(float, rng.lognormal(3, 2, 2000).round(2))) if values is None else values
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    levels = [0.0, 0.05, 0.25, 0.5, 0.95, 1.0]
    got = {r.level: r.value for r in ranking.quantiles(df, "x", levels).collect()}
    assert set(got) == set(levels)
    for q in levels:
        assert got[q] == pytest.approx(float(np.quantile(values, q)))


@pytest.mark.parametrize("n", [0, 1, 37, 500, 900])
def test_hashed_sample_has_exactly_n_rows(spark, n):
    df = spark.range(500)
    got = {r.id for r in ranking.hashed_sample(df, "id", n).collect()}
    import hashlib

    ranked = sorted(range(500), key=lambda k: hashlib.md5(str(k).encode()).hexdigest())
    assert got == set(ranked[:n])


def test_running_total_of_scores(spark):
    rng = random.Random(6)
    data = [(rng.random(), rng.randint(0, 1)) for _ in range(400)]
    got = ranking.roc_points(spark.createDataFrame(data, "s double, y int"), "s", "y").collect()
    positives = sum(y for _, y in data)
    for r in got:
        hits = sum(y for s, y in data if s >= r.threshold)
        assert r.tpr == pytest.approx(hits / positives)
    assert max(r.fpr for r in got) == max(r.tpr for r in got) == 1


def test_sigma_clip_bounds(spark):
    rng = random.Random(7)
    data = [(rng.gauss(0, 1), rng.expovariate(1)) for _ in range(1000)] + [(50.0, 1.0)]
    df = spark.createDataFrame(data, "a double, b double")
    a, b = (np.array([d[k] for d in data]) for k in (0, 1))
    kept = (abs(a - a.mean()) <= 3 * a.std()) & (abs(b - b.mean()) <= 3 * b.std())
    got = labels.sigma_clip(df, ["a", "b"]).toPandas()
    assert len(got) == kept.sum() < len(data)
    for column, values in (("a", a), ("b", b)):
        assert got[column].max() <= values.mean() + 2 * values.std() + 1e-9
        assert got[column].min() >= values.mean() - 2 * values.std() - 1e-9


def test_adjacency_sizes(spark):
    legs = [("a", "b"), ("a", "b"), ("b", "a"), ("c", "c")]
    got = {
        r.name: (r["size"], [tuple(x) for x in r.imports or []])
        for r in routes.adjacency(spark.createDataFrame(legs, "start string, end string")).collect()
    }
    assert got == {"a": (3, [("b", 2)]), "b": (3, [("a", 1)]), "c": (2, [("c", 1)])}


def test_split_keeps_entities_together(spark):
    df = spark.range(3000).withColumn("entity", F.col("id") % 300)
    train, test = ml.split(df)
    assert train.count() + test.count() == 3000
    assert train.join(test, "entity", "left_semi").count() == 0
    assert 0.1 < test.count() / 3000 < 0.3


def test_no_hot_keys_in_ordinary_data(spark):
    df = spark.range(1000).selectExpr("id % 7 AS entity", "id AS t")
    assert slices.hot_keys(df, ["entity"], "t").count() == 0


def test_nearest_place_does_not_pair_places_with_points(spark, monkeypatch):
    """Pairs of cubes that are looked at stay of the order of the cubes, however many places there are."""
    rng = random.Random(5)

    def spots(n):
        at = [(math.degrees(math.asin(rng.uniform(-1, 1))), rng.uniform(-180, 180)) for _ in range(n)]
        return [(f"p{k}", *x) for k, x in enumerate(at)]

    places = spark.createDataFrame(spots(8000), "name string, lat double, lon double")
    points = spark.createDataFrame(spots(400), "id string, lat double, lon double")
    counts, plain = [], nearest._nearest_only
    monkeypatch.setattr(
        nearest, "_nearest_only", lambda pairs, *rest: counts.append(pairs.count()) or plain(pairs, *rest)
    )
    assert nearest.nearest_place(points, places).where("place_name IS NULL").count() == 0
    assert max(counts) < 400 * 8000 / 10


def test_fuzzy_rows_grow_with_the_length(spark):
    rng = random.Random(6)
    words = [("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n)),) for n in (20, 80, 320) for _ in range(5)]
    texts = spark.createDataFrame(words, "text string")
    rarity = spark.createDataFrame([], "_width int, _gram string, _texts bigint")
    rows = fuzzy.prefixes(texts, rarity, 70).groupBy("_length").count().collect()
    assert {r["_length"]: r["count"] / 5 / r["_length"] < 0.75 for r in rows} == dict.fromkeys((20, 80, 320), True)


def test_long_names_find_their_entries(spark):
    rng = random.Random(7)
    words = sorted({"".join(rng.choices("abcdefgh ", k=rng.choice((40, 90, 200)))) for _ in range(40)})

    def spoil(word):
        letters = list(word)
        for _ in range(int(len(word) * rng.uniform(0.1, 0.8))):
            at = rng.randrange(len(letters))
            letters[at : at + rng.randint(0, 1)] = rng.choices("abcdefgh ", k=rng.randint(0, 1))
        return "".join(letters)

    names = sorted({spoil(w) for w in words})
    got = fuzzy.fuzzy_match(
        spark.createDataFrame([(n,) for n in names], "name string"),
        spark.createDataFrame([(w,) for w in words], "word string"),
        name="name",
        entry="word",
    )
    found = {r.name: r.match for r in got.collect()}
    for name in names:
        reached = []
        for word in words:
            longer = max(len(name), len(word))
            edits = levenshtein(name, word)
            if 100 * (longer - edits) >= 70 * longer:
                reached.append((edits / longer, word))
        assert found[name] == (min(reached)[1] if reached else None)
    assert None in found.values() and len(set(found.values())) > 10


def test_equally_distant_trips_are_not_all_compared(spark):
    rng = random.Random(8)
    codes = ["".join(rng.sample("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", 16)) for _ in range(300)]
    df = spark.createDataFrame([("r", k, c) for k, c in enumerate(codes)], "route string, id int, code string")
    log = []
    got = {(r.id, r.total) for r in medoid.route_medoid(df, route=["route"], log=log).collect()}
    totals = [0] * 300
    for a in range(300):
        for b in range(a):
            d = levenshtein(codes[a], codes[b])
            totals[a] += d
            totals[b] += d
    assert got == {(k, t) for k, t in enumerate(totals) if t == min(totals)}
    assert sum(log) < 0.65 * 300 * 300, log


def test_medoid_with_more_cells_than_symbols(spark):
    rng = random.Random(9)
    rows, trips = [], []
    for route, n, vocabulary in (("wide", 30, 60), ("narrow", 20, 9)):
        for k in range(n):
            trips.append((route, "z", f"{route}{k}", k))
            cells = rng.sample(range(vocabulary), rng.randint(1, 9))
            rows += [(f"{route}{k}", k, f"{c}.5,{c}", t) for t, c in enumerate(cells)]
    cells = spark.createDataFrame(rows, "entity string, seg int, token string, at int")
    table = spark.createDataFrame(trips, "start string, end string, entity string, seg int")
    coded = medoid.coded_sequences(cells, table, symbols=20)
    codes = {r.entity: r.code for r in coded.collect()}
    assert codes["wide3"].startswith(medoid.WIDE) and not codes["narrow3"].startswith(medoid.WIDE)
    tokens = {}
    for entity, _, token, _ in rows:
        tokens.setdefault(entity, []).append(token)
    want = set()
    for route in ("wide", "narrow"):
        mine = [e for r, _, e, _ in trips if r == route]
        totals = {e: sum(levenshtein(tokens[e], tokens[o]) for o in mine) for e in mine}
        want |= {(e, t) for e, t in totals.items() if t == min(totals.values())}
    assert {(r.entity, r.total) for r in medoid.route_medoid(coded).collect()} == want


def test_edit_distance_of_arrays(spark):
    rng = random.Random(10)
    pairs = [([rng.choice("abcdé日") for _ in range(rng.randrange(7))], [rng.choice("abcdé日") for _ in range(rng.randrange(7))]) for _ in range(80)]
    pairs += [(["x"] * 300, ["x", "y"] * 150), ([], []), (["a"], [])]
    df = spark.createDataFrame(pairs, "a array<string>, b array<string>")
    got = df.select("a", "b", medoid.edit_distance(F.col("a"), F.col("b")).alias("d")).collect()
    assert [r.d for r in got] == [levenshtein(r.a, r.b) for r in got]
