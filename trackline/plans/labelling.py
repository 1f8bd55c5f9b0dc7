"""Queries that label trips: matching, daylight, outliers, samples, classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackline.operators import ensembles, fuzzy, labels, ml, ranking, report
from trackline.plans.places import rounded
from trackline.plans.registry import query
from trackline.plans.reports import trips
from trackline.plans.views import SQL, Inputs
from trackline.session import materialized, scratch_dir, side_by_side

RATIO = 0.5  # the given flights have more positive than negative entities
RATIOS = [k / 10 for k in (10, 5, 4, 3.5, 3, 2.5, 2, 1.8, 1.6, 1.3, 1.2, 1.1, 1)]
DEPTH = 5  # of the registered queries; a thousand trees of the default depth take too long here (README)
CLIPPED = ("max_alt", "time", "distance")

SQL["matches"] = (
    "models model_names",
    """SELECT model, name AS match, score FROM (
         SELECT model, name, 100 * (1 - levenshtein(lower(model), lower(name))
                                    / greatest(length(model), length(name))) AS score
         FROM (SELECT DISTINCT model FROM models), model_names)
       WHERE score >= 70
       QUALIFY row_number() OVER (PARTITION BY model ORDER BY score DESC, name) = 1""",
)
SQL["lit"] = (
    "flights",
    "SELECT flight, "
    + ", ".join(
        f"""CASE WHEN {e}_rise IS NULL THEN NULL WHEN {t} > {e}_rise AND {t} <= {e}_set THEN 1
                 ELSE 0 END AS {e}area, ({t} - {e}_rise) / 86400 AS {e}_sunrise,
            ({t} - {e}_set) / 86400 AS {e}_sunset"""
        for e, t in (("start", "t0"), ("end", "t1"))
    )
    + " FROM (SELECT *, "
    + ", ".join(
        f"({e}_transit - {e}_w + 0.5) * 86400 + 946684800 AS {e}_rise, "
        f"({e}_transit + {e}_w + 0.5) * 86400 + 946684800 AS {e}_set"
        for e in ("start", "end")
    )
    + " FROM (SELECT *, "
    + ", ".join(
        f"""CASE WHEN abs({e}_cosw) <= 1 THEN degrees(acos({e}_cosw)) / 360 END AS {e}_w"""
        for e in ("start", "end")
    )
    + " FROM (SELECT *, "
    + ", ".join(
        f"""(sin(radians(-0.833)) - sin(radians({e}_lat)) * {e}_sind)
            / (cos(radians({e}_lat)) * sqrt(1 - {e}_sind * {e}_sind)) AS {e}_cosw,
            {e}_j + 0.0053 * sin(radians({e}_m)) - 0.0069 * sin(radians(2 * {e}_l))
            AS {e}_transit"""
        for e in ("start", "end")
    )
    + " FROM (SELECT *, "
    + ", ".join(
        f"sin(radians({e}_l)) * sin(radians(23.4397)) AS {e}_sind" for e in ("start", "end")
    )
    + " FROM (SELECT *, "
    + ", ".join(
        f"""({e}_m + 1.9148 * sin(radians({e}_m)) + 0.02 * sin(radians(2 * {e}_m))
             + 0.0003 * sin(radians(3 * {e}_m)) + 282.9372) % 360 AS {e}_l"""
        for e in ("start", "end")
    )
    + " FROM (SELECT *, "
    + ", ".join(
        f"CAST(357.5291 + 0.98560028 * {e}_j AS DOUBLE) % 360 AS {e}_m" for e in ("start", "end")
    )
    + " FROM (SELECT *, "
    + ", ".join(
        f"floor({t} / 86400) - 10957 - {e}_lon / 360 AS {e}_j"
        for e, t in (("start", "t0"), ("end", "t1"))
    )
    + " FROM flights)))))))",
)


def learnable(i: Inputs) -> DataFrame:
    """Flights with all the features a classifier uses."""
    lit = labels.daylight_features(trips(i))
    return lit.withColumn("avg_speed", F.try_divide("distance", "time"))


def matches(i: Inputs) -> DataFrame:
    return fuzzy.fuzzy_match(i.models(), i.model_names(), name="model", entry="name")


@query(
    "fuzzy_match",
    """SELECT model, match, round(score, 9) AS score
       FROM (SELECT DISTINCT model FROM models) LEFT JOIN matches USING (model)""",
    "models matches",
)
def _fuzzy_match(i: Inputs) -> DataFrame:
    return rounded(matches(i), "score", decimals=9)


@query(
    "attach_model",
    """SELECT part, model, coalesce(match, 'else') AS match
       FROM models LEFT JOIN matches USING (model)""",
    "models matches",
)
def _attach_model(i: Inputs) -> DataFrame:
    attached = fuzzy.attach_model(i.models(), matches(i), i.model_names(), key="part")
    return attached.select("part", "model", "match")


@query(
    "model_sum",
    """SELECT coalesce(match, 'else') AS match, CAST(sum(type) AS BIGINT) AS cargo
       FROM models LEFT JOIN matches USING (model) GROUP BY 1""",
    "models matches",
)
def _model_sum(i: Inputs) -> DataFrame:
    attached = fuzzy.attach_model(i.models(), matches(i), i.model_names(), key="part")
    return attached.groupBy("match").agg(F.sum("type").alias("cargo"))


SQL["matched"] = (
    "models matches model_dictionary",
    """SELECT part, models.model, coalesce(match, 'else') AS match,
              coalesce(TRY_CAST(replace(split_part(d.payload, ' ', 1), ',', '') AS INTEGER), 103000) AS kg,
              coalesce(TRY_CAST(replace(split_part(d.range, ' ', 1), ',', '') AS INTEGER), 5500) AS km
       FROM models LEFT JOIN matches ON models.model = matches.model
       LEFT JOIN model_dictionary d ON d.name = matches.match WHERE models.type = 1""",
)
QUANTITIES = {"kg": ("payload", 103000), "km": ("range", 5500)}


def matched(i: Inputs) -> DataFrame:
    """Labelled aircraft with payload and range of the dictionary row that their model matches."""
    cargo = i.models().filter("type = 1").select("part", "model")
    found = fuzzy.fuzzy_match(cargo, i.model_names(), name="model", entry="name")
    attached = fuzzy.attach_model(cargo, found, i.model_dictionary(), key="part")
    numbers = {c: report.parse_quantity(text, other) for c, (text, other) in QUANTITIES.items()}
    return attached.withColumns(numbers).select("part", "model", "match", *QUANTITIES)


@query("matched_quantities", "SELECT part, match, kg, km FROM matched", "matched")
def _matched_quantities(i: Inputs) -> DataFrame:
    return matched(i).select("part", "match", "kg", "km")


@query(
    "quantity_counts",
    """SELECT 'kg' AS quantity, kg AS value, count(*) AS n FROM matched GROUP BY kg
       UNION ALL SELECT 'km', km, count(*) FROM matched GROUP BY km""",
    "matched",
)
def _quantity_counts(i: Inputs) -> DataFrame:
    """How many labelled aircraft have each payload and each range."""
    each = F.inline(F.array(*[F.struct(F.lit(c).alias("quantity"), F.col(c).alias("value")) for c in QUANTITIES]))
    return matched(i).select(each).groupBy("quantity", "value").agg(F.count(F.lit(1)).alias("n"))


@query(
    "quantity_quantiles",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS quantity, {q}::DOUBLE AS level,
                   round(quantile_cont(CAST({c} AS DOUBLE), {q}), 6) AS value FROM matched"""
        for c in QUANTITIES
        for q in (0.05, 0.25, 0.5, 0.75, 0.95)
    ),
    "matched",
)
def _quantity_quantiles(i: Inputs) -> DataFrame:
    """The five levels that are drawn into the density of payload and of range."""
    found = materialized(matched(i))
    kg, km = (
        ranking.quantiles(found, c, (0.05, 0.25, 0.5, 0.75, 0.95)).withColumn("quantity", F.lit(c))
        for c in QUANTITIES
    )
    return rounded(kg.unionByName(km), "value")


@query(
    "range_density",
    f"""SELECT point, any_value(round(x, 6)) AS x,
               round(sum(exp((km - x) / h * (km - x) / h / -2)) / any_value(n * h * sqrt(2 * pi())), 9) AS density
        FROM (SELECT *, lo + width * 2 * point / {report.KDE_POINTS - 1} AS x
              FROM (SELECT km::DOUBLE AS km FROM matched),
                   (SELECT min(km) - (max(km) - min(km)) / 2.0::DOUBLE AS lo, count(*) AS n,
                           (max(km) - min(km))::DOUBLE AS width,
                           stddev_samp(km) * count(*) ** -0.2 AS h FROM matched),
                   (SELECT CAST(unnest(range({report.KDE_POINTS})) AS INTEGER) AS point))
        GROUP BY point""",
    "matched",
)
def _range_density(i: Inputs) -> DataFrame:
    found = report.kernel_density(materialized(matched(i)), "km")
    return rounded(rounded(found, "x"), "density", decimals=9)


@query(
    "daylight_features",
    """SELECT flight, startarea, endarea, round(start_sunrise, 6) AS start_sunrise,
              round(start_sunset, 6) AS start_sunset, round(end_sunrise, 6) AS end_sunrise,
              round(end_sunset, 6) AS end_sunset FROM lit""",
    "lit",
)
def _daylight_features(i: Inputs) -> DataFrame:
    days = ("start_sunrise", "start_sunset", "end_sunrise", "end_sunset")
    found = labels.daylight_features(i.flights())
    return rounded(found.select("flight", "startarea", "endarea", *days), *days)


@query(
    "sigma_clip",
    "SELECT flight, "
    + ", ".join(
        f"round(least(greatest({c}, m_{c} - 2 * s_{c}), m_{c} + 2 * s_{c}), 6) AS {c}"
        for c in CLIPPED
    )
    + " FROM trips, (SELECT "
    + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in CLIPPED)
    + " FROM trips) WHERE "
    + " AND ".join(f"{c} BETWEEN m_{c} - 3 * s_{c} AND m_{c} + 3 * s_{c}" for c in CLIPPED),
    "trips",
)
def _sigma_clip(i: Inputs) -> DataFrame:
    clipped = labels.sigma_clip(trips(i), CLIPPED)
    return rounded(clipped.select("flight", *CLIPPED), *CLIPPED)


@query(
    "balance_sample",
    f"""WITH negative AS (
          SELECT arg_min(flight, {{'t': t0, 'f': flight}}) AS flight, entity FROM flights
          WHERE type = 0 GROUP BY entity),
        chosen AS (
          SELECT flight FROM negative
          QUALIFY row_number() OVER (ORDER BY md5(CAST(entity AS VARCHAR)), entity)
               <= floor({RATIO * 0.2} * (SELECT count(*) FROM flights WHERE type = 1)))
        SELECT flight, type FROM flights
        WHERE type = 1 OR flight IN (SELECT flight FROM chosen)""",
    "flights",
)
def _balance_sample(i: Inputs) -> DataFrame:
    return labels.balance_sample(i.flights(), ratio=RATIO * 0.2).select("flight", "type")


@query(
    "label_fill",
    """SELECT flight, coalesce(type, CASE WHEN max_alt > 30000 THEN 1 ELSE 0 END) AS type
       FROM flights""",
    "flights",
)
def _label_fill(i: Inputs) -> DataFrame:
    """Guesses by a fixed rule, so that the filling itself can be checked."""
    flights = i.flights()
    guessed = flights.filter("type IS NULL").select(
        "flight", (F.col("max_alt") > 30000).cast("int").alias("type")
    )
    return labels.label_fill(flights, guessed, key="flight").select("flight", "type")


@query(
    "confusion",
    """SELECT truth, CAST(score >= 0.5 AS INTEGER) AS predicted, count(*) AS n
       FROM scores GROUP BY ALL""",
    "scores",
)
def _confusion(i: Inputs) -> DataFrame:
    guessed = i.scores().withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
    return ml.confusion(guessed, truth="truth", predicted="predicted")


@query(
    "metrics",
    """SELECT (tp + tn) / (tp + fp + fn + tn) AS accuracy, 2 * tp / (2 * tp + fp + fn) AS f1
       FROM (SELECT count(*) FILTER (truth = 1 AND p) AS tp, count(*) FILTER (truth = 0 AND p) AS fp,
                    count(*) FILTER (truth = 1 AND NOT p) AS fn,
                    count(*) FILTER (truth = 0 AND NOT p) AS tn
             FROM (SELECT truth, score >= 0.5 AS p FROM scores))""",
    "scores",
)
def _metrics(i: Inputs) -> DataFrame:
    guessed = i.scores().withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
    return ml.metrics(guessed, truth="truth", predicted="predicted")


SQL["sides"] = (
    "flights",
    f"""SELECT *, substr(md5(CAST(entity AS VARCHAR) || ':0'), 1, 8)
                  < '{round(0.2 * 16**8):08x}' AS test FROM flights""",
)


@query("train_test_split", "SELECT flight, entity, test FROM sides", "sides")
def _train_test_split(i: Inputs) -> DataFrame:
    """Four fifths of the entities for training, the others for tests."""
    train, test = ml.split(i.flights().select("flight", "entity"))
    return train.withColumn("test", F.lit(False)).unionByName(test.withColumn("test", F.lit(True)))


@query(
    "scaled_features",
    """SELECT flight, round((max_alt - lo_alt) / (hi_alt - lo_alt), 9) AS max_alt,
              round((t0 - lo_t) / (hi_t - lo_t), 9) AS t0
       FROM sides, (SELECT min(max_alt) AS lo_alt, max(max_alt) AS hi_alt, min(t0) AS lo_t,
                           max(t0) AS hi_t FROM sides WHERE NOT test)
       WHERE max_alt IS NOT NULL AND t0 IS NOT NULL""",
    "sides",
)
def _scaled_features(i: Inputs) -> DataFrame:
    """Features of all flights on the scale of the training rows."""
    flights = i.flights().select("flight", "entity", F.col("max_alt").cast("double").alias("max_alt"), "t0")
    flights = flights.na.drop(subset=["max_alt", "t0"])
    train, _ = ml.split(flights)
    found = ml.scaled(train, flights, ["max_alt", "t0"])
    return rounded(found.select("flight", "max_alt", "t0"), "max_alt", "t0", decimals=9)


SQL["roc"] = (
    "scores",
    """SELECT threshold, fp / sum(neg) OVER () AS fpr, tp / sum(pos) OVER () AS tpr
       FROM (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp
             FROM (SELECT score AS threshold, count(*) FILTER (truth = 1) AS pos,
                          count(*) FILTER (truth = 0) AS neg FROM scores GROUP BY score)
             WINDOW w AS (ORDER BY threshold DESC))""",
)


@query(
    "roc_points",
    """SELECT round(threshold, 9) AS threshold, round(fpr, 9) AS fpr, round(tpr, 9) AS tpr
       FROM roc""",
    "roc",
)
def _roc_points(i: Inputs) -> DataFrame:
    points = ranking.roc_points(i.scores(), "score", "truth")
    return rounded(points, "threshold", "fpr", "tpr", decimals=9)


@query(
    "roc_threshold",
    """SELECT round(threshold, 9) AS threshold, round(fpr, 9) AS fpr, round(tpr, 9) AS tpr
       FROM roc ORDER BY abs(threshold - 0.5), threshold DESC LIMIT 1""",
    "roc",
)
def _roc_threshold(i: Inputs) -> DataFrame:
    points = ranking.roc_points(i.scores(), "score", "truth")
    return rounded(
        ranking.nearest_threshold(points), "threshold", "fpr", "tpr", decimals=9
    )


FOLDERS: dict[tuple[str, str], str] = {}  # where the forest of a session and a data folder lies


def kept(i: Inputs, name: str, make) -> DataFrame:
    """A table that several queries of a session use: written once, made again only if it is gone."""
    path = f"{forest_folder(i)}/{name}"
    if not ensembles.is_complete(i.spark, path):
        make().write.mode("overwrite").parquet(path)
    return i.spark.read.parquet(path)


def forest_folder(i: Inputs) -> str:
    key = i.spark.sparkContext.applicationId, i.sf_dir
    return FOLDERS.setdefault(key, scratch_dir(i.spark))


def sides(i: Inputs) -> tuple[DataFrame, DataFrame]:
    """Training and test rows."""
    both = kept(i, "known", lambda: learnable(i))
    made: list[DataFrame] = []

    def side(number: int) -> DataFrame:
        if not made:
            made.extend(ml.training_set(both, RATIO))
        return made[number]

    return kept(i, "train", lambda: side(0)), kept(i, "test", lambda: side(1))


def forest(i: Inputs) -> list:
    """The blocks of the forest, fitted once in a session and read from the shared folder after that."""
    return ensembles.fit_forest(sides(i)[0], f"{forest_folder(i)}/forest", depth=DEPTH)


def scored(i: Inputs) -> DataFrame:
    """Test rows with the forest's score and label."""
    return kept(i, "scored", lambda: ensembles.forest_predict(forest(i), sides(i)[1]))


@query("rf_metrics")
def _rf_metrics(i: Inputs) -> DataFrame:
    found = ml.metrics(scored(i), truth="type", predicted="predicted")
    return found.select(F.lit("random_forest").alias("model"), "*")


@query("rf_confusion")
def _rf_confusion(i: Inputs) -> DataFrame:
    return ml.confusion(scored(i), truth="type", predicted="predicted")


@query("rf_roc")
def _rf_roc(i: Inputs) -> DataFrame:
    """The curve of the forest's own scores; ``chosen`` marks the point nearest to 0.5."""
    points = materialized(ranking.roc_points(scored(i), "score", "type"))
    best = ranking.nearest_threshold(points).select(F.col("threshold").alias("_best"))
    return points.join(best, points.threshold == best._best, "left").select(
        "threshold", "fpr", "tpr", F.col("_best").isNotNull().alias("chosen")
    )


@query("rf_importances")
def _rf_importances(i: Inputs) -> DataFrame:
    """What each feature gains in the trees, and what accuracy is lost without it."""
    blocks, (_, test) = forest(i), sides(i)
    gains = i.spark.createDataFrame(ensembles.impurity_importances(blocks), "feature string, gain double")
    lost = ensembles.permutation_importances(blocks, test, "flight")
    return gains.join(lost, "feature")


@query("rf_label_fill")
def _rf_label_fill(i: Inputs) -> DataFrame:
    """Labels of all flights, the unknown ones as the forest says."""
    every = kept(i, "known", lambda: learnable(i))
    unknown = every.filter("type IS NULL").na.drop(subset=list(ml.FEATURES))
    guessed = ensembles.forest_predict(forest(i), unknown)
    guessed = guessed.select("flight", F.col("predicted").alias("type"))
    return labels.label_fill(every, guessed, key="flight").select("flight", "type")


@query("model_compare")
def _model_compare(i: Inputs) -> DataFrame:
    """All families on the same rows; the forest is the one of ``rf_metrics``."""
    train, test = sides(i)
    others = [m for m in ml.MODELS if m != "random_forest"]
    compared, forest_rows = side_by_side(
        [lambda: ml.compare(train, test, others, depth=DEPTH), lambda: _rf_metrics(i)], train
    )
    return compared.unionByName(forest_rows)


@query("ratio_sweep")
def _ratio_sweep(i: Inputs) -> DataFrame:
    """One family over all ratios; the given flights have few negative entities, so tenths of them."""
    every = kept(i, "known", lambda: learnable(i))
    return ml.ratio_sweep(every, RATIOS, ["decision_tree"], depth=DEPTH)
