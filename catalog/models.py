"""Cleansing, training, statistics and prediction."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from catalog import query
from catalog.frames import TIME_SQL, table, time_samples
from gaugework.operators import cleanse
from gaugework.plans import models, selection
from gaugework.session import new_folder
from pyspark.ml import Pipeline

_RULES = {"view": "CASE WHEN value < 1 THEN NULL WHEN value > 100 THEN 100D ELSE value END", "error": "round(value)"}


@query("o1_cleanse_preview", f"""SELECT entity, signal, date, value_num AS value_before, CASE signal WHEN 'view' THEN CASE WHEN value_num < 1 THEN NULL ELSE 100 END
ELSE round(value_num) END AS value_after FROM {TIME_SQL} WHERE (signal = 'view' AND (value_num < 1 OR value_num > 100)) OR (signal = 'error' AND value_num <> round(value_num))""")
def cleanse_preview(spark, d):
    return cleanse.preview(time_samples(spark, d), _RULES).select("entity", "signal", "date", "value_before", "value_after")


@query("o1_cleanse_apply", f"""SELECT entity, signal, date, CASE signal WHEN 'view' THEN CASE WHEN value_num < 1 THEN NULL WHEN value_num > 100 THEN 100 ELSE value_num END
WHEN 'error' THEN round(value_num) ELSE value_num END AS value_num FROM {TIME_SQL}""")
def cleanse_apply(spark, d):
    return cleanse.apply(time_samples(spark, d), _RULES).select("entity", "signal", "date", "value_num")


def lines(spark, d):
    return table(spark, d, "lineitem")


_FEATURES = ["l_quantity", "l_discount", "l_tax"]


@query("o2_train_regression_line", """SELECT l_returnflag, count(*) AS n, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope FROM lineitem GROUP BY 1""")
def regression_line(spark, d):
    """One line per return flag, from sums; checked against SQL's own slope."""
    found = models.train_per_entity(lines(spark, d), "l_returnflag", ["l_quantity"], "l_extendedprice")
    return found.select("l_returnflag", "n", F.round(F.col("coefficients")[1], 4).alias("slope"))


@query("o2_train_regression", """SELECT l_orderkey, l_linenumber, l_quantity, round(a + b * l_quantity, 2) AS prediction
FROM lineitem, (SELECT regr_intercept(l_extendedprice, l_quantity) AS a, regr_slope(l_extendedprice, l_quantity) AS b FROM lineitem)""")
def train_regression(spark, d):
    rows = lines(spark, d).select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    model = models.train(rows, "regression", ["l_quantity"], "l_extendedprice")
    done = models.predict(model, rows)
    return done.select("l_orderkey", "l_linenumber", "l_quantity", F.round("prediction", 2).alias("prediction"))


def _classes(spark, d, kind, label, **options):
    rows = lines(spark, d).select(*_FEATURES, "l_extendedprice", F.col(label).alias("label"))
    model = models.train(rows, kind, [*_FEATURES, "l_extendedprice"], "label", **options)
    return models.predict(model, rows).groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))


@query("o2_train_binary")
def train_binary(spark, d):
    return _classes(spark, d, "binclass", "l_linestatus")


@query("o2_train_multiple")
def train_multiple(spark, d):
    return _classes(spark, d, "multi", "l_returnflag", normalisation="MinMax")


_GAUSS = " + ".join(f"ln(v{i}) + pow(x{i} - m{i}, 2) / v{i}" for i in range(4))


@query("o2_train_naive_bayes", f"""WITH r AS (SELECT row_number() OVER () AS id, l_returnflag AS label, l_quantity AS x0, l_discount AS x1, l_tax AS x2, l_extendedprice AS x3 FROM lineitem),
c AS (SELECT label AS class, row_number() OVER (ORDER BY label) - 1 AS k, count(*) AS n, {", ".join(f"avg(x{i}) AS m{i}, var_pop(x{i}) AS v{i}" for i in range(4))} FROM r GROUP BY 1),
p AS (SELECT id, label, arg_max(k, ln(n) - 0.5 * ({_GAUSS})) AS best FROM r, c GROUP BY 1, 2)
SELECT label, CAST(best AS DOUBLE) AS prediction, count(*) AS n FROM p GROUP BY 1, 2""")
def train_bayes(spark, d):
    return _classes(spark, d, "naive bayes", "l_returnflag")


@query("o2_train_naive_bayes_categorical", """WITH k AS (SELECT o_orderstatus AS s, row_number() OVER (ORDER BY o_orderstatus) - 1 AS i, count(*) AS n FROM orders GROUP BY 1),
f AS (SELECT count(DISTINCT o_orderpriority) + 1 AS features FROM orders),
c AS (SELECT o_orderpriority AS p, o_orderstatus AS s, count(*) AS n FROM orders GROUP BY 1, 2),
best AS (SELECT c.p, arg_max(k.i, ln(k.n + 1) + ln((c.n + 1) / (k.n + features))) AS i FROM c JOIN k ON c.s = k.s, f GROUP BY 1)
SELECT o_orderpriority, CAST(i AS DOUBLE) AS prediction, count(*) AS n FROM orders JOIN best ON p = o_orderpriority GROUP BY 1, 2""")
def train_bayes_categorical(spark, d):
    o = table(spark, d, "orders")
    model = models.train(o, "bayes categorical", ["o_orderpriority"], "o_orderstatus")
    return models.predict(model, o.select("o_orderkey", "o_orderpriority", "o_orderstatus")).groupBy("o_orderpriority", "prediction").agg(F.count(F.lit(1)).alias("n"))


@query("o7_predict_labels", """WITH k AS (SELECT o_orderstatus AS s, count(*) AS n FROM orders GROUP BY 1),
f AS (SELECT count(DISTINCT o_orderpriority) + 1 AS features FROM orders),
c AS (SELECT o_orderpriority AS p, o_orderstatus AS s, count(*) AS n FROM orders GROUP BY 1, 2),
best AS (SELECT c.p, arg_max(k.s, ln(k.n + 1) + ln((c.n + 1) / (k.n + features))) AS label FROM c JOIN k ON c.s = k.s, f GROUP BY 1)
SELECT o_orderpriority, label AS prediction, count(*) AS n FROM orders JOIN best ON p = o_orderpriority GROUP BY 1, 2""")
def predict_labels(spark, d):
    o = table(spark, d, "orders")
    model = models.train(o, "bayes categorical", ["o_orderpriority"], "o_orderstatus")
    return models.predict(model, o, as_labels=True).groupBy("o_orderpriority", "prediction").agg(F.count(F.lit(1)).alias("n"))


@query("o2_train_clusters")
def train_clusters(spark, d):
    rows = lines(spark, d).select("l_orderkey", *_FEATURES)
    model = models.train(rows, "cluster", _FEATURES, clusters=4)
    return models.predict(model, rows).groupBy("prediction").agg(F.count(F.lit(1)).alias("n"))


@query("o4_cross_validated")
def cross_validated(spark, d):
    rows = lines(spark, d).select(*_FEATURES, "l_extendedprice")
    model = models.train(rows, "reg", _FEATURES, "l_extendedprice", trainer="linear", cross_folds=2)
    return models.regression_metrics(models.predict(model, rows), "l_extendedprice")


def _normalised(spark, d, name, **options):
    rows = table(spark, d, "part").select("p_partkey", F.col("p_size").cast("double").alias("a"), F.col("p_retailprice").alias("b"))
    stages = models.normaliser(name, ["a", "b"], "v", **options)
    done = Pipeline(stages=stages).fit(rows).transform(rows)
    v = vector_to_array("v")
    return done.select("p_partkey", F.round(v[0], 6).alias("a"), F.round(v[1], 6).alias("b"))


_TWO = "(SELECT p_partkey, CAST(p_size AS DOUBLE) AS a, p_retailprice AS b FROM part)"


def _whole(expression: str) -> str:
    """The same expression for a and b."""
    return ", ".join(f"round({expression.replace('?', c)}, 6) AS {c}" for c in "ab")


@query("o3_normalise_auto", f"SELECT p_partkey, {_whole('(? - avg(?) OVER ()) / stddev_samp(?) OVER ()')} FROM {_TWO}")
def normalise_auto(spark, d):
    return _normalised(spark, d, "auto")


@query("o3_normalise_mean_variance", f"SELECT p_partkey, {_whole('(? - avg(?) OVER ()) / stddev_samp(?) OVER ()')} FROM {_TWO}")
def normalise_mean(spark, d):
    return _normalised(spark, d, "mean var")


@query("o3_normalise_min_max", f"SELECT p_partkey, {_whole('(? - min(?) OVER ()) / (max(?) OVER () - min(?) OVER ())')} FROM {_TWO}")
def normalise_min_max(spark, d):
    return _normalised(spark, d, "min max")


@query("o3_normalise_log_mean_variance", f"SELECT p_partkey, {_whole('(? - avg(?) OVER ()) / stddev_samp(?) OVER ()')} FROM (SELECT p_partkey, ln(1 + a) AS a, ln(1 + b) AS b FROM {_TWO})")
def normalise_log(spark, d):
    return _normalised(spark, d, "log mean variance")


@query("o3_normalise_lp_norm", f"SELECT p_partkey, {_whole('? / sqrt(a * a + b * b)')} FROM {_TWO}")
def normalise_lp(spark, d):
    return _normalised(spark, d, "lp")


@query("o3_normalise_global_contrast", f"SELECT p_partkey, {_whole('(? - (a + b) / 2) / sqrt(pow(a - (a + b) / 2, 2) + pow(b - (a + b) / 2, 2))')} FROM {_TWO}")
def normalise_contrast(spark, d):
    return _normalised(spark, d, "global contrast")


def _rank(c: str, p: float) -> str:
    return f"(SELECT quantile_disc({c}, {p}) FROM {_TWO})"


@query("o3_normalise_robust", "SELECT p_partkey, " + ", ".join(
    f"round(({c} - {_rank(c, 0.5)}) / ({_rank(c, 0.75)} - {_rank(c, 0.25)}), 6) AS {c}" for c in "ab") + f" FROM {_TWO}")
def normalise_robust(spark, d):
    return _normalised(spark, d, "robust scaling")


@query("o3_normalise_binning", "SELECT p_partkey, " + ", ".join(
    f"(SELECT CAST(count(DISTINCT q) AS DOUBLE) FROM (SELECT unnest(quantile_disc({c}, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS q FROM {_TWO}) WHERE q <= r.{c}) AS {c}"
    for c in "ab") + f" FROM {_TWO} r")
def normalise_binning(spark, d):
    return _normalised(spark, d, "binning")


@query("o3_normalise_supervised_binning")
def normalise_supervised(spark, d):
    rows = table(spark, d, "part").select("p_partkey", F.col("p_size").cast("double").alias("a"), F.col("p_retailprice").alias("b"))
    return _normalised(spark, d, "super bin", df=rows, label="b")


def _binned(spark, d, label, by_class):
    rows = table(spark, d, "part").select("p_partkey", F.col("p_size").cast("double").alias("a"), label.cast("double").alias("y"))
    cuts = models.supervised_cuts(rows, ["a"], "y", by_class)[0][1:-1]
    bin_ = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < F.col("a")))
    return rows.select("p_partkey", bin_.alias("bin"))


@query("o3_supervised_bins_of_numbers", """SELECT p_partkey, CAST((p_size > 12) AS INTEGER) + CAST((p_size > 31) AS INTEGER) AS bin FROM part""")
def supervised_bins_of_numbers(spark, d):
    return _binned(spark, d, F.when(F.col("p_size") > 31, 40).when(F.col("p_size") > 12, 7).otherwise(1), False)


@query("o3_supervised_bins_of_classes", """SELECT p_partkey, CAST((p_size > 9) AS INTEGER) + CAST((p_size > 25) AS INTEGER) + CAST((p_size > 40) AS INTEGER) AS bin FROM part""")
def supervised_bins_of_classes(spark, d):
    size = F.col("p_size")
    return _binned(spark, d, F.when((size > 9) & (size <= 25), 2).when(size > 40, 1).otherwise(0), True)


@query("o4_split_by_key", """SELECT o_orderkey, CASE WHEN s < 0.2 THEN 'test' WHEN s < 0.28 THEN 'validation' ELSE 'train' END AS part FROM (
SELECT o_orderkey, CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS s FROM orders)""")
def split_by_key(spark, d):
    parts = models.split(table(spark, d, "orders").select("o_orderkey"), "o_orderkey", 0.2, 0.1)
    done = [df.withColumn("part", F.lit(n)) for n, df in parts.items()]
    return done[0].unionByName(done[1]).unionByName(done[2])


@query("o4_complete_cases", """SELECT p_partkey, p_size, p_retailprice FROM part WHERE p_size > 5 AND p_retailprice < 1500""")
def complete_cases(spark, d):
    rows = table(spark, d, "part").select(
        "p_partkey", F.when(F.col("p_size") > 5, F.col("p_size")).alias("p_size"), F.when(F.col("p_retailprice") < 1500, F.col("p_retailprice")).alias("p_retailprice"))
    return models.complete_cases(rows, ["p_size", "p_retailprice"])


@query("o4_model_per_entity", """SELECT l_suppkey, count(*) AS n, round(regr_slope(l_extendedprice, l_quantity), 3) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 3) AS intercept FROM lineitem GROUP BY 1""")
def model_per_entity(spark, d):
    found = models.train_per_entity(lines(spark, d), "l_suppkey", ["l_quantity"], "l_extendedprice")
    c = F.col("coefficients")
    return found.select("l_suppkey", "n", F.round(c[1], 3).alias("slope"), F.round(c[0], 3).alias("intercept"))


@query("o5_training_statistics", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(x) AS n_known, count(*) - count(x) AS n_missing, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS deviation,
min(x) AS low, max(x) AS high, round(corr(x, l_extendedprice), 6) AS label_correlation FROM (SELECT CASE WHEN l_quantity > 2 THEN {c} END AS x, l_extendedprice FROM lineitem)"""
    for c in ("l_quantity", "l_tax")))
def training_statistics(spark, d):
    rows = lines(spark, d).select("l_extendedprice", *[F.when(F.col("l_quantity") > 2, F.col(c)).alias(c) for c in ("l_quantity", "l_tax")])
    done = models.training_statistics(rows, ["l_quantity", "l_tax"], "l_extendedprice")
    return done.withColumns({c: F.round(c, 6) for c in ("mean", "deviation", "label_correlation")})


_METRICS = """count(*) AS n, round(avg(abs(y - p)), 4) AS mae, round(sqrt(avg((y - p) * (y - p))), 4) AS rmse, round(1 - avg((y - p) * (y - p)) / var_pop(y), 6) AS r2
FROM (SELECT l_suppkey, l_extendedprice AS y, l_quantity * 1500 AS p FROM lineitem)"""


def _metrics(spark, d, by):
    rows = lines(spark, d).withColumn("prediction", F.col("l_quantity") * 1500)
    done = models.regression_metrics(rows, "l_extendedprice", by=by)
    return done.withColumns({"mae": F.round("mae", 4), "rmse": F.round("rmse", 4), "r2": F.round("r2", 6)})


@query("o6_regression_metrics", f"SELECT {_METRICS}")
def metrics(spark, d):
    return _metrics(spark, d, None)


@query("o6_regression_metrics_per_entity", f"SELECT l_suppkey, {_METRICS} GROUP BY 1")
def metrics_per_entity(spark, d):
    return _metrics(spark, d, ["l_suppkey"])


@query("o6_classification_metrics", """WITH r AS (SELECT o_orderstatus AS y, CASE WHEN o_totalprice > 250000 THEN 'O' WHEN o_totalprice > 100000 THEN 'F' ELSE 'P' END AS p FROM orders)
SELECT c AS class, CAST(count(*) FILTER (y = c) AS BIGINT) AS support, round(count(*) FILTER (y = c AND p = c) / count(*) FILTER (p = c), 6) AS "precision",
round(count(*) FILTER (y = c AND p = c) / count(*) FILTER (y = c), 6) AS recall FROM r, (SELECT DISTINCT y AS c FROM r) GROUP BY 1""")
def class_metrics(spark, d):
    price = F.col("o_totalprice")
    rows = table(spark, d, "orders").withColumn("prediction", F.when(price > 250000, "O").when(price > 100000, "F").otherwise("P"))
    done = models.classification_metrics(rows, "o_orderstatus")
    return done.withColumns({"precision": F.round("precision", 6), "recall": F.round("recall", 6)})


@query("o7_predict_per_entity", """SELECT l_suppkey, l_orderkey, l_linenumber, l_quantity, round(b0 + b1 * l_quantity, 2) AS prediction FROM lineitem
JOIN (SELECT l_suppkey AS k, regr_intercept(l_extendedprice, l_quantity) AS b0, regr_slope(l_extendedprice, l_quantity) AS b1 FROM lineitem GROUP BY 1) ON k = l_suppkey""")
def predict_per_entity(spark, d):
    rows = lines(spark, d)
    fitted = models.train_per_entity(rows, "l_suppkey", ["l_quantity"], "l_extendedprice")
    done = models.predict_per_entity(rows, fitted, "l_suppkey", ["l_quantity"])
    return done.select("l_suppkey", "l_orderkey", "l_linenumber", "l_quantity", F.round("prediction", 2).alias("prediction"))


@query("o8_features_of_definition", """SELECT l_orderkey, l_quantity, l_discount, l_tax FROM lineitem""")
def features_of_definition(spark, d):
    columns = ["Entity", "Date", "l_quantity", "l_discount", "l_tax", "l_extendedprice"]
    return lines(spark, d).select("l_orderkey", *models.feature_columns(columns, "l_extendedprice"))


# A line's place in [0, 1) by its key, and its price by quantity with some noise that no feature shows.
_LINES = """(SELECT CAST('0x' || substr(md5(CAST(l_orderkey * 10 + l_linenumber AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS s,
l_quantity AS x, 1000 * l_quantity + 500 * l_discount AS y FROM lineitem)"""


def _keyed_lines(spark, d):
    price = 1000 * F.col("l_quantity") + 500 * F.col("l_discount")
    return lines(spark, d).select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("l_quantity").alias("x"), price.alias("y"))


def _scores_rounded(df):
    return df.withColumns({c: F.round(c, 4) for c in ("rmse", "mae", "r2")})


_ERRORS = """count(*) AS n, round(sqrt(avg((y - p) * (y - p))), 4) AS rmse, round(avg(abs(y - p)), 4) AS mae, round(1 - avg((y - p) * (y - p)) / var_pop(y), 4) AS r2"""


@query("o2_best_trainer", f"""WITH r AS (SELECT *, CASE WHEN s < 0.2 THEN 'test' WHEN (s - 0.2) / 0.8 < 0.25 THEN 'validation' ELSE 'train' END AS part FROM {_LINES}),
m AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM r WHERE part = 'train'),
p AS (SELECT part, y, a + b * x AS p FROM r, m WHERE part <> 'train')
SELECT 'linear' AS trainer, part, {_ERRORS} FROM p GROUP BY part""")
def best_trainer(spark, d):
    """Two trainers judged on validation rows; the better one's scores there and on the test rows."""
    rows = _keyed_lines(spark, d)
    found = selection.search(rows, "regression", ["x"], "y", "id", ["forest", "linear"], "rmse", validation_fraction=0.25, test_fraction=0.2)
    return _scores_rounded(found.scores.where(F.col("trainer") == found.trainer))


@query("o4_folds", f"""WITH r AS (SELECT *, CAST(floor(s * 3) AS INTEGER) AS k FROM {_LINES}),
m AS (SELECT f AS fold, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM r, (SELECT unnest([0, 1, 2]) AS f) WHERE k <> f GROUP BY f),
p AS (SELECT fold, y, a + b * x AS p FROM r JOIN m ON k = fold)
SELECT 'linear' AS trainer, 'fold ' || CAST(fold AS VARCHAR) AS part, {_ERRORS} FROM p GROUP BY fold""")
def folds(spark, d):
    found = selection.search(_keyed_lines(spark, d), "regression", ["x"], "y", "id", "linear", cross_folds=3)
    return _scores_rounded(found.scores)


@query("o2_separable_classes", """SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber > 4 THEN 'late' ELSE 'early' END AS prediction FROM lineitem""")
def separable_classes(spark, d):
    """Classes that one cut parts, predicted by a model that was stored by name and loaded again."""
    late = F.when(F.col("l_linenumber") > 4, "late").otherwise("early")
    rows = lines(spark, d).select("l_orderkey", "l_linenumber", F.col("l_linenumber").cast("double").alias("x"), late.alias("y"))
    found = selection.search(rows, "binclass", ["x"], "y", "l_orderkey", "forest", "f1", validation_fraction=0.3)
    root = new_folder(spark, "o2m")
    selection.save_model(spark, found.model, root, "late lines", ["x"], "y", trainer=found.trainer)
    model, about = selection.load_model(spark, root, "late lines")
    done = models.predict(model, rows.drop(about["label"]), as_labels=True)
    return done.select("l_orderkey", "l_linenumber", "prediction")


@query("o2_parted_clusters", """SELECT CAST(l_linenumber % 3 AS DOUBLE) AS low, CAST(l_linenumber % 3 AS DOUBLE) AS high, count(*) AS n FROM lineitem GROUP BY 1""")
def parted_clusters(spark, d):
    """Three groups far apart, each a cluster."""
    rows = lines(spark, d).select((F.col("l_linenumber") % 3).cast("double").alias("g"), "l_tax")
    rows = rows.withColumn("x", F.col("g") * 1000 + F.col("l_tax"))
    model = models.train(rows, "cluster", ["x"], clusters=3)
    return models.predict(model, rows).groupBy("prediction").agg(F.min("g").alias("low"), F.max("g").alias("high"), F.count(F.lit(1)).alias("n")).drop("prediction")
