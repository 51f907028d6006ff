"""Training, statistics and prediction with ``pyspark.ml`` and plain aggregates."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (
    ClassificationModel,
    GBTClassifier, LogisticRegression, NaiveBayes, RandomForestClassifier,
)
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import (
    Bucketizer, MinMaxScaler, Normalizer, OneHotEncoder, QuantileDiscretizer, RobustScaler, SQLTransformer, StandardScaler,
    StringIndexer, VectorAssembler, StringIndexerModel,
)
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugework.functions.names import col, quoted
from gaugework.functions.vocabulary import canonical
from gaugework.operators.joins import lookup

SEED = 17
BINS = 10
FINE_BINS, TREE_DEPTH = 256, 3  # of supervised binning: bins that are counted, and levels of cuts
QUANTILE_ERROR = 1e-4
DEFAULT_CLUSTERS = 5
TRAINERS: dict[str, dict[str, type]] = {
    "Regression": {"linear": LinearRegression, "boosted": GBTRegressor, "forest": RandomForestRegressor},
    "BinaryClassification": {"logistic": LogisticRegression, "boosted": GBTClassifier, "forest": RandomForestClassifier},
    "MultipleClassification": {"forest": RandomForestClassifier, "logistic": LogisticRegression},
    "Clustering": {"kmeans": KMeans},
    "NaiveBayes": {"bayes": NaiveBayes},
    "NaiveBayesCategorical": {"bayes": NaiveBayes},
}
_CLASSES = {"BinaryClassification", "MultipleClassification", "NaiveBayes", "NaiveBayesCategorical"}


def feature_columns(columns: list[str], label: str | None, index: tuple[str, ...] = ("Entity", "Date", "Depth")) -> list[str]:
    """All columns of a table definition but the label and the index."""
    return [c for c in columns if c != label and c not in index]


def complete_cases(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.na.drop("any", subset=[quoted(c) for c in columns])


def share(key: Column) -> Column:
    """A row's place in [0, 1) by the MD5 of its key: the same on every run and cluster."""
    digits = F.substring(F.md5(key.cast("string")), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / F.lit(4294967296.0)


def split(df: DataFrame, key: str, test_fraction: float = 0.0, validation_fraction: float = 0.1) -> dict[str, DataFrame]:
    """Train, validation and test rows by key; validation is a fraction of what is not test."""
    s = share(col(key))
    edge = test_fraction + (1 - test_fraction) * validation_fraction
    return {
        "test": df.where(s < test_fraction),
        "validation": df.where((s >= test_fraction) & (s < edge)),
        "train": df.where(s >= edge),
    }


def fine_bins(df: DataFrame, features: list[str]) -> list[list[float]]:
    """Inner edges of at most FINE_BINS bins of each feature by equal depth; with no more distinct values than that, one bin each."""
    shares = [i / FINE_BINS for i in range(1, FINE_BINS + 1)]
    few = df.agg(*[F.approx_count_distinct(col(f), 0.01).alias(f"n{i}") for i, f in enumerate(features)]).first()
    out: list[list[float]] = [[] for _ in features]
    narrow = [i for i in range(len(features)) if few[i] <= 2 * FINE_BINS]
    if narrow:
        sets = df.agg(*[F.collect_set(col(features[i]).cast("double")).alias(f"s{i}") for i in narrow]).first()
        for i, values in zip(narrow, sets):
            out[i] = sorted(v for v in values if v == v) if len(values) <= FINE_BINS else []
    wide = [i for i in range(len(features)) if not out[i]]
    cells = [col(features[i]).cast("double").alias(f"v{i}") for i in wide]
    for i, edges in zip(wide, df.select(*cells).approxQuantile([f"v{i}" for i in wide], shares, QUANTILE_ERROR) if wide else []):
        out[i] = sorted(set(edges))
    return out


def supervised_cuts(df: DataFrame, features: list[str], label: str, by_class: bool, depth: int = TREE_DEPTH) -> list[list[float]]:
    """Cut points of each feature that part the label best, with infinite ends: all features in one pass.

    Rows are counted by fine bin before the shuffle: per class, or with the sum and the sum of squares of a number. What reaches the
    driver is one row per feature, fine bin and class. Cuts are then chosen on these sums, the greatest gain of entropy or variance
    first, each part again up to `depth` levels; a cut lies half-way between the values on its two sides.
    """
    edges = fine_bins(df, features)
    def below(ends: list[float], value: Column) -> Column:
        return F.size(F.filter(F.array(*map(F.lit, ends)).cast("array<double>"), lambda e: e < value))

    values = [col(f).cast("double") for f in features]
    cells = [F.struct(F.lit(i).alias("f"), v.alias("v"), below(ends, v).alias("bin")) for i, (v, ends) in enumerate(zip(values, edges))]
    y = col(label)
    # The label's new name must not be that of a feature, which the cells would take for it.
    long = df.select(y.cast("double").alias("__y"), F.inline(F.array(*cells))).withColumnRenamed("__y", "y").where("v is not null and not isnan(v)")
    keys = ["f", "bin", *(["y"] if by_class else [])]
    sums = long.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("s"), F.sum(F.col("y") * F.col("y")).alias("q"), F.min("v").alias("low"), F.max("v").alias("high"),
    ).toPandas()
    out = []
    for i in range(len(features)):
        mine = sums[sums["f"] == i]
        ends = mine.groupby("bin").agg(low=("low", "min"), high=("high", "max"))
        if by_class:
            stats = mine.pivot(index="bin", columns="y", values="n").fillna(0).to_numpy(float)
        else:
            stats = mine.set_index("bin").sort_index()[["n", "s", "q"]].to_numpy(float)
        found = _best_cuts(stats, _entropy if by_class else _variance, depth)
        low, high = ends["low"].to_numpy(), ends["high"].to_numpy()
        out.append([float("-inf"), *[float(high[c - 1] + (low[c] - high[c - 1]) / 2) for c in found], float("inf")])
    return out


def _entropy(counts: np.ndarray) -> np.ndarray:
    """Rows times entropy, of rows of class counts."""
    n = counts.sum(-1, keepdims=True)
    return -(counts * np.log(np.divide(counts, n, out=np.ones_like(counts), where=counts > 0))).sum(-1)


def _variance(moments: np.ndarray) -> np.ndarray:
    """Sum of squared distances from the mean, of rows of (n, sum, sum of squares)."""
    n, s, q = np.moveaxis(moments, -1, 0)
    return np.maximum(q - np.divide(s * s, n, out=np.zeros_like(s), where=n > 0), 0)


def _best_cuts(stats: np.ndarray, cost, depth: int) -> list[int]:
    """Places between bins, in order, that lower the cost most; none where nothing is gained."""
    if depth == 0 or len(stats) < 2:
        return []
    left = np.cumsum(stats, 0)[:-1]
    gains = cost(stats.sum(0)) - cost(left) - cost(stats.sum(0) - left)
    at = int(np.argmax(gains)) + 1
    if gains[at - 1] <= 1e-9 * max(1.0, float(cost(stats.sum(0)))):
        return []
    return [*_best_cuts(stats[:at], cost, depth - 1), at, *[at + c for c in _best_cuts(stats[at:], cost, depth - 1)]]


def normaliser(name: str, features: list[str], out: str, df: DataFrame | None = None, label: str | None = None, p: float = 2.0, by_class: bool = False) -> list:
    """Pipeline stages from feature columns to one normalised vector column."""
    kind = canonical("normalisation", name)
    raw, safe = "__raw", [quoted(f) for f in features]
    gather = VectorAssembler(inputCols=features, outputCol=raw)
    if kind in ("Auto", "MeanVariance"):
        return [gather, StandardScaler(inputCol=raw, outputCol=out, withMean=True, withStd=True)]
    if kind == "MinMax":
        return [gather, MinMaxScaler(inputCol=raw, outputCol=out)]
    if kind == "RobustScaling":
        return [gather, RobustScaler(inputCol=raw, outputCol=out, withCentering=True, withScaling=True, relativeError=QUANTILE_ERROR)]
    if kind == "LpNorm":
        return [gather, Normalizer(inputCol=raw, outputCol=out, p=p)]
    names = [f"__n{i}" for i in range(len(features))]
    gather_new = VectorAssembler(inputCols=names, outputCol=raw)
    if kind == "LogMeanVariance":
        cells = ", ".join(f"signum({c}) * log1p(abs({c})) AS {n}" for c, n in zip(safe, names))
        return [SQLTransformer(statement=f"SELECT *, {cells} FROM __THIS__"), gather_new,
                StandardScaler(inputCol=raw, outputCol=out, withMean=True, withStd=True)]
    if kind == "GlobalContrast":
        mean = "(" + " + ".join(safe) + f") / {len(safe)}"
        norm = "sqrt(" + " + ".join(f"pow({c} - {mean}, 2)" for c in safe) + ")"
        cells = ", ".join(f"coalesce(({c} - {mean}) / nullif({norm}, 0D), 0D) AS {n}" for c, n in zip(safe, names))
        return [SQLTransformer(statement=f"SELECT *, {cells} FROM __THIS__"), VectorAssembler(inputCols=names, outputCol=out)]
    if kind == "Binning":
        cut = QuantileDiscretizer(inputCols=features, outputCols=names, numBuckets=BINS, relativeError=QUANTILE_ERROR)
    else:
        splits = supervised_cuts(df, features, label, by_class)
        cut = Bucketizer(splitsArray=splits, inputCols=features, outputCols=names)
    return [cut, VectorAssembler(inputCols=names, outputCol=out)]


def train(
    df: DataFrame,
    model_type: str,
    features: list[str],
    label: str | None = None,
    normalisation: str = "Auto",
    trainer: str | None = None,
    only_complete: bool = True,
    clusters: int = 0,
    cross_folds: int = 0,
) -> PipelineModel:
    """Fit one pipeline: normalisation and model; text labels and categories are indexed first."""
    kind = canonical("model type", model_type)
    known = TRAINERS[kind]
    if trainer is not None and trainer not in known:
        raise ValueError(f"trainer '{trainer}' is not one of {list(known)}")
    rows = complete_cases(df, [*features, *([label] if label else [])]) if only_complete else df
    stages: list = []
    target = label
    if kind in _CLASSES:
        target = "__label"
        stages.append(StringIndexer(inputCol=label, outputCol=target, stringOrderType="alphabetAsc", handleInvalid="error"))
    if kind == "NaiveBayesCategorical":
        indexed, hot = [f"__i{i}" for i in range(len(features))], [f"__h{i}" for i in range(len(features))]
        stages += [
            StringIndexer(inputCols=features, outputCols=indexed, stringOrderType="alphabetAsc", handleInvalid="keep"),
            OneHotEncoder(inputCols=indexed, outputCols=hot, dropLast=False),
            VectorAssembler(inputCols=hot, outputCol="__features"),
        ]
    else:
        supervised = stages and canonical("normalisation", normalisation) == "SupervisedBinning"
        labelled = stages[0].fit(rows).transform(rows) if supervised else rows
        stages += normaliser(normalisation, features, "__features", labelled, target, by_class=kind in _CLASSES)
    model: Estimator = (known[trainer] if trainer else next(iter(known.values())))()
    model.setFeaturesCol("__features")
    if kind == "Clustering":
        model.setK(clusters or DEFAULT_CLUSTERS).setSeed(SEED)
    else:
        model.setLabelCol(target)
    if kind == "NaiveBayes":
        model.setModelType("gaussian")
    if cross_folds > 1 and kind != "Clustering":
        judge = (MulticlassClassificationEvaluator if kind in _CLASSES else RegressionEvaluator)(labelCol=target)
        grid = ParamGridBuilder()
        if model.hasParam("regParam"):
            grid = grid.addGrid(model.getParam("regParam"), [0.0, 0.1])
        model = CrossValidator(estimator=model, estimatorParamMaps=grid.build(), evaluator=judge, numFolds=cross_folds, seed=SEED)
    return Pipeline(stages=[*stages, model]).fit(rows)


def label_names(model: PipelineModel) -> list[str] | None:
    """The classes of a classifier in order of their index: those of the stage that indexed its label column. None for other models."""
    fitted = model.stages[-1]
    while hasattr(fitted, "bestModel"):
        fitted = fitted.bestModel
    label = fitted.getOrDefault("labelCol") if isinstance(fitted, ClassificationModel) else None
    return next((list(s.labels) for s in model.stages if isinstance(s, StringIndexerModel) and s.getOutputCol() == label), None)


def predict(model: PipelineModel, df: DataFrame, as_labels: bool = False) -> DataFrame:
    """Input columns and ``prediction``: a number, or for classifiers, where asked for, the class's label.

    Other models have no labels; their predictions stay numbers.
    """
    done = model.transform(df).select(*[col(c) for c in df.columns], "prediction")
    names = label_names(model) if as_labels else None
    if names is None:
        return done
    return done.withColumn("prediction", F.element_at(F.array(*map(F.lit, names)), F.col("prediction").cast("int") + 1))


# --- one linear model per entity, from sums ---------------------------------------------------------
def train_per_entity(df: DataFrame, entity: str, features: list[str], label: str) -> DataFrame:
    """Least-squares coefficients per entity: (entity, n, coefficients), intercept first.

    The normal equations need only sums of products, which combine before the shuffle; each entity is
    then one small system to solve, whatever its number of rows. Sums are taken around the overall means
    of the entity's own first pass, so large offsets do not cancel.
    """
    rows = complete_cases(df, [entity, *features, label])
    names = [*features, label]
    k = len(features)
    moments = [F.avg(col(c)).alias(f"m{i}") for i, c in enumerate(names)]
    cross = [
        F.covar_pop(col(a), col(b)).alias(f"c{i}_{j}") for i, a in enumerate(names) for j, b in enumerate(names) if j >= i and i < k
    ]
    sums = rows.groupBy(col(entity)).agg(F.count(F.lit(1)).alias("n"), *moments, *cross)
    upper = [f"c{i}_{j}" for i in range(k) for j in range(i, k)]
    right = [f"c{i}_{k}" for i in range(k)]

    @F.pandas_udf("array<double>")
    def solve(means: pd.Series, covariances: pd.Series, targets: pd.Series) -> pd.Series:
        out = []
        for m, c, t in zip(means, covariances, targets):
            a = np.zeros((k, k))
            a[np.triu_indices(k)] = c
            a = a + np.triu(a, 1).T
            slopes = np.linalg.lstsq(a, np.asarray(t), rcond=None)[0]
            out.append([float(m[k] - slopes @ np.asarray(m[:k])), *map(float, slopes)])
        return pd.Series(out)

    means = F.array(*[F.col(f"m{i}") for i in range(k + 1)])
    solved = solve(means, F.array(*map(F.col, upper)), F.array(*map(F.col, right)))
    return sums.select(col(entity), "n", solved.alias("coefficients"))


def predict_per_entity(df: DataFrame, coefficients: DataFrame, entity: str, features: list[str]) -> DataFrame:
    c = F.col("coefficients")
    value = c[0]
    for i, f in enumerate(features):
        value = value + c[i + 1] * col(f)
    fitted = lookup(df, coefficients.select(entity, "coefficients"), [entity], "inner")
    return fitted.withColumn("prediction", value).drop("coefficients")


# --- statistics ---------------------------------------------------------------------------------------
def training_statistics(df: DataFrame, columns: list[str], label: str) -> DataFrame:
    """Per column: known and missing values, mean, deviation, extremes, correlation with the label.

    One aggregate over all columns, unpivoted afterwards.
    """
    parts = []
    for c in columns:
        v = col(c).cast("double")
        parts.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count(v).alias("n_known"),
                F.count(F.when(v.isNull(), F.lit(1))).alias("n_missing"),
                F.avg(v).alias("mean"),
                F.stddev_samp(v).alias("deviation"),
                F.min(v).alias("low"),
                F.max(v).alias("high"),
                F.corr(v, col(label).cast("double")).alias("label_correlation"),
            )
        )
    return df.agg(F.array(*parts).alias("s")).select(F.inline("s"))


def regression_metrics(df: DataFrame, label: str, prediction: str = "prediction", by: list[str] | None = None) -> DataFrame:
    """n, mae, rmse and r2, overall or per group."""
    y, p = col(label), col(prediction)
    cells = [
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(y - p)).alias("mae"),
        F.sqrt(F.avg((y - p) * (y - p))).alias("rmse"),
        (1 - F.avg((y - p) * (y - p)) / F.nullif(F.var_pop(y), F.lit(0.0))).alias("r2"),
    ]
    return df.groupBy(*map(col, by)).agg(*cells) if by else df.agg(*cells)


def classification_metrics(df: DataFrame, label: str, prediction: str = "prediction", by: list[str] | None = None) -> DataFrame:
    """Per class: support, precision, recall; ``by`` splits them further."""
    groups = list(map(col, by or []))
    y, p = col(label), col(prediction)
    seen = df.select(*groups, F.inline(F.array(
        F.struct(y.alias("class"), F.lit(1).alias("is_label"), (y == p).cast("int").alias("hit")),
        F.struct(p.alias("class"), F.lit(0).alias("is_label"), (y == p).cast("int").alias("hit")),
    )))
    total = seen.groupBy(*groups, "class").agg(
        F.sum("is_label").alias("support"),
        F.sum(1 - F.col("is_label")).alias("predicted"),
        F.sum(F.col("is_label") * F.col("hit")).alias("hits"),
    )
    return total.select(
        *groups, "class", "support",
        (F.col("hits") / F.nullif(F.col("predicted"), F.lit(0))).alias("precision"),
        (F.col("hits") / F.nullif(F.col("support"), F.lit(0))).alias("recall"),
    )
