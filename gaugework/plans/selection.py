"""Choosing among trainers by held-out rows, and models kept by name."""

from __future__ import annotations

import json
from dataclasses import dataclass
from urllib.parse import quote, unquote

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugework.functions.names import col
from gaugework.functions.vocabulary import canonical
from gaugework.plans.models import TRAINERS, complete_cases, predict, regression_metrics, share, train
from gaugework.session import literal_table

# Metrics by which trainers are ranked; True where more is better.
REGRESSION_METRICS = {"rmse": False, "mae": False, "r2": True}
CLASS_METRICS = {"accuracy": True, "f1": True}
TEST = -1


@dataclass(frozen=True)
class Search:
    """The best trainer and its model; ``scores`` has a row per trainer and held-out part: trainer, part, n and the metrics."""

    model: PipelineModel
    trainer: str
    scores: DataFrame


def parts(key: Column, test_fraction: float = 0.0, validation_fraction: float = 0.1, folds: int = 0) -> Column:
    """A row's part by the MD5 of its key: -1 for test, else its fold; without folds 0 for validation and 1 for training."""
    at = share(key)
    rest = (at - F.lit(test_fraction)) / F.lit(1.0 - test_fraction)
    if folds > 1:
        part = F.least(F.floor(rest * folds), F.lit(folds - 1))
    else:
        part = F.when(rest < validation_fraction, 0).otherwise(1)
    return F.when(at < test_fraction, F.lit(TEST)).otherwise(part).cast("int")


def class_scores(df: DataFrame, label: str, prediction: str, by: list[str]) -> DataFrame:
    """n, accuracy and F1 over all classes, each class weighted by its rows; counted per pair of classes first.

    A class that is neither predicted nor present scores nothing; one without a right prediction has an F1 of 0.
    """
    cells = df.groupBy(*map(col, by), col(label).alias("y"), col(prediction).alias("p")).agg(F.count(F.lit(1)).alias("c"))
    sides = cells.select(*map(col, by), "c", F.col("y").eqNullSafe(F.col("p")).alias("hit"), F.inline(F.array(
        F.struct(F.col("y").alias("class"), F.lit(True).alias("is_label")), F.struct(F.col("p").alias("class"), F.lit(False).alias("is_label")))))
    total = sides.groupBy(*map(col, by), "class").agg(
        F.sum(F.when(F.col("is_label"), F.col("c")).otherwise(0)).alias("support"),
        F.sum(F.when(~F.col("is_label"), F.col("c")).otherwise(0)).alias("predicted"),
        F.sum(F.when(F.col("is_label") & F.col("hit"), F.col("c")).otherwise(0)).alias("hits"),
    )
    f1 = 2 * F.col("hits") / (F.col("support") + F.col("predicted"))
    return total.groupBy(*map(col, by)).agg(
        F.sum("support").alias("n"), (F.sum("hits") / F.sum("support")).alias("accuracy"), (F.sum(F.col("support") * f1) / F.sum("support")).alias("f1"))


def _held_out(rows: DataFrame, models: dict[tuple[str, int], PipelineModel], classes: bool) -> DataFrame:
    """(trainer, part, y, prediction) of every row by the models that have not seen its part, in one scan of the rows.

    The label goes by another name while models look at the rows, so a class that a training part lacks is a wrong
    prediction and not an error.
    """
    seen = rows
    for i, model in enumerate(models.values()):
        seen = predict(model, seen, as_labels=classes).withColumnRenamed("prediction", f"__p{i}")
    trainers = list(dict.fromkeys(t for t, _ in models))
    structs = []
    for t in trainers:
        mine = [F.when(F.col("__part") == k, F.col(f"__p{i}")) for i, (u, k) in enumerate(models) if u == t]
        structs.append(F.struct(F.lit(t).alias("trainer"), F.coalesce(*mine).alias("prediction")))
    return seen.select(F.col("__part").alias("part"), F.col("__y").alias("y"), F.inline(F.array(*structs)))


def _scored(rows: DataFrame, models: dict[tuple[str, int], PipelineModel], classes: bool) -> list[dict]:
    long, by = _held_out(rows, models, classes), ["trainer", "part"]
    found = class_scores(long, "y", "prediction", by) if classes else regression_metrics(long, "y", "prediction", by)
    return [r.asDict() for r in found.collect()]


def search(
    df: DataFrame, model_type: str, features: list[str], label: str, key: str, trainers: str | list[str] | None = None, metric: str = "",
    validation_fraction: float = 0.1, test_fraction: float = 0.0, cross_folds: int = 0, normalisation: str = "Auto", only_complete: bool = True,
) -> Search:
    """The best of some trainers, by a metric on rows that the judged model has not seen.

    Rows are divided by the MD5 of their key, so equal keys stay together and reruns agree. With ``cross_folds`` of two or more each
    trainer is fitted once without each fold and judged on it; the best is then fitted on all rows but the test rows. Otherwise
    each is fitted without the validation rows, and the best stays as fitted. Scores of the parts are averaged by their rows; the
    first of equally good trainers wins. Test rows take no part in the choice; the chosen model is scored on them last. What reaches
    the driver is one row per trainer and part. Rows without a label are in no part.
    """
    kind = canonical("model type", model_type)
    if kind == "Clustering":
        raise ValueError("clusters have no label to judge trainers by")
    names = [trainers] if isinstance(trainers, str) else list(dict.fromkeys(trainers or TRAINERS[kind]))
    unknown = [t for t in names if t not in TRAINERS[kind]]
    if unknown:
        raise ValueError(f"trainers {unknown} are not of {list(TRAINERS[kind])}")
    classes = kind != "Regression"
    goals = CLASS_METRICS if classes else REGRESSION_METRICS
    goal = (metric or next(iter(goals))).lower()
    if goal not in goals:
        raise ValueError(f"metric '{metric}' is not one of {list(goals)}")
    # A key or label among the features is the same column, once.
    columns = list(dict.fromkeys([*features, label]))
    rows = df.select(parts(col(key), test_fraction, validation_fraction, cross_folds).alias("__part"), *map(col, columns))
    rows = complete_cases(rows, columns if only_complete else [label])
    judged = range(cross_folds) if cross_folds > 1 else range(1)
    training = rows.where(F.col("__part") != TEST)

    def fitted(trainer: str, without: int | None) -> PipelineModel:
        mine = training if without is None else training.where(F.col("__part") != without)
        return train(mine.drop("__part"), kind, features, label, normalisation, trainer, only_complete)

    y = col(label).cast("string" if classes else "double").alias("__y")
    blind = rows.select("__part", *map(col, features), y)
    models = {(t, k): fitted(t, k) for t in names for k in judged}
    scores = _scored(blind.where(F.col("__part").isin(list(judged))), models, classes)
    if not scores:
        raise ValueError("no rows to judge trainers by")

    def mean(trainer: str) -> float:
        mine = [s for s in scores if s["trainer"] == trainer and s[goal] is not None]
        if not mine:
            return float("-inf")
        average = sum(s["n"] * s[goal] for s in mine) / sum(s["n"] for s in mine)
        return average if goals[goal] else -average

    best = max(names, key=mean)
    model = fitted(best, None) if cross_folds > 1 else models[best, 0]
    if test_fraction > 0:
        scores += _scored(blind.where(F.col("__part") == TEST), {(best, TEST): model}, classes)
    schema = "trainer string, part string, n bigint, " + ", ".join(f"{m} double" for m in goals)
    named = {TEST: "test"} | ({k: f"fold {k}" for k in judged} if cross_folds > 1 else {0: "validation"})
    table = [(s["trainer"], named[s["part"]], s["n"], *[s[m] for m in goals]) for s in sorted(scores, key=lambda s: (names.index(s["trainer"]), s["part"]))]
    return Search(model, best, literal_table(df.sparkSession, table, schema))


# --- models by name -------------------------------------------------------------------------------------
def _place(root: str, name: str) -> str:
    return f"{root}/{quote(name, safe='')}"


def save_model(spark: SparkSession, model: PipelineModel, root: str, name: str, features: list[str], label: str | None = None, **attributes) -> None:
    """A fitted pipeline with its features, label and any attributes that JSON can hold; one of the same name is replaced."""
    model.write().overwrite().save(f"{_place(root, name)}/model")
    about = json.dumps({"name": name, "features": features, "label": label, **attributes})
    literal_table(spark, [(about,)], "value string").write.mode("overwrite").text(f"{_place(root, name)}/about")


def load_model(spark: SparkSession, root: str, name: str) -> tuple[PipelineModel, dict]:
    """The pipeline of a name and what was saved with it."""
    about = json.loads(spark.read.text(f"{_place(root, name)}/about").first()["value"])
    return PipelineModel.load(f"{_place(root, name)}/model"), about


def model_names(spark: SparkSession, root: str) -> list[str]:
    """Names of the saved models, in order."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return sorted(unquote(f.getPath().getName()) for f in fs.listStatus(path)) if fs.exists(path) else []
