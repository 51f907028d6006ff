"""Trainers chosen by held-out rows, and models kept by name."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugework.plans import models, selection
from gaugework.session import new_folder


def place(key):
    return int(hashlib.md5(str(key).encode()).hexdigest()[:8], 16) / 2**32


@pytest.fixture(scope="module")
def points(spark):
    r = random.Random(8)
    rows = [(i, x := float(r.randint(0, 40)), 3 * x + r.random() * 5, "high" if x > 20 else "low") for i in range(400)]
    rows += [(400, None, 1.0, "low"), (401, 2.0, None, None)]
    return rows, spark.createDataFrame(rows, "id long, x double, y double, side string")


def test_folds_against_numpy(points):
    rows, df = points
    found = selection.search(df, "regression", ["x"], "y", "id", "linear", cross_folds=4)
    known = [(min(int(place(i) * 4), 3), x, y) for i, x, y, _ in rows if x is not None and y is not None]
    for s in found.scores.collect():
        k = int(s["part"].split()[1])
        slope, start = np.polyfit(*zip(*[(x, y) for f, x, y in known if f != k]), 1)
        errors = [y - start - slope * x for f, x, y in known if f == k]
        assert s["n"] == len(errors) and s["rmse"] == pytest.approx(np.sqrt(np.mean(np.square(errors))), rel=1e-6)
    assert found.scores.count() == 4 and found.trainer == "linear"


def test_parts_follow_the_key(points):
    rows, df = points
    got = {r["id"]: r["p"] for r in df.select("id", selection.parts(F.col("id"), 0.2, 0.25).alias("p")).collect()}
    for i, *_ in rows:
        at = place(i)
        assert got[i] == (-1 if at < 0.2 else 0 if (at - 0.2) / 0.8 < 0.25 else 1)


def test_the_better_trainer_wins_and_test_rows_come_last(points):
    _, df = points
    found = selection.search(df, "regression", ["x"], "y", "id", ["forest", "linear"], "r2", validation_fraction=0.3, test_fraction=0.2)
    scores = {(s["trainer"], s["part"]): s["r2"] for s in found.scores.collect()}
    better = max(("forest", "linear"), key=lambda t: scores[t, "validation"])
    assert found.trainer == better and set(scores) == {("forest", "validation"), ("linear", "validation"), (better, "test")}


def test_class_scores_against_counting(spark):
    r = random.Random(5)
    pairs = [(r.choice("abc"), r.choice(["a", "b", "d", None])) for _ in range(200)]
    got = selection.class_scores(spark.createDataFrame([("t", *p) for p in pairs], "t string, y string, p string"), "y", "p", ["t"]).first()
    f1 = 0.0
    for c in "abc":
        hits, support, predicted = (sum(t) for t in zip(*[(y == p == c, y == c, p == c) for y, p in pairs]))
        f1 += support * 2 * hits / (support + predicted)
    assert got["n"] == 200 and got["accuracy"] == pytest.approx(sum(y == p for y, p in pairs) / 200) and got["f1"] == pytest.approx(f1 / 200)


def test_a_class_that_a_training_part_lacks(spark):
    rows = [(i, float(i % 2), "ab"[i % 2]) for i in range(60)]
    alone = next(i for i in range(60, 200) if int(place(i) * 2) == 1)
    df = spark.createDataFrame([*rows, (alone, 9.0, "rare")], "id long, x double, y string")
    found = selection.search(df, "multi", ["x"], "y", "id", "forest", cross_folds=2)
    scores = {s["part"]: s for s in found.scores.collect()}
    assert scores["fold 0"]["accuracy"] == 1.0 and 0.9 < scores["fold 1"]["accuracy"] < 1.0


def test_models_by_name(spark, points):
    _, df = points
    root, known = new_folder(spark, "models"), df.na.drop()
    assert selection.model_names(spark, root) == []
    for name, label in (("side of x/y", "side"), ("line", "y")):
        kind = "binclass" if label == "side" else "regression"
        model = models.train(known, kind, ["x"], label)
        selection.save_model(spark, model, root, name, ["x"], label, unit="usd")
        loaded, about = selection.load_model(spark, root, name)
        assert about == {"name": name, "features": ["x"], "label": label, "unit": "usd"}
        assert sorted(models.predict(loaded, known, True).collect()) == sorted(models.predict(model, known, True).collect())
    assert selection.model_names(spark, root) == ["line", "side of x/y"]


@pytest.mark.parametrize("given", [
    {"model_type": "cluster"}, {"trainers": ["linear", "magic"]}, {"metric": "accuracy"}, {"validation_fraction": 0.0},
])
def test_refused(points, given):
    options = {"model_type": "regression", "trainers": "linear"} | given
    with pytest.raises(ValueError):
        selection.search(points[1], features=["x"], label="y", key="id", **options)
