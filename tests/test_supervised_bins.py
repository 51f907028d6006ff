"""Supervised cut points from counts by fine bin."""

import random

import numpy as np
from pyspark.sql import functions as F

from gaugework.plans import models


def brute_cuts(values, labels, depth):
    """The best variance cuts over all values."""
    order = np.argsort(values, kind="stable")
    v, y = np.asarray(values)[order], np.asarray(labels)[order]
    cost = lambda x: ((x - x.mean()) ** 2).sum() if len(x) else 0.0
    places = [i for i in range(1, len(v)) if v[i] != v[i - 1]]
    if depth == 0 or not places:
        return []
    at = max(places, key=lambda i: cost(y) - cost(y[:i]) - cost(y[i:]))
    if cost(y) - cost(y[:at]) - cost(y[at:]) <= 1e-9 * max(1.0, cost(y)):
        return []
    return [*brute_cuts(v[:at], y[:at], depth - 1), float(v[at - 1] + (v[at] - v[at - 1]) / 2), *brute_cuts(v[at:], y[at:], depth - 1)]


def test_cuts_against_all_places(spark):
    r = random.Random(4)
    rows = [(float(r.randint(0, 60)), r.random(), 1.0) for _ in range(300)]
    rows = [(a, b, (3 if a > 20 else 0) + (1 if b > 0.5 else 0) + r.random() / 50, c) for a, b, c in rows]
    df = spark.createDataFrame(rows, "a double, b double, y double, same double")
    cuts = models.supervised_cuts(df, ["a", "same"], "y", False)
    assert np.allclose(cuts[0][1:-1], brute_cuts([x[0] for x in rows], [x[2] for x in rows], models.TREE_DEPTH))
    assert cuts[1] == [float("-inf"), float("inf")]


def test_many_values_are_cut_near_the_step(spark):
    df = spark.range(20_000).select((F.col("id") / 7).alias("a.b"), (F.col("id") > 12_345).cast("string").alias("y0"))
    df = df.withColumn("y", (F.col("y0") == "true").cast("double"))
    (cuts,) = models.supervised_cuts(df, ["a.b"], "y", True)
    assert len(cuts) >= 3 and min(abs(c - 12_345 / 7) for c in cuts[1:-1]) < 20_000 / 7 / models.FINE_BINS


def test_missing_values_and_empty_tables(spark):
    df = spark.createDataFrame([(None, 1.0), (1.0, 1.0), (2.0, 5.0), (2.0, 5.0)], "a double, y double")
    assert models.supervised_cuts(df, ["a"], "y", False) == [[float("-inf"), 1.5, float("inf")]]
    assert models.supervised_cuts(df.where("false"), ["a"], "y", False) == [[float("-inf"), float("inf")]]
