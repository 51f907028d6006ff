"""Points on the Web-Mercator plane."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import query
from catalog.frames import table
from gaugework.functions.geo import project_points, set_crs


def _points(spark, d):
    c = table(spark, d, "customer")
    return c.select(
        "c_custkey", (F.col("c_acctbal") * 1000).alias("x"), (F.col("c_acctbal") * -700).alias("y"),
        F.when(F.col("c_nationkey") > 12, "EPSG:3857").when(F.col("c_nationkey") > 6, "EPSG:4326").alias("crs"),
    )


@query("q1_project_points", """SELECT c_custkey, round(CASE WHEN p THEN degrees(x / 6378137.0::DOUBLE) ELSE x END, 9) AS x,
round(CASE WHEN p THEN degrees(2 * atan(exp(y / 6378137.0::DOUBLE)) - pi() / 2) ELSE y END, 9) AS y, 'EPSG:4326' AS crs
FROM (SELECT c_custkey, c_acctbal * 1000 AS x, c_acctbal * -700 AS y, c_nationkey > 12 OR c_nationkey <= 6 AS p FROM customer)""")
def project(spark, d):
    done = project_points(_points(spark, d))
    return done.select("c_custkey", F.round("x", 9).alias("x"), F.round("y", 9).alias("y"), "crs")


@query("q2_set_crs", "SELECT c_custkey, c_acctbal * 1000 AS x, 'EPSG:3857' AS crs FROM customer")
def set_label(spark, d):
    return set_crs(_points(spark, d), "EPSG:3857").select("c_custkey", "x", "crs")
