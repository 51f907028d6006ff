"""First and last values, interpolation, grids, newest-wins."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import query
from catalog.frames import DEPTH_SQL, TIME_SQL, depth_samples, table, time_samples
from gaugework.operators.aggregate import aggregate
from gaugework.operators.window import fill_grid, first_values, interpolate_at, newest
from gaugework.plans.signals import load_data, resample

_COLUMNS = ["entity", "signal", "date", "value_num"]


def _ranked(direction: str, n: int) -> str:
    return f"""SELECT entity, signal, date, value_num FROM (SELECT *, row_number() OVER (
PARTITION BY entity, signal ORDER BY date {direction}, value_num {direction}) AS rn FROM {TIME_SQL}) WHERE rn <= {n}"""


@query("f1_first_values", _ranked("ASC", 3))
def first_n(spark, d):
    return load_data(time_samples(spark, d), "time", num_values=3).select(*_COLUMNS)


@query("f2_last_values", _ranked("DESC", 3))
def last_n(spark, d):
    return load_data(time_samples(spark, d), "time", num_values=-3).select(*_COLUMNS)


@query("f1_first_values_many", """SELECT l_returnflag, l_shipdate, l_orderkey, l_linenumber, l_extendedprice FROM (
SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_shipdate, l_orderkey, l_linenumber, l_extendedprice) AS rn
FROM lineitem) WHERE rn <= 1500""")
def first_many(spark, d):
    ties = ("l_orderkey", "l_linenumber", "l_extendedprice")
    rows = table(spark, d, "lineitem").select("l_returnflag", "l_shipdate", *ties)
    return first_values(rows, ["l_returnflag"], "l_shipdate", 1500, ties)


@query("f3_interpolated_depth", f"""WITH s AS (SELECT entity, signal, depth, avg(value_num) AS v FROM {DEPTH_SQL} GROUP BY ALL),
b AS (SELECT entity, signal, max({{'a': depth, 'v': v}}) FILTER (depth <= 6.1) AS lo, min({{'a': depth, 'v': v}}) FILTER (depth >= 6.1) AS hi
FROM s GROUP BY ALL)
SELECT entity, signal, round(CASE WHEN lo.a = 6.1 THEN lo.v WHEN hi.a = 6.1 THEN hi.v
ELSE lo.v + (hi.v - lo.v) / (hi.a - lo.a) * (6.1 - lo.a) END, 4) AS value FROM b""")
def interpolated(spark, d):
    keys = ["entity", "signal"]
    one = aggregate(depth_samples(spark, d), [*keys, "depth"], "value_num", "Average", out="v")
    done = interpolate_at(one, keys, "depth", "v", 6.1)
    return done.withColumn("value", F.round("value", 4))


_GRID = """WITH daily AS (SELECT entity, signal, {bucket} AS b, sum(value_num) AS v FROM {src} GROUP BY ALL),
g AS (SELECT entity, signal, unnest(generate_series({start}, {end}, INTERVAL {step})) AS b
FROM (SELECT entity, signal, min(b) AS lo, max(b) AS hi FROM daily GROUP BY ALL))
SELECT g.entity, g.signal, CAST(g.b AS TIMESTAMP) AS bucket, round(coalesce(v, -1), 4) AS value FROM g LEFT JOIN daily
ON g.entity = daily.entity AND g.signal = daily.signal AND g.b = daily.b"""


@query("f4_grid_daily_with_gaps", _GRID.format(
    bucket="date_trunc('day', date)", src=TIME_SQL, start="TIMESTAMP '2024-01-01'", end="TIMESTAMP '2024-01-31'", step="1 DAY"))
def grid_daily(spark, d):
    daily = resample(time_samples(spark, d), "time", "Daily", "Sum")
    ends = [F.lit(t).cast("timestamp_ntz") for t in ("2024-01-01", "2024-01-31")]
    done = fill_grid(daily, ["entity", "signal"], "bucket", "value", "Daily", -1.0, *ends)
    return done.withColumn("value", F.round("value", 4))


@query("f4_grid_hourly_own_range", _GRID.format(
    bucket="date_trunc('hour', date)", src=TIME_SQL, start="lo", end="hi", step="1 HOUR"))
def grid_hourly(spark, d):
    hourly = resample(time_samples(spark, d), "time", "Hourly", "Sum")
    done = fill_grid(hourly, ["entity", "signal"], "bucket", "value", "Hourly", -1.0)
    return done.withColumn("value", F.round("value", 4))


@query("f5_newest_wins", """SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM (
SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""")
def newest_wins(spark, d):
    rows = table(spark, d, "orders").select(
        "o_custkey", "o_orderdate", "o_orderkey", "o_totalprice", F.struct("o_orderdate", "o_orderkey").alias("batch")
    )
    return newest(rows, ["o_custkey"], "batch").drop("batch")
