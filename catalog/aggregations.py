"""Aggregation names, resampling, rollup, ranges."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import query
from catalog.frames import (
    DEPTH_SQL, EDGES_SQL, TEXT_SQL, TIME_SQL, depth_samples, edges, signals, SIGNALS_SQL, static_samples, table,
    text_samples, time_samples,
)
from gaugework.functions.buckets import depth_of_bucket
from gaugework.operators.aggregate import (
    aggregate, data_range, distinct_names, exact_percentile, first_in_order, merge_ranges,
)
from gaugework.operators.hierarchy import rollup
from gaugework.operators.joins import lookup
from gaugework.plans.signals import resample

_NUMERIC = {
    "e1_sum": ("Sum", "sum(value_num)"),
    "e2_average": ("mean", "avg(value_num)"),
    "e3_max": ("Maximum", "max(value_num)"),
    "e4_min": ("smallest", "min(value_num)"),
    "e5_first": ("First", "min_by(value_num, {'d': date, 'v': value_num})"),
    "e6_last": ("Last", "max_by(value_num, {'d': date, 'v': value_num})"),
    "e7_count": ("Count", "count(value_num)"),
    "e9_median": ("Median", "quantile_cont(value_num, 0.5)"),
    "e11_standard_deviation": ("std", "stddev_samp(value_num)"),
    "e12_variance": ("var", "var_samp(value_num)"),
    "e13_percentile": ("Percentile", "quantile_cont(value_num, 1.0)"),
    "e14_range": ("Range", "max(value_num) - min(value_num)"),
}
# Half of a squared cent has five decimals, which must not be a rounding tie.
_DIGITS = {"var": 6}


def _numeric(how):
    def run(spark, d):
        daily = resample(time_samples(spark, d), "time", "Daily", how)
        value = F.col("value") if how == "Count" else F.round("value", _DIGITS.get(how, 4))
        return daily.select("entity", "signal", "bucket", value.alias("value"))

    return run


for _name, (_how, _sql) in _NUMERIC.items():
    _value = _sql if _how == "Count" else f"round({_sql}, {_DIGITS.get(_how, 4)})"
    query(_name, f"""SELECT entity, signal, date_trunc('day', date) AS bucket, {_value} AS value
FROM {TIME_SQL} GROUP BY ALL""")(_numeric(_how))


@query("e8_no_aggregation", f"SELECT entity, signal, date_trunc('day', date) AS bucket, value_num AS value FROM {TIME_SQL}")
def no_aggregation(spark, d):
    return resample(time_samples(spark, d), "time", "Daily", "NoAggregation")


@query("e10_mode", f"""SELECT entity, signal, bucket, v AS value FROM (
SELECT *, row_number() OVER (PARTITION BY entity, signal, bucket ORDER BY n DESC, v) AS rn FROM (
SELECT entity, signal, date_trunc('month', date) AS bucket, floor(value_num) AS v, count(*) AS n FROM {TIME_SQL} GROUP BY ALL)) WHERE rn = 1""")
def mode(spark, d):
    whole = time_samples(spark, d).withColumn("value_num", F.floor("value_num").cast("double"))
    return resample(whole, "time", "Monthly", "Mode")


@query("e13_percentile_90", """SELECT l_suppkey, round(quantile_cont(l_extendedprice, 0.9), 4) AS p90 FROM lineitem GROUP BY 1""")
def percentile_90(spark, d):
    found = aggregate(table(spark, d, "lineitem"), ["l_suppkey"], "l_extendedprice", "Percentile", out="p90", percentile=0.9)
    return found.withColumn("p90", F.round("p90", 4))


@query("e9_median_hot_groups", """SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.5), 4) AS median FROM lineitem GROUP BY 1""")
def median_hot_groups(spark, d):
    found = exact_percentile(table(spark, d, "lineitem"), ["l_returnflag"], "l_extendedprice", 0.5, "median")
    return found.withColumn("median", F.round("median", 4))


_TEXT = {
    "e1_sum_text": ("concat", "string_agg(value_str, '' ORDER BY date, value_str)"),
    "e3_max_text": ("longest", "max_by(value_str, {'l': length(value_str), 'v': value_str})"),
    "e4_min_text": ("shortest", "min_by(value_str, {'l': length(value_str), 'v': value_str})"),
    "e5_first_text": ("First", "min_by(value_str, {'d': date, 'v': value_str})"),
    "e6_last_text": ("Last", "max_by(value_str, {'d': date, 'v': value_str})"),
    "e7_count_text": ("Count", "count(value_str)"),
}


def _text(how):
    return lambda spark, d: resample(text_samples(spark, d), "time", "Daily", how, "value_str")


for _name, (_how, _sql) in _TEXT.items():
    query(_name, f"""SELECT entity, signal, date_trunc('day', date) AS bucket, {_sql} AS value
FROM {TEXT_SQL} GROUP BY ALL""")(_text(_how))


@query("e10_mode_text", f"""SELECT entity, signal, bucket, v AS value FROM (
SELECT *, row_number() OVER (PARTITION BY entity, signal, bucket ORDER BY n DESC, v) AS rn FROM (
SELECT entity, signal, date_trunc('month', date) AS bucket, value_str AS v, count(*) AS n FROM {TEXT_SQL} GROUP BY ALL)) WHERE rn = 1""")
def mode_text(spark, d):
    return resample(text_samples(spark, d), "time", "Monthly", "Mode", "value_str")


_STEPS = {
    "second": ("1s", "date_trunc('second', date)"),
    "minute": ("min", "date_trunc('minute', date)"),
    "five_minutes": ("5 min", "time_bucket(INTERVAL '5 minutes', date)"),
    "fifteen_minutes": ("15min", "time_bucket(INTERVAL '15 minutes', date)"),
    "hourly": ("Hour", "date_trunc('hour', date)"),
    "daily": ("Daily", "date_trunc('day', date)"),
    "monthly": ("month", "date_trunc('month', date)"),
    "quarterly": ("3m", "date_trunc('quarter', date)"),
    "yearly": ("Yearly", "date_trunc('year', date)"),
}


def _by_step(step):
    def run(spark, d):
        done = resample(time_samples(spark, d), "time", step, "Sum")
        return done.withColumn("value", F.round("value", 4))

    return run


for _name, (_step, _sql) in _STEPS.items():
    query(f"e15_resample_{_name}", f"""SELECT entity, signal, CAST({_sql} AS TIMESTAMP) AS bucket, round(sum(value_num), 4) AS value
FROM {TIME_SQL} GROUP BY ALL""")(_by_step(_step))

_DEPTHS = {
    "tenth_meter": ("0.1 m", 0.1), "eighth_meter": ("EighthMeter", 0.125), "half_foot": ("half ft", 0.1524),
    "foot": ("ft", 0.3048), "half_meter": ("0.5m", 0.5), "meter": ("Meter", 1.0),
}


def _by_depth(step):
    def run(spark, d):
        done = resample(depth_samples(spark, d), "depth", step, "Average")
        return done.select(
            "entity", "signal", "bucket", depth_of_bucket(F.col("bucket"), step).alias("depth"), F.round("value", 4).alias("value")
        )

    return run


for _name, (_step, _width) in _DEPTHS.items():
    query(f"e16_resample_{_name}", f"""SELECT entity, signal, bucket, round(bucket * CAST({_width} AS DOUBLE), 9) AS depth, value FROM (
SELECT entity, signal, CAST(floor(round(depth / CAST({_width} AS DOUBLE), 9)) AS BIGINT) AS bucket, round(avg(value_num), 4) AS value
FROM {DEPTH_SQL} GROUP BY ALL)""")(_by_depth(_step))


@query("e17_hierarchy_rollup", f"""WITH RECURSIVE e AS {EDGES_SQL},
up AS (SELECT child AS d, parent AS a FROM e UNION ALL SELECT up.d, e.parent FROM up JOIN e ON up.a = e.child),
daily AS (SELECT entity, signal, date_trunc('day', date) AS bucket, sum(value_num) AS value FROM {TIME_SQL} GROUP BY ALL)
SELECT entity, signal, bucket, round(value, 4) AS value FROM daily
UNION ALL SELECT a, signal, bucket, round(sum(value), 4) FROM daily JOIN up ON entity = d GROUP BY ALL""")
def hierarchy_rollup(spark, d):
    daily = resample(time_samples(spark, d), "time", "Daily", "Sum")
    done = rollup(daily, edges(spark, d), "entity", ["signal", "bucket"], {"value": F.sum})
    return done.withColumn("value", F.round("value", 4))


@query("e17_rollup_static", f"""WITH RECURSIVE e AS {EDGES_SQL},
up AS (SELECT child AS d, parent AS a FROM e UNION ALL SELECT up.d, e.parent FROM up JOIN e ON up.a = e.child)
SELECT a AS entity, round(avg(c_acctbal), 4) AS value FROM customer JOIN up ON CAST(c_custkey AS VARCHAR) = d GROUP BY ALL
UNION ALL SELECT CAST(c_custkey AS VARCHAR), round(c_acctbal, 4) FROM customer""")
def rollup_static(spark, d):
    balance = static_samples(spark, d).where("signal = 'balance'").select("entity", F.col("value_num").alias("value"))
    done = rollup(balance, edges(spark, d), "entity", [], {"value": F.avg})
    return done.withColumn("value", F.round("value", 4))


@query("e17_rollup_deep", """WITH RECURSIVE e AS (SELECT c_custkey AS child, c_custkey // 2 AS parent FROM customer WHERE c_custkey > 1),
up AS (SELECT c_custkey AS d, c_custkey AS a FROM customer UNION ALL SELECT up.d, e.parent FROM up JOIN e ON up.a = e.child)
SELECT CAST(a AS VARCHAR) AS entity, round(sum(c_acctbal), 2) AS value FROM up JOIN customer ON c_custkey = d GROUP BY a""")
def rollup_deep(spark, d):
    from catalog.joins import halved

    balance = static_samples(spark, d).where("signal = 'balance'").select("entity", F.col("value_num").alias("value"))
    done = rollup(balance, halved(spark, d), "entity", [], {"value": F.sum})
    return done.withColumn("value", F.round("value", 2))


@query("e18_range_per_signal", f"SELECT signal, min(date) AS range_start, max(date) AS range_end FROM {TIME_SQL} GROUP BY 1")
def range_per_signal(spark, d):
    return data_range(time_samples(spark, d), "date", ["signal"])


@query("e18_range_per_entity", f"SELECT entity, signal, min(date) AS range_start, max(date) AS range_end FROM {TIME_SQL} GROUP BY ALL")
def range_per_entity(spark, d):
    return data_range(time_samples(spark, d), "date", ["entity", "signal"])


@query("e18_range_entity_list", f"""SELECT signal, min(date) AS range_start, max(date) AS range_end FROM {TIME_SQL}
WHERE entity IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'MACHINERY') GROUP BY 1""")
def range_entity_list(spark, d):
    chosen = table(spark, d, "customer").where("c_mktsegment = 'MACHINERY'").select(F.col("c_custkey").cast("string").alias("entity"))
    return data_range(lookup(time_samples(spark, d), chosen, ["entity"], "left_semi"), "date", ["signal"])


@query("e18_range_of_type", f"""SELECT type, min(date) AS range_start, max(date) AS range_end
FROM {TIME_SQL} s JOIN {SIGNALS_SQL} d ON s.signal = d.name GROUP BY 1""")
def range_of_type(spark, d):
    types = signals(spark).select(F.col("name").alias("signal"), "type")
    return data_range(lookup(time_samples(spark, d), types, ["signal"], "inner"), "date", ["type"])


@query("e18_range_depth", f"SELECT entity, min(depth) AS range_start, max(depth) AS range_end FROM {DEPTH_SQL} GROUP BY 1")
def range_depth(spark, d):
    return data_range(depth_samples(spark, d), "depth", ["entity"])


@query("e18_range_static", """SELECT 'balance' AS signal, CAST(NULL AS TIMESTAMP) AS range_start, CAST(NULL AS TIMESTAMP) AS range_end
FROM customer WHERE c_custkey IS NOT NULL GROUP BY 1""")
def range_static(spark, d):
    rows = static_samples(spark, d).where("signal = 'balance'").withColumn("date", F.lit(None).cast("timestamp_ntz"))
    return data_range(rows, "date", ["signal"])


@query("e19_merged_range", f"SELECT min(date) AS range_start, max(date) AS range_end FROM {TIME_SQL}")
def merged_range(spark, d):
    return merge_ranges(data_range(time_samples(spark, d), "date", ["entity", "signal"]))


@query("e20_static_first_row", """SELECT o_custkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS value FROM (
SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def static_first_row(spark, d):
    rows = table(spark, d, "orders").withColumn("v", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_totalprice")))
    return first_in_order(rows, ["o_custkey"], "v", "o_orderkey")


@query("e21_distinct_entities", f"SELECT DISTINCT entity FROM {TIME_SQL}")
def distinct_entities(spark, d):
    return distinct_names(time_samples(spark, d), "entity")


@query("e21_unique_names", """SELECT DISTINCT p_type AS name FROM part WHERE p_type <> ''""")
def unique_names(spark, d):
    return distinct_names(table(spark, d, "part").select(F.col("p_type").alias("name")), "name")
