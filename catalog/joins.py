"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import query
from catalog.frames import (
    DEPTH_SQL, EDGES_SQL, ENTITIES_SQL, SIGNALS_SQL, TIME_SQL, UNITS_SQL, depth_samples, edges, entities, signals, static_samples, table,
    time_samples, units,
)
from gaugework.functions.buckets import time_bucket
from gaugework.operators import filters
from gaugework.operators.hierarchy import ancestors
from gaugework.operators.joins import lookup
from gaugework.operators.reftable import upsert
from gaugework.operators.reshape import pivot_signals
from gaugework.operators.units import convert_rows
from gaugework.plans.context import Context, Scope
from gaugework.plans.signals import SignalData, load_signals


def brand_time(spark, d):
    """Shipped quantity of a brand over time, as samples of the signal ``view``."""
    l, p = table(spark, d, "lineitem"), table(spark, d, "part")
    return l.join(p, l["l_partkey"] == p["p_partkey"]).select(
        F.col("p_brand").alias("entity"), F.lit("purchase").alias("signal"), F.col("l_shipdate").alias("date"),
        F.col("l_quantity").alias("value_num"), F.lit(None).cast("string").alias("value_str"),
    )


@query("d1_time_with_depth", f"""WITH t AS (SELECT p_brand AS e, date_trunc('year', l_shipdate) AS "Date", round(sum(l_quantity), 4) AS q
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL),
z AS (SELECT entity AS e, CAST(floor(round(depth, 9)) AS DOUBLE) AS "Depth", round(avg(value_num), 4) AS v FROM {DEPTH_SQL} GROUP BY ALL)
SELECT t.e AS "Entity", "Date", "Depth", q AS "purchase [usd]", v AS "price [usd]" FROM t JOIN z ON t.e = z.e""")
def time_with_depth(spark, d):
    data = SignalData(time=brand_time(spark, d), depth=depth_samples(spark, d))
    context = Context(scope=Scope(time_step="Yearly", depth_step="Meter"))
    done = load_signals(data, signals(spark), units(spark), ["purchase", "price"], context)
    return done.withColumns({c: F.round(F.col(f"`{c}`"), 4) for c in ("purchase [usd]", "price [usd]")})


@query("d2_time_with_static", f"""SELECT entity AS "Entity", date_trunc('day', date) AS "Date", round(sum(value_num), 4) AS "purchase [usd]",
any_value(c_acctbal) AS "balance [usd]", any_value(c_mktsegment) AS "segment [ ]"
FROM {TIME_SQL} JOIN customer ON entity = CAST(c_custkey AS VARCHAR) WHERE signal = 'purchase' GROUP BY 1, 2""")
def time_with_static(spark, d):
    data = SignalData(time=time_samples(spark, d), static=static_samples(spark, d))
    context = Context(scope=Scope(time_step="Daily"))
    done = load_signals(data, signals(spark), units(spark), ["purchase", "balance", "segment"], context)
    return done.withColumn("purchase [usd]", F.round(F.col("`purchase [usd]`"), 4))


@query("d3_values_with_definitions", f"""SELECT s.entity, s.signal, s.date, s.value_num, d.type, d.unit FROM {TIME_SQL} s JOIN {SIGNALS_SQL} d ON s.signal = d.name""")
def values_with_definitions(spark, d):
    defs = signals(spark).select(F.col("name").alias("signal"), "type", "unit")
    return lookup(time_samples(spark, d), defs, ["signal"], "inner").select("entity", "signal", "date", "value_num", "type", "unit")


@query("d4_entities_with_signal", f"""SELECT name, type FROM {ENTITIES_SQL} WHERE type = 'Customer' AND name IN
(SELECT 'Customer#' || lpad(entity, 9, '0') FROM {TIME_SQL} WHERE signal = 'signup')""")
def entities_with_signal(spark, d):
    named = time_samples(spark, d).withColumn("entity", F.concat(F.lit("Customer#"), F.lpad("entity", 9, "0")))
    return filters.entities_with_signal(named, entities(spark, d), "signup").select("name", "type")


@query("d4_signals_of_entity", f"SELECT name, unit FROM {SIGNALS_SQL} WHERE name IN (SELECT signal FROM {TIME_SQL} WHERE entity = '8')")
def signals_of_entity(spark, d):
    return filters.signals_of_entity(time_samples(spark, d), signals(spark), "8").select("name", "unit")


@query("d5_values_with_units", f"""SELECT s.entity, s.signal, s.date, round((s.value_num * a.factor + a.summand - b.summand) / b.factor, 7) AS value
FROM {TIME_SQL} s JOIN {SIGNALS_SQL} d ON s.signal = d.name JOIN {UNITS_SQL} a ON a.name = d.unit
JOIN {UNITS_SQL} b ON b.name = CASE d.measurement WHEN 'Currency' THEN 'kusd' WHEN 'Temperature' THEN 'F' WHEN 'Length' THEN 'ft' ELSE d.unit END""")
def values_with_units(spark, d):
    target = F.when(F.col("measurement") == "Currency", "kusd").when(F.col("measurement") == "Temperature", "F").when(
        F.col("measurement") == "Length", "ft").otherwise(F.col("unit"))
    defs = signals(spark).select(F.col("name").alias("signal"), "unit", target.alias("target"))
    done = convert_rows(lookup(time_samples(spark, d), defs, ["signal"], "inner"), units(spark), "value_num", "unit", "target", "value")
    return done.select("entity", "signal", "date", F.round("value", 7).alias("value"))


@query("d6_skip_existing", """SELECT o_custkey, o_orderdate, o_orderkey, 'old' AS origin FROM orders WHERE o_orderstatus <> 'O'
UNION ALL SELECT o_custkey, o_orderdate, o_orderkey, 'new' FROM orders WHERE o_orderstatus = 'O'""")
def skip_existing(spark, d):
    keys = ["o_custkey", "o_orderdate", "o_orderkey"]
    o = table(spark, d, "orders")
    old = o.where("o_orderstatus <> 'O'").select(*keys, F.lit("old").alias("origin"))
    return upsert(old, o.select(*keys, F.lit("new").alias("origin")), keys, skip_existing=True)


@query("d7_ancestors", f"""WITH RECURSIVE e AS {EDGES_SQL},
up AS (SELECT child AS d, parent AS a, 1 AS level FROM e UNION ALL SELECT up.d, e.parent, up.level + 1 FROM up JOIN e ON up.a = e.child)
SELECT d AS descendant, a AS ancestor, level FROM up""")
def all_ancestors(spark, d):
    return ancestors(edges(spark, d)).select("descendant", "ancestor", "level")


_HALVED = "(SELECT CAST(c_custkey AS VARCHAR) AS child, CAST(c_custkey // 2 AS VARCHAR) AS parent FROM customer WHERE c_custkey > 1)"


def halved(spark, d):
    """A hierarchy as deep as the customers are many: each under the one of half its number."""
    key = F.col("c_custkey")
    return table(spark, d, "customer").where("c_custkey > 1").select(key.cast("string").alias("child"), F.expr("cast(c_custkey div 2 as string)").alias("parent"))


@query("d7_ancestors_deep", f"""WITH RECURSIVE e AS {_HALVED},
up AS (SELECT child AS d, parent AS a, 1 AS level FROM e UNION ALL SELECT up.d, e.parent, up.level + 1 FROM up JOIN e ON up.a = e.child)
SELECT d AS descendant, a AS ancestor, level FROM up""")
def deep_ancestors(spark, d):
    return ancestors(halved(spark, d)).select("descendant", "ancestor", "level")


@query("d8_merged_columns", f"""SELECT entity, date_trunc('hour', date) AS hour, max(value_num) FILTER (signal = 'view') AS view,
max(value_num) FILTER (signal = 'click') AS click, max(value_num) FILTER (signal = 'purchase') AS purchase
FROM {TIME_SQL} WHERE signal IN ('view', 'click', 'purchase') GROUP BY ALL""")
def merged_columns(spark, d):
    hourly = time_samples(spark, d).withColumn("hour", time_bucket(F.col("date"), "Hourly"))
    return pivot_signals(hourly, ["entity", "hour"], {s: ("value_num", s) for s in ("view", "click", "purchase")}, strict=False)
