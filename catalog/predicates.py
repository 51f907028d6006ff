"""Filters over entities, signals, samples, items and parameters."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from catalog import query
from catalog.frames import DEPTH_SQL, ENTITIES_SQL, SIGNALS_SQL, TIME_SQL, depth_samples, entities, signals, table, time_samples
from gaugework.operators import filters
from gaugework.operators.joins import lookup

_SAMPLE = ["entity", "signal", "date", "value_num"]


@query("c1_entities_of_types", f"SELECT name, type FROM {ENTITIES_SQL} WHERE lower(type) IN ('customer')")
def entities_of_types(spark, d):
    return filters.entities_of_types(entities(spark, d), ["CUSTOMER"]).select("name", "type")


@query("c2_entities_only", f"SELECT name, is_opportunity FROM {ENTITIES_SQL} WHERE NOT is_opportunity")
def entities_only(spark, d):
    return filters.entities_by_kind(entities(spark, d)).select("name", "is_opportunity")


@query("c2_opportunities_only", f"SELECT name, is_opportunity FROM {ENTITIES_SQL} WHERE is_opportunity")
def opportunities_only(spark, d):
    return filters.entities_by_kind(entities(spark, d), False, True).select("name", "is_opportunity")


@query("c2_all_names", f"SELECT name FROM {ENTITIES_SQL} WHERE lower(type) = 'supplier'")
def all_names(spark, d):
    return filters.entity_names(entities(spark, d), "supplier")


@query("c3_signals_of_type", f"""SELECT s.entity, s.signal, count(*) AS n FROM {TIME_SQL} s JOIN {SIGNALS_SQL} d ON s.signal = d.name
WHERE d.type = 'TimeDependent' GROUP BY ALL""")
def signals_of_type(spark, d):
    names = filters.signals_of_type(signals(spark), "time numeric").select(F.col("name").alias("signal"))
    return lookup(time_samples(spark, d), names, ["signal"], "inner").groupBy("entity", "signal").agg(F.count(F.lit(1)).alias("n"))


@query("c4_entity_by_name_or_alias", f"SELECT name, type, alias FROM {ENTITIES_SQL} WHERE name = 'C7' OR alias = 'C7'")
def entity_by_alias(spark, d):
    return filters.find_entity(entities(spark, d), "C7").select("name", "type", "alias")


@query("c4_signal_by_short_name", f"SELECT entity, signal, date, value_num FROM {TIME_SQL} WHERE signal IN (SELECT name FROM {SIGNALS_SQL} WHERE short_name = 'pur' OR name = 'pur')")
def signal_by_short_name(spark, d):
    names = filters.find_signal(signals(spark), "pur").select(F.col("name").alias("signal"))
    return lookup(time_samples(spark, d), names, ["signal"], "left_semi").select(*_SAMPLE)


@query("c5_time_range", f"SELECT entity, signal, date, value_num FROM {TIME_SQL} WHERE signal = 'view' AND date BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-09 12:00:00'")
def time_range(spark, d):
    rows = time_samples(spark, d).where("signal = 'view'")
    return filters.in_range(rows, "date", datetime(2024, 1, 5), datetime(2024, 1, 9, 12)).select(*_SAMPLE)


@query("c6_depth_range", f"SELECT entity, depth, value_num FROM {DEPTH_SQL} WHERE depth BETWEEN 2.5 AND 7.0")
def depth_range(spark, d):
    return filters.in_range(depth_samples(spark, d), "depth", 2.5, 7.0).select("entity", "depth", "value_num")


@query("c7_single_point", f"SELECT entity, depth, value_num FROM {DEPTH_SQL} WHERE depth = 3.0")
def single_point(spark, d):
    return filters.in_range(depth_samples(spark, d), "depth", 3.0, 3.0).select("entity", "depth", "value_num")


@query("c7_single_time_point", """SELECT l_suppkey, l_shipdate, l_quantity FROM lineitem WHERE l_shipdate = TIMESTAMP '1998-03-04'""")
def single_time_point(spark, d):
    rows = table(spark, d, "lineitem").select("l_suppkey", "l_shipdate", "l_quantity")
    return filters.in_range(rows, "l_shipdate", datetime(1998, 3, 4), datetime(1998, 3, 4))


@query("c8_scenario", """SELECT l_suppkey, l_shipdate, l_quantity FROM lineitem WHERE l_linestatus = 'F'""")
def scenario(spark, d):
    rows = table(spark, d, "lineitem").withColumnRenamed("l_linestatus", "scenario")
    return filters.of_scenario(rows, "F").select("l_suppkey", "l_shipdate", "l_quantity")


@query("c9_existing_entities", """SELECT CAST(o_custkey AS VARCHAR) AS entity, o_orderkey FROM orders
WHERE EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_mktsegment = 'BUILDING')""")
def existing_entities(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("name"), F.col("c_mktsegment").alias("type"))
    rows = table(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("entity"), "o_orderkey")
    return filters.existing_only(rows, c, "building")


@query("c10_known_signals", f"SELECT entity, signal, date, value_num FROM {TIME_SQL} WHERE signal IN (SELECT name FROM {SIGNALS_SQL} WHERE measurement = 'Currency')")
def known_signals(spark, d):
    known = signals(spark).where("measurement = 'Currency'")
    return filters.known_signals_only(time_samples(spark, d), known).select(*_SAMPLE)


def items(spark, d):
    """Parts and suppliers as named items with labels."""
    p = table(spark, d, "part").select(
        F.lit("Tag").alias("type"), F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")).alias("name"), F.split("p_name", " ").alias("labels"))
    s = table(spark, d, "supplier").select(F.lit("Scope").alias("type"), F.col("s_name").alias("name"), F.array(F.lit("supplier")).alias("labels"))
    return p.unionByName(s)


ITEMS_SQL = """(SELECT 'Tag' AS type, p_name || ' ' || CAST(p_partkey AS VARCHAR) AS name, string_split(p_name, ' ') AS labels FROM part
UNION ALL SELECT 'Scope', s_name, ['supplier'] FROM supplier)"""


@query("c11_items_of_type", f"SELECT name FROM {ITEMS_SQL} WHERE type = 'Tag'")
def items_of_type(spark, d):
    return filters.items_of_type(items(spark, d), "Tag").select("name")


@query("c11_item_exists", f"SELECT count(*) > 0 AS found FROM {ITEMS_SQL} WHERE type = 'Scope' AND name = 'Supplier#000000003'")
def item_exists(spark, d):
    rows = filters.items_of_type(items(spark, d), "Scope").where("name = 'Supplier#000000003'")
    return rows.agg((F.count(F.lit(1)) > 0).alias("found"))


@query("c11_item_labels", f"SELECT type, name, unnest(labels) AS label FROM {ITEMS_SQL}")
def item_labels(spark, d):
    return filters.item_labels(items(spark, d))


@query("c11_item_types", f"SELECT DISTINCT type FROM {ITEMS_SQL}")
def item_types(spark, d):
    return items(spark, d).select("type").distinct()


def parameters(spark, d):
    """Part prices, sizes and names as typed parameters."""
    p = table(spark, d, "part")
    name = F.concat(F.lit("p"), F.col("p_partkey").cast("string"))
    kind = F.when(F.col("p_size") < 20, "Numeric").when(F.col("p_size") < 35, "NumericWithUnit").otherwise("String")
    number = F.when(F.col("p_size") < 35, F.col("p_retailprice"))
    return p.select(
        name.alias("name"), kind.alias("value_type"), number.alias("num"),
        F.when((F.col("p_size") >= 20) & (F.col("p_size") < 35), "usd").alias("unit"), F.when(F.col("p_size") >= 35, F.col("p_name")).alias("str"),
        F.lit(None).cast("array<string>").alias("list"), F.lit(None).cast("map<string,string>").alias("dict"),
        F.lit(None).cast("map<string,int>").alias("enum"), F.lit("").alias("description"),
    )


PARAMETERS_SQL = """(SELECT 'p' || CAST(p_partkey AS VARCHAR) AS name, CASE WHEN p_size < 20 THEN 'Numeric' WHEN p_size < 35 THEN 'NumericWithUnit' ELSE 'String' END AS value_type,
CASE WHEN p_size < 35 THEN p_retailprice END AS num, CASE WHEN p_size >= 20 AND p_size < 35 THEN 'usd' END AS unit, CASE WHEN p_size >= 35 THEN p_name END AS str FROM part)"""


@query("c12_parameters_of_type", f"SELECT name, num, unit FROM {PARAMETERS_SQL} WHERE value_type = 'NumericWithUnit'")
def parameters_of_type(spark, d):
    return filters.parameters_of_type(parameters(spark, d), "numericwithunit").select("name", "num", "unit")
