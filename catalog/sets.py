"""Unions of series, columns, entity sets and hierarchies."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import query
from catalog.frames import EDGES_SQL, ENTITIES_SQL, edges, entities, table
from gaugework.operators.combine import check_reserved, merge_entity_sets, union_series
from gaugework.operators.filters import entities_of_types
from gaugework.operators.hierarchy import merge_hierarchies
from gaugework.operators.reshape import stack_columns


@query("h1_union_series", """SELECT c_custkey, 'balance' AS signal, c_acctbal AS value_num, CAST(NULL AS VARCHAR) AS value_str FROM customer
UNION ALL SELECT c_custkey, 'segment', NULL, c_mktsegment FROM customer""")
def series(spark, d):
    c = table(spark, d, "customer")
    return union_series(
        c.select("c_custkey", F.lit("balance").alias("signal"), F.col("c_acctbal").alias("value")),
        c.select("c_custkey", F.lit("segment").alias("signal"), F.col("c_mktsegment").alias("value")),
    )


@query("h2_stack_columns", """SELECT user_id AS "Entity", ts AS "Date", value AS view, CAST(NULL AS DOUBLE) AS click FROM events WHERE event_type = 'view'
UNION ALL SELECT user_id, ts, NULL, value FROM events WHERE event_type = 'click'""")
def stacked(spark, d):
    e = table(spark, d, "events").select(F.col("user_id").alias("Entity"), F.col("ts").alias("Date"), "value", "event_type")
    parts = [e.where(F.col("event_type") == n).select("Entity", "Date", F.col("value").alias(n)) for n in ("view", "click")]
    return stack_columns(parts)


@query("h3_entities_of_several_types", f"SELECT name FROM {ENTITIES_SQL} WHERE type = 'Customer' UNION ALL SELECT name FROM {ENTITIES_SQL} WHERE type IN ('Supplier', 'Customer')")
def several_types(spark, d):
    e = entities(spark, d)
    return merge_entity_sets([entities_of_types(e, "customer").select("name"), entities_of_types(e, ["supplier", "customer"]).select("name")])


@query("h4_merge_entity_sets", """SELECT c_name AS name FROM customer WHERE c_acctbal > 5000 UNION ALL SELECT c_name FROM customer WHERE c_mktsegment = 'BUILDING'""")
def entity_sets(spark, d):
    c = table(spark, d, "customer").withColumnRenamed("c_name", "name")
    return merge_entity_sets([c.where("c_acctbal > 5000").select("name"), c.where("c_mktsegment = 'BUILDING'").select("name")])


@query("h4_merge_entity_sets_distinct", """SELECT c_name AS name FROM customer WHERE c_acctbal > 5000 UNION SELECT c_name FROM customer WHERE c_mktsegment = 'BUILDING'""")
def entity_sets_distinct(spark, d):
    c = table(spark, d, "customer").withColumnRenamed("c_name", "name")
    return merge_entity_sets([c.where("c_acctbal > 5000").select("name"), c.where("c_mktsegment = 'BUILDING'").select("name")], distinct=True)


@query("h5_merge_hierarchies", f"""SELECT child, CASE WHEN child IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal < 0) THEN 'DEBTORS' ELSE parent END AS parent FROM {EDGES_SQL}""")
def hierarchies(spark, d):
    later = table(spark, d, "customer").where("c_acctbal < 0").select(F.col("c_custkey").cast("string").alias("child"), F.lit("DEBTORS").alias("parent"))
    return merge_hierarchies([edges(spark, d), later])


@query("h6_reserved_names", "SELECT o_orderkey, o_totalprice FROM orders")
def reserved_names(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    check_reserved(["Entity", "Time", *rows.columns], ["Entity", "Time"])
    try:
        check_reserved(["Entity", "Time", "ID [m]"], ["Entity", "Time"])
    except ValueError:
        return rows
    raise AssertionError("a reserved name was accepted")
