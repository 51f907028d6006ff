"""Scopes, entity sets, hierarchies and contexts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from catalog import query
from catalog.frames import (
    DEPTH_SQL, ENTITIES_SQL, TIME_SQL, depth_samples, edges, entities, table, time_samples,
)
from gaugework.functions.vocabulary import DEPTH_INCREMENTS, TIME_INCREMENTS
from gaugework.operators import filters
from gaugework.operators.hierarchy import edges_from_map
from gaugework.operators.joins import lookup
from gaugework.plans.context import (
    Context, ContextList, Scope, default_bounds, merge_contexts, merge_scope_rows, resolve_context, resolve_entities, resolve_scope,
)

_SAMPLE = ["entity", "signal", "date", "value_num"]


@query("k1_resolved_scope", f"SELECT entity, signal, date, value_num FROM {TIME_SQL} WHERE date BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-15'")
def resolved_scope(spark, d):
    stored = {"name": "s", "time_start": "2024-01-01T00:00:00", "time_end": "2024-01-15T00:00:00Z", "time_step": "d"}
    scope = resolve_scope(stored, time_start="2024-01-10")
    return filters.in_range(time_samples(spark, d), "date", scope.time_start, scope.time_end).select(*_SAMPLE)


@query("k2_default_bounds_time", f"""SELECT min(date) AS range_start, TIMESTAMP '2024-01-20' AS range_end, 'EverySecond' AS step
FROM {TIME_SQL} WHERE signal IN ('view', 'click') AND entity IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'BUILDING')""")
def bounds_time(spark, d):
    chosen = table(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").cast("string").alias("entity"))
    rows = lookup(time_samples(spark, d).where("signal IN ('view', 'click')"), chosen, ["entity"], "left_semi")
    return default_bounds(rows, Scope(time_end=datetime(2024, 1, 20)), "date")


@query("k2_default_bounds_depth", f"SELECT CAST(0 AS DOUBLE) AS range_start, max(depth) AS range_end, 'Meter' AS step FROM {DEPTH_SQL}")
def bounds_depth(spark, d):
    return default_bounds(depth_samples(spark, d), Scope(depth_start=0.0), "depth")


@query("k3_entities_of_set_and_types", f"""SELECT name FROM {ENTITIES_SQL} WHERE type = 'Supplier' AND name IN (
SELECT s_name FROM supplier WHERE s_acctbal > 0 UNION SELECT c_name FROM customer)""")
def set_and_types(spark, d):
    chosen = table(spark, d, "supplier").where("s_acctbal > 0").select(F.col("s_name").alias("name")).unionByName(
        table(spark, d, "customer").select(F.col("c_name").alias("name")))
    return resolve_entities(entities(spark, d), chosen, ["supplier"])


@query("k3_entities_of_types", f"SELECT name FROM {ENTITIES_SQL} WHERE type = 'Customer'")
def only_types(spark, d):
    return resolve_entities(entities(spark, d), None, "CUSTOMER")


@query("k4_hierarchy_from_map", """SELECT c_name AS child, n_name AS parent FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION ALL SELECT c_name || '/1', c_name FROM customer""")
def from_map(spark, d):
    c, n = table(spark, d, "customer"), table(spark, d, "nation")
    maps = c.join(n, c["c_nationkey"] == n["n_nationkey"]).select(
        F.create_map("c_name", "n_name", F.concat("c_name", F.lit("/1")), "c_name").alias("relation"))
    return edges_from_map(maps, "relation")


def _context(spark, d) -> Context:
    c = table(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").cast("string").alias("name"))
    return resolve_context(None, {"time_start": "2024-01-03", "time_step": "day"}, c, edges(spark, d).where("parent = 'no such node'"), time_end="2024-01-09")


@query("k5_resolved_context", f"""SELECT entity, signal, date, value_num FROM {TIME_SQL} WHERE date BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-01-09'
AND entity IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'BUILDING')""")
def resolved_context(spark, d):
    c = _context(spark, d)
    assert c.hierarchy is None and c.scope.time_step == "Daily"
    rows = filters.in_range(time_samples(spark, d), "date", c.scope.time_start, c.scope.time_end)
    return lookup(rows, c.entities, [("entity", "name")], "left_semi").select(*_SAMPLE)


def _scopes(spark, d):
    """One scope per user and event type."""
    steps = F.array(*[F.lit(s) for s in TIME_INCREMENTS])
    depths = F.array(*[F.lit(s) for s in DEPTH_INCREMENTS])
    pick = F.length("event_type").cast("int")
    return table(spark, d, "events").groupBy("user_id", "event_type").agg(
        F.min("ts").alias("time_start"), F.max("ts").alias("time_end"), F.min("value").alias("depth_start"), F.max("value").alias("depth_end")
    ).select("user_id", "time_start", "time_end", "depth_start", "depth_end",
             F.element_at(steps, pick).alias("time_step"), F.element_at(depths, pick - 3).alias("depth_step"))


_T, _D = list(TIME_INCREMENTS), list(DEPTH_INCREMENTS)


def _names(names, offset):
    return "CASE min(length(event_type)) " + " ".join(f"WHEN {i + 1 + offset} THEN '{n}'" for i, n in enumerate(names)) + " END"


@query("k6_merged_scopes", f"""SELECT user_id, min(ts) AS time_start, max(ts) AS time_end, {_names(_T, 0)} AS time_step, min(value) AS depth_start,
max(value) AS depth_end, {_names(_D, 3)} AS depth_step FROM events GROUP BY 1""")
def merged_scopes(spark, d):
    return merge_scope_rows(_scopes(spark, d), ["user_id"])


@query("k7_merged_contexts", f"""SELECT c_name AS name, '2024-01-01' AS start, '2024-02-01' AS stop, 'Hourly' AS step, 0.0::DOUBLE AS depth_start, n_name AS parent
FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')""")
def merged_contexts(spark, d):
    c, n = table(spark, d, "customer"), table(spark, d, "nation")
    links = c.join(n, c["c_nationkey"] == n["n_nationkey"]).select(F.col("c_name").alias("child"), F.col("n_name").alias("parent"), "c_mktsegment")

    def part(segment, scope):
        mine = links.where(F.col("c_mktsegment") == segment)
        return {"name": segment, "scope": scope, "entities": mine.select(F.col("child").alias("name")), "hierarchy": mine.select("child", "parent")}

    merged = merge_contexts([
        part("BUILDING", {"time_start": "2024-01-01", "time_end": "2024-01-31", "time_step": "hour", "depth_start": 0.0}),
        part("MACHINERY", {"time_start": "2024-01-10", "time_end": "2024-02-01", "time_step": "daily", "depth_start": 3.0}),
    ])
    s = merged.scope
    return merged.entities.join(merged.hierarchy, F.col("name") == F.col("child")).select(
        "name", F.lit(s.time_start.strftime("%Y-%m-%d")).alias("start"), F.lit(s.time_end.strftime("%Y-%m-%d")).alias("stop"),
        F.lit(s.time_step).alias("step"), F.lit(s.depth_start).alias("depth_start"), "parent",
    )


@query("k8_context_list", """SELECT c_mktsegment AS context, c_name AS name FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')""")
def context_list(spark, d):
    c = table(spark, d, "customer")
    parts = [Context(s, Scope(), c.where(F.col("c_mktsegment") == s).select(F.col("c_name").alias("name"))) for s in ("BUILDING", "MACHINERY")]
    return ContextList(tuple(parts), "merged").entity_rows()


@query("k8_primary_context", """SELECT c_name AS name FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')""")
def primary_context(spark, d):
    c = table(spark, d, "customer")
    parts = [Context(s, Scope(), c.where(F.col("c_mktsegment") == s).select(F.col("c_name").alias("name"))) for s in ("BUILDING", "MACHINERY")]
    return ContextList(tuple(parts), "merged").primary.entities
