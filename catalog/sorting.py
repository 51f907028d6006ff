"""Top N, paging, finest and coarsest increments."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import query
from catalog.frames import ORDERS_SQL, order_table, table, units
from catalog.predicates import ITEMS_SQL, items
from gaugework.functions.buckets import step_order
from gaugework.functions.vocabulary import DEPTH_INCREMENTS, TIME_INCREMENTS
from gaugework.operators import filters
from gaugework.operators.reftable import define, load_rows, to_stored
from gaugework.session import new_folder
from gaugework.sources.pivot_store import load_pivot, save_pivot


@query("g1_top_rows", f"""SELECT "Entity", "Time", "Key" AS "Key [ ]", "Price" AS "Price [usd]" FROM {ORDERS_SQL}
ORDER BY "Entity" NULLS FIRST, "Time" NULLS FIRST, "Key" LIMIT 25""")
def top_rows(spark, d):
    orders = order_table(spark, d)
    t = define("orders", orders)
    done = load_rows(to_stored(orders, t, units(spark)), t, units(spark), top=25, columns=["Price"], all_columns=False)
    return done


@query("g2_saved_rows", "SELECT 40 AS n, max(o_orderkey) >= 0 AS has_rows FROM orders")
def saved_rows(spark, d):
    root = new_folder(spark, "g2")
    save_pivot(table(spark, d, "orders"), root, "orders")
    rows = load_pivot(spark, root, "orders", rows=40)
    return rows.agg(F.count(F.lit(1)).cast("int").alias("n"), (F.max("o_orderkey") >= 0).alias("has_rows"))


@query("g2_saved_rows_in_order", """SELECT o_custkey, o_orderkey, o_totalprice FROM orders ORDER BY o_custkey, o_orderkey LIMIT 40""")
def saved_rows_in_order(spark, d):
    root = new_folder(spark, "g2o")
    save_pivot(table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), root, "orders")
    return load_pivot(spark, root, "orders", rows=40, order=["o_custkey", "o_orderkey"])


@query("g2_saved_rows_all", "SELECT o_orderkey, o_totalprice FROM orders")
def saved_rows_all(spark, d):
    root = new_folder(spark, "g2a")
    save_pivot(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), root, "orders")
    return load_pivot(spark, root, "orders", rows=0)


@query("g3_items_page", f"SELECT type, name FROM {ITEMS_SQL} ORDER BY name LIMIT 20 OFFSET 40")
def items_page(spark, d):
    return filters.item_page(items(spark, d).select("type", "name"), 3, 20)


def _steps_sql(names, order: str, modulo: int) -> str:
    cases = " ".join(f"WHEN {i} THEN {k}" for i, k in enumerate(order_list(names, modulo)))
    ranks = f"(CASE (p_size + p_partkey) % {modulo} {cases} END)"
    words = " ".join(f"WHEN {k} THEN '{n}'" for k, n in enumerate(names))
    return f"""SELECT p_brand, CASE min({ranks}) {words} END AS finest, CASE max({ranks}) {words} END AS coarsest FROM part GROUP BY 1"""


def order_list(names, modulo):
    return [(3 * i + 1) % len(names) for i in range(modulo)]


def _extremes(spark, d, names, kind):
    """Each part names a step; the finest and coarsest per brand by ordinal."""
    picks = order_list(names, 4)
    pick = ((F.col("p_size") + F.col("p_partkey")) % 4).cast("int") + 1
    step = F.element_at(F.array(*[F.lit(list(names)[k]) for k in picks]), pick)
    order = F.create_map(*[x for n, i in step_order(kind).items() for x in (F.lit(n), F.lit(i))])
    rows = table(spark, d, "part").select("p_brand", step.alias("step")).withColumn("o", F.element_at(order, F.col("step")))
    return rows.groupBy("p_brand").agg(F.min_by("step", "o").alias("finest"), F.max_by("step", "o").alias("coarsest"))


@query("g4_time_step_extremes", _steps_sql(TIME_INCREMENTS, "time", 4))
def time_steps(spark, d):
    return _extremes(spark, d, TIME_INCREMENTS, "time")


@query("g4_depth_step_extremes", _steps_sql(DEPTH_INCREMENTS, "depth", 4))
def depth_steps(spark, d):
    return _extremes(spark, d, DEPTH_INCREMENTS, "depth")
