"""Long to wide, wide to long, typed tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import query
from catalog.frames import DEPTH_SQL, TIME_SQL, depth_samples, static_samples, table, time_samples
from gaugework.operators import reshape
from gaugework.operators.aggregate import aggregate
from gaugework.session import new_folder
from gaugework.sources.files import write_per_entity


def _daily(spark, d):
    rows = time_samples(spark, d).withColumn("Date", F.to_date("date").cast("timestamp_ntz"))
    return aggregate(rows, ["entity", "signal", "Date"], "value_num", "Max", out="value")


@query("i1_pivot_time", f"""SELECT entity AS "Entity", date_trunc('day', date) AS "Date", max(value_num) FILTER (signal = 'view') AS "view [C]",
max(value_num) FILTER (signal = 'error') AS "error [%]" FROM {TIME_SQL} WHERE signal IN ('view', 'error') GROUP BY 1, 2""")
def pivot_time(spark, d):
    rows = _daily(spark, d).withColumnRenamed("entity", "Entity")
    return reshape.pivot_signals(rows, ["Entity", "Date"], {"view": ("value", "view [C]"), "error": ("value", "error [%]")}, strict=True)


@query("i1_pivot_depth", f"""SELECT entity AS "Entity", depth AS "Depth", max(value_num) AS "price [usd]" FROM {DEPTH_SQL} GROUP BY 1, 2""")
def pivot_depth(spark, d):
    rows = depth_samples(spark, d).withColumnsRenamed({"entity": "Entity", "depth": "Depth"})
    return reshape.pivot_signals(rows, ["Entity", "Depth"], {"price": ("value_num", "price [usd]")}, strict=False)


@query("i1_pivot_static", """SELECT CAST(c_custkey AS VARCHAR) AS "Entity", c_acctbal AS "balance [usd]", c_mktsegment AS "segment [ ]" FROM customer""")
def pivot_static(spark, d):
    rows = static_samples(spark, d).withColumnRenamed("entity", "Entity")
    return reshape.pivot_signals(rows, ["Entity"], {"balance": ("value_num", "balance [usd]"), "segment": ("value_str", "segment [ ]")}, strict=True)


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _segments(spark, d):
    """Orders per market segment and day, segment as entity."""
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    return o.join(c, o["o_custkey"] == c["c_custkey"]).groupBy(
        F.col("c_mktsegment").alias("Entity"), F.col("o_orderdate").alias("Date")
    ).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total [usd]"))


SEGMENTS_SQL = """(SELECT c_mktsegment AS e, o_orderdate AS d, count(*) AS n, round(sum(o_totalprice), 2) AS t FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""


@query("i2_wide_to_long", f"""SELECT e AS "Entity", d AS "Date", n, t AS "total [usd]" FROM {SEGMENTS_SQL}""")
def wide_to_long(spark, d):
    return reshape.wide_to_long(reshape.long_to_wide(_segments(spark, d), entities=SEGMENTS))


@query("i3_long_to_wide", "SELECT d AS \"Date\", " + ", ".join(
    f"max(n) FILTER (e = '{s}') AS \"{s} : n\", max(t) FILTER (e = '{s}') AS \"{s} : total [usd]\"" for s in SEGMENTS) + f" FROM {SEGMENTS_SQL} GROUP BY 1")
def long_to_wide(spark, d):
    return reshape.long_to_wide(_segments(spark, d), entities=SEGMENTS)


@query("i3_long_to_wide_found_entities", "SELECT d AS \"Date\", " + ", ".join(f"max(n) FILTER (e = '{s}') AS \"{s} : n\"" for s in SEGMENTS) + f" FROM {SEGMENTS_SQL} GROUP BY 1")
def long_to_wide_found(spark, d):
    return reshape.long_to_wide(_segments(spark, d).select("Entity", "Date", "n"))


@query("i4_split_per_entity", """SELECT c_mktsegment AS "Entity", c_custkey, c_acctbal FROM customer""")
def split_per_entity(spark, d):
    path = new_folder(spark, "i4")
    rows = table(spark, d, "customer").select(F.col("c_mktsegment").alias("Entity"), "c_custkey", "c_acctbal")
    write_per_entity(rows, path)
    return spark.read.parquet(path).select("Entity", "c_custkey", "c_acctbal")


@query("i5_table_from_rows", """SELECT CAST(o_custkey AS VARCHAR) AS "Entity", o_orderdate AS "Date", o_totalprice AS "Price [usd]", o_orderstatus = 'O' AS "Open", o_orderpriority AS "Note" FROM orders""")
def from_rows(spark, d):
    o = table(spark, d, "orders")
    cells = F.array(
        F.col("o_custkey").cast("string"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string"), (F.col("o_orderstatus") == "O").cast("string"), F.col("o_orderpriority"),
    )
    heads = ["Entity", "Date", "Price [usd]", "Open", "Note"]
    return reshape.table_from_rows(o.select(cells.alias("r")), "r", heads, ["Numeric", "String", "Numeric", "Bool", "String"])


@query("i6_tab_table", f"""SELECT "Date", 'A' AS "Entity", price FROM (SELECT o_orderdate AS "Date", o_totalprice AS price FROM orders WHERE o_orderstatus = 'F')
UNION ALL SELECT o_orderdate, 'B', o_totalprice + 1 FROM orders""")
def tab_table(spark, d):
    o = table(spark, d, "orders")
    a = F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice").cast("decimal(18,2)").cast("string")).otherwise("")
    b = (F.col("o_totalprice") + 1).cast("decimal(18,2)").cast("string")
    lines = o.select(F.concat_ws("\t", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), a, b).alias("value"))
    return reshape.tab_table(lines, ["Date", "A : price", "B : price"])


@query("i6_tab_table_wide", "SELECT \"Date\", " + ", ".join(f"max(n) FILTER (e = '{s}') AS \"{s} : n\"" for s in SEGMENTS) + f" FROM (SELECT e, d AS \"Date\", CAST(n AS DOUBLE) AS n FROM {SEGMENTS_SQL}) GROUP BY 1")
def tab_table_wide(spark, d):
    s = _segments(spark, d)
    lines = s.select(F.concat_ws("\t", "Entity", F.date_format("Date", "yyyy-MM-dd HH:mm:ss"), F.col("n").cast("string")).alias("value"))
    return reshape.tab_table(lines, ["Entity", "Date", "n"], with_entity_column=False)


@query("i7_column_table", """SELECT ts AS "Date", CAST(user_id AS VARCHAR) AS "Entity", value AS "view [C]", CAST(NULL AS DOUBLE) AS click FROM events WHERE event_type = 'view'
UNION ALL SELECT ts, CAST(user_id AS VARCHAR), NULL, value FROM events WHERE event_type = 'click'""")
def column_table(spark, d):
    e = table(spark, d, "events").select(F.col("user_id").cast("string").alias("Entity"), F.col("ts").alias("Date"), F.col("value").alias("Value"), "event_type")
    parts = {n: e.where(F.col("event_type") == n).drop("event_type") for n in ("view", "click")}
    return reshape.column_table(parts, {"view": "C"})
