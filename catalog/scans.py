"""Scans, sources and sinks. Sinks write to a new folder below the shared one and read it back."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import functions as F

from catalog import query
from catalog.frames import DEPTH_SQL, TEXT_SQL, TIME_SQL, depth_samples, static_samples, table, text_samples, time_samples
from gaugework.operators.reshape import tab_lines
from gaugework.session import new_folder
from gaugework.sources import files
from gaugework.sources.logs import append_logs, log_rows, read_logs, with_logs, workflow_log_rows
from gaugework.sources.series import flatten_series, nest_series, records_from_json, records_to_json
from gaugework.sources.signal_store import SignalStore, without_pairs


@query("a1_read_table", """SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier""")
def read_table(spark, d):
    path = new_folder(spark, "a1")
    files.write_csv(table(spark, d, "supplier"), path, delimiter="\t")
    return files.read_delimited(spark, path, schema="s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double")


_LINES = """SELECT CAST(c_custkey AS VARCHAR) || chr(9) || c_name || CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE chr(9) || c_mktsegment END
|| CASE WHEN c_nationkey = 11 THEN chr(9) || 'x' || chr(9) || 'y' ELSE '' END AS value FROM customer"""


def customer_lines(spark, d):
    """Some lines short, some too long."""
    c = table(spark, d, "customer")
    return c.select(
        F.concat(
            F.col("c_custkey").cast("string"), F.lit("\t"), F.col("c_name"),
            F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.concat(F.lit("\t"), F.col("c_mktsegment"))),
            F.when(F.col("c_nationkey") == 11, "\tx\ty").otherwise(""),
        ).alias("value")
    )


@query("a2_parse_tab_lines", f"""SELECT nullif(p[1], '') AS id, nullif(p[2], '') AS name, nullif(p[3], '') AS segment
FROM (SELECT string_split(value, chr(9)) AS p FROM ({_LINES})) WHERE len(p) <= 3""")
def parse_tab_lines(spark, d):
    return tab_lines(customer_lines(spark, d), ["id", "name", "segment"])


@query("a3_write_csv", """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%fZ') AS o_orderdate,
o_orderstatus FROM orders""")
def write_csv(spark, d):
    path = new_folder(spark, "a3")
    files.write_csv(table(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus"), path)
    return files.read_csv(spark, path)


@query("a4_read_csv_object", "SELECT p_partkey, p_name, p_retailprice FROM part")
def read_csv_object(spark, d):
    path = new_folder(spark, "a4")
    files.write_csv(table(spark, d, "part").select("p_partkey", "p_name", "p_retailprice"), path)
    return files.read_csv(spark, path, "p_partkey bigint, p_name string, p_retailprice double")


@query("a5_json_round_trip", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def json_round_trip(spark, d):
    path = new_folder(spark, "a5")
    rows = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    files.write_json(rows, path)
    return files.read_json(spark, path, rows.schema)


@query("a5_json_keeps_microseconds", "SELECT event_id, ts, value FROM events")
def json_times(spark, d):
    path = new_folder(spark, "a5t")
    rows = table(spark, d, "events").select("event_id", "ts", "value")
    files.write_json(rows, path)
    return files.read_json(spark, path, rows.schema)


@query("a1_table_keeps_microseconds", "SELECT event_id, ts, value FROM events")
def csv_times(spark, d):
    path = new_folder(spark, "a1t")
    rows = table(spark, d, "events").select("event_id", "ts", "value")
    files.write_csv(rows, path, delimiter="\t", date_format=False)
    return files.read_delimited(spark, path, schema=rows.schema)


@query("a6_text_content", "SELECT item_id, regexp_replace(text, '[\\r\\n\\t]', ' ', 'g') AS text FROM benchmark")
def text_content(spark, d):
    path = new_folder(spark, "a6")
    rows = table(spark, d, "benchmark").withColumn("text", F.regexp_replace("text", "[\r\n\t]", " "))
    rows.select(F.concat_ws("\t", F.col("item_id").cast("string"), "text").alias("value")).write.text(path)
    parts = F.split("value", "\t", 2)
    return files.read_text(spark, path).select(parts[0].cast("bigint").alias("item_id"), parts[1].alias("text"))


@query("a6_bytes_content", "SELECT n_name AS name, CAST(length(r_name) + 1 AS BIGINT) AS length FROM nation JOIN region ON n_regionkey = r_regionkey")
def bytes_content(spark, d):
    path = new_folder(spark, "a6b")
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    rows = n.join(r, n["n_regionkey"] == r["r_regionkey"]).select("n_name", F.col("r_name").alias("value"))
    rows.repartition("n_name").write.partitionBy("n_name").text(path)
    # One line per nation, so a file's size is the text and its line end.
    files_ = files.read_bytes(spark, f"{path}/*/*.txt")
    return files_.select(F.regexp_extract("path", "n_name=([^/]+)", 1).alias("name"), F.octet_length("content").cast("bigint").alias("length"))


@query("a7_folder_with_names", "SELECT o_orderstatus AS status, CAST(o_orderkey AS VARCHAR) AS line FROM orders WHERE o_orderstatus LIKE 'F%'")
def folder_with_names(spark, d):
    path = new_folder(spark, "a7")
    rows = table(spark, d, "orders").select(F.col("o_orderstatus").alias("status"), F.col("o_orderkey").cast("string").alias("value"))
    rows.write.partitionBy("status").text(path)
    return files.read_folder(spark, path, "status=F").select(F.regexp_extract("name", "^status=([^/]+)/", 1).alias("status"), "line")


@query("a7_list_files", "SELECT DISTINCT 'status=' || o_orderstatus AS folder FROM orders")
def list_files(spark, d):
    path = new_folder(spark, "a7l")
    rows = table(spark, d, "orders").select(F.col("o_orderstatus").alias("status"), F.col("o_orderkey").cast("string").alias("value"))
    rows.write.partitionBy("status").text(path)
    found = files.list_files(spark, path, "status=")
    return found.select(F.regexp_extract("name", "^([^/]+)/", 1).alias("folder")).distinct()


def _records(spark, d):
    rows = time_samples(spark, d).select(
        F.col("entity").alias("Entity"), F.col("signal").alias("Signal"), F.lit("usd").alias("Unit"),
        F.col("date").alias("Date"), F.col("value_num").alias("Value"),
    )
    return nest_series(rows)


@query("a8_flatten_series", f"""SELECT entity AS "Entity", signal AS "Signal", 'usd' AS "Unit", date AS "Date", value_num AS "Value" FROM {TIME_SQL}""")
def flatten(spark, d):
    return flatten_series(_records(spark, d))


@query("a8_flatten_json", f"""SELECT entity AS "Entity", signal AS "Signal", 'usd' AS "Unit", date AS "Date", value_num AS "Value" FROM {TIME_SQL}""")
def flatten_json(spark, d):
    return flatten_series(records_from_json(records_to_json(_records(spark, d))))


@query("a8_flatten_depth", f"""SELECT entity AS "Entity", signal AS "Signal", 'usd' AS "Unit", depth AS "Depth", value_num AS "Value" FROM {DEPTH_SQL}""")
def flatten_depth(spark, d):
    rows = depth_samples(spark, d).select(
        F.col("entity").alias("Entity"), F.col("signal").alias("Signal"), F.lit("usd").alias("Unit"),
        F.col("depth").alias("Depth"), F.col("value_num").alias("Value"),
    )
    return flatten_series(nest_series(rows, "Depth"))


@query("a9_nest_series", f"""SELECT entity AS "Entity", signal AS "Signal", 'usd' AS "Unit", count(*) AS n, min(date) AS first_date,
max(date) AS last_date, min_by(value_num, {{'d': date, 'v': value_num}}) AS first_value FROM {TIME_SQL} GROUP BY ALL""")
def nest(spark, d):
    data = F.col("Data")
    return _records(spark, d).select(
        "Entity", "Signal", "Unit", F.size(data).cast("bigint").alias("n"), data[0]["Date"].alias("first_date"),
        F.element_at(data, -1)["Date"].alias("last_date"), data[0]["Value"].alias("first_value"),
    )


def _store(spark, d, label):
    store = SignalStore(spark, new_folder(spark, label))
    store.save(time_samples(spark, d).withColumn("unit", F.lit("usd")), "time")
    return store


@query("a10_store_upsert", f"""SELECT entity, signal, date, CASE WHEN signal = 'view' THEN value_num + 1000 ELSE value_num END AS value_num FROM {TIME_SQL}""")
def store_upsert(spark, d):
    store = _store(spark, d, "a10")
    again = time_samples(spark, d).where("signal = 'view'").withColumn("value_num", F.col("value_num") + 1000)
    store.save(again.withColumn("unit", F.lit("usd")), "time numeric")
    return store.scan(signal_type="time").select("entity", "signal", "date", "value_num")


@query("a10_store_all_types", f"""SELECT 'TimeDependent' AS signal_type, count(*) AS n FROM events
UNION ALL SELECT 'StringTimeDependent', count(*) FROM events UNION ALL SELECT 'Static', count(*) FROM customer
UNION ALL SELECT 'String', count(*) FROM customer
UNION ALL SELECT 'DepthDependent', count(*) FROM (SELECT DISTINCT entity, depth FROM {DEPTH_SQL})
UNION ALL SELECT 'PVT', count(*) FROM (SELECT DISTINCT s_suppkey, s_acctbal, s_nationkey FROM supplier)""")
def store_all_types(spark, d):
    store = SignalStore(spark, new_folder(spark, "a10t"))
    static = static_samples(spark, d)
    store.save(time_samples(spark, d), "time")
    store.save(text_samples(spark, d), "time string")
    store.save(static.where("signal = 'balance'"), "static")
    store.save(static.where("signal = 'segment'"), "static string")
    store.save(depth_samples(spark, d).groupBy("entity", "signal", "depth").agg(F.avg("value_num").alias("value_num")), "depth")
    pvt = table(spark, d, "supplier").select(
        F.col("s_suppkey").cast("string").alias("entity"), F.lit("density").alias("signal"), F.col("s_acctbal").alias("pressure"),
        F.col("s_nationkey").cast("double").alias("temperature"), F.lit(1.0).alias("value_num"),
    )
    store.save(pvt, "pvt")
    return store.scan().groupBy("signal_type").agg(F.count(F.lit(1)).alias("n"))


@query("a12_scan_depth_range", f"""SELECT entity, signal, CAST(NULL AS TIMESTAMP) AS date, depth, value_num, CAST(NULL AS VARCHAR) AS value_str
FROM (SELECT entity, signal, depth, avg(value_num) AS value_num FROM {DEPTH_SQL} GROUP BY ALL) WHERE depth BETWEEN 2 AND 9
UNION ALL SELECT entity, signal, date, NULL, NULL, value_str FROM {TEXT_SQL} WHERE date BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-25'""")
def scan_depth_range(spark, d):
    store = SignalStore(spark, new_folder(spark, "a12d"))
    store.save(depth_samples(spark, d).groupBy("entity", "signal", "depth").agg(F.avg("value_num").alias("value_num")), "depth")
    store.save(text_samples(spark, d), "time string")
    store.save(static_samples(spark, d).where("signal = 'balance'"), "static")
    found = store.scan(signal_type=["depth", "time string", "static"], start=datetime(2024, 1, 5), end=datetime(2024, 1, 25), depth_start=2.0, depth_end=9.0)
    return found.select("entity", "signal", "date", "depth", "value_num", "value_str")


class _Interrupted(Exception):
    """Stands for a driver that is lost."""


def _interrupted(change, table):
    """Run a change whose driver is lost after its files are written and before they become a version."""
    def lost(*_):
        raise _Interrupted

    table._commit = lost
    try:
        change()
    except _Interrupted:
        pass
    finally:
        del table._commit


@query("a11_delete_interrupted", f"""SELECT 'broken off' AS state, signal, count(*) AS n, round(sum(value_num), 2) AS total FROM {TIME_SQL} GROUP BY 2
UNION ALL SELECT 'as it was', signal, count(*), round(sum(value_num), 2) FROM {TIME_SQL} GROUP BY 2
UNION ALL SELECT 'done', signal, count(*), round(sum(value_num), 2) FROM {TIME_SQL} s WHERE NOT (
EXISTS (SELECT 1 FROM (SELECT CAST(c_custkey AS VARCHAR) AS entity, 'view' AS signal FROM customer WHERE c_mktsegment = 'MACHINERY') p
WHERE p.entity = s.entity AND p.signal = s.signal) AND date >= TIMESTAMP '2024-01-10' AND date <= TIMESTAMP '2024-01-20') GROUP BY 2""")
def delete_interrupted(spark, d):
    store = _store(spark, d, "a11i")
    first = store.table.version()
    change = lambda: store.delete(_pairs(spark, d), "date", datetime(2024, 1, 10), datetime(2024, 1, 20))
    _interrupted(change, store.table)
    broken = store.scan()
    change()
    states = {"broken off": broken, "as it was": store.scan(version=first), "done": store.scan()}
    counted = [
        rows.groupBy("signal").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value_num"), 2).alias("total")).select(F.lit(state).alias("state"), "signal", "n", "total")
        for state, rows in states.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), counted)


_PAIRS_SQL = "(SELECT CAST(c_custkey AS VARCHAR) AS entity, 'view' AS signal FROM customer WHERE c_mktsegment = 'MACHINERY')"


def _pairs(spark, d):
    c = table(spark, d, "customer").where("c_mktsegment = 'MACHINERY'")
    return c.select(F.col("c_custkey").cast("string").alias("entity"), F.lit("view").alias("signal"))


_DELETED = f"""SELECT entity, signal, date, value_num FROM {TIME_SQL} s WHERE NOT (
EXISTS (SELECT 1 FROM {_PAIRS_SQL} p WHERE p.entity = s.entity AND p.signal = s.signal)
AND date >= TIMESTAMP '2024-01-10' AND date <= TIMESTAMP '2024-01-20')"""


@query("a11_store_delete", _DELETED)
def store_delete(spark, d):
    store = _store(spark, d, "a11")
    store.delete(_pairs(spark, d), "date", datetime(2024, 1, 10), datetime(2024, 1, 20))
    return store.scan().select("entity", "signal", "date", "value_num")


@query("a11_delete_plan", _DELETED)
def delete_plan(spark, d):
    rows = time_samples(spark, d).select("entity", "signal", "date", "value_num")
    return without_pairs(rows, _pairs(spark, d), "date", datetime(2024, 1, 10), datetime(2024, 1, 20))


@query("a12_store_scan", f"""SELECT entity, signal, date, value_num FROM {TIME_SQL} WHERE signal IN ('view', 'click')
AND entity IN (SELECT entity FROM {_PAIRS_SQL}) AND date BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-25'""")
def store_scan(spark, d):
    names = _pairs(spark, d).select(F.col("entity").alias("name"))
    found = _store(spark, d, "a12").scan(["view", "click"], names, "time", start=datetime(2024, 1, 5), end=datetime(2024, 1, 25))
    return found.select("entity", "signal", "date", "value_num")


@query("a13_log_append", """SELECT 'order ' || o_orderstatus AS "Message", 'Python Script' AS "Category", CAST(o_custkey AS VARCHAR) AS "Entity",
o_orderdate AS "Timestamp", CAST(NULL AS VARCHAR) AS "Workflow" FROM orders
UNION ALL SELECT 'run', 'Workflow Execution', CAST(c_custkey AS VARCHAR), CAST(NULL AS TIMESTAMP), 'nightly' FROM customer""")
def log_append(spark, d):
    path = new_folder(spark, "a13")
    orders = table(spark, d, "orders").select(
        F.concat(F.lit("order "), "o_orderstatus").alias("message"), F.col("o_custkey").alias("entity"), F.col("o_orderdate").alias("timestamp")
    )
    runs = table(spark, d, "customer").select(F.lit("run").alias("message"), F.col("c_custkey").alias("entity"))
    append_logs(log_rows(orders), path)
    append_logs(workflow_log_rows(runs, "nightly"), path)
    return read_logs(spark, path).select("Message", "Category", "Entity", "Timestamp", "Workflow")


@query("a14_save_with_logs", f"""SELECT entity AS "Entity", signal AS "Signal", 'Saved' AS "Message", count(*) AS "NumberOfItems" FROM {TIME_SQL} GROUP BY 1, 2""")
def save_with_logs(spark, d):
    store, path = SignalStore(spark, new_folder(spark, "a14")), new_folder(spark, "a14logs")
    store.save_with_logs(time_samples(spark, d), path, "time")
    return read_logs(spark, path).select("Entity", "Signal", "Message", "NumberOfItems")


@query("a14_load_with_logs", f"""SELECT entity AS "Entity", signal AS "Signal", 'Loaded' AS "Message", count(*) AS "NumberOfItems" FROM {TIME_SQL} GROUP BY 1, 2""")
def load_with_logs(spark, d):
    _, found = with_logs(time_samples(spark, d), "Loaded")
    return found.select("Entity", "Signal", "Message", "NumberOfItems")


@query("a15_empty_table", """SELECT CAST(n_name AS VARCHAR) AS "Entity", CAST(NULL AS DOUBLE) AS "Rate", CAST(NULL AS TIMESTAMP) AS "Time" FROM nation""")
def empty_table(spark, d):
    empty = files.empty_table(spark, {"Entity": "string", "Rate": "float64", "Time": "datetime64[ns]"})
    return empty.unionByName(table(spark, d, "nation").select(F.col("n_name").alias("Entity")), allowMissingColumns=True)
