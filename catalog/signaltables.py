"""Signal tables."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import functions as F

from catalog import query
from catalog.frames import (
    DEPTH_SQL, EDGES_SQL, TIME_SQL, depth_samples, edges, signals, static_samples, table, text_samples, time_samples, units,
)
from gaugework.operators.definitions import SIGNAL_SCHEMA
from gaugework.plans.context import Context, ContextList, Scope
from gaugework.plans.signals import SignalData, load_contexts, load_data, load_pvt, load_signals, stored_data, table_to_samples
from gaugework.plans.tables import load_all_script_tables, load_script_table, pivot_table, table_names
from gaugework.session import literal_table, new_folder
from gaugework.sources.signal_store import SignalStore
from gaugework.sources.pivot_store import delete_pivot, load_pivot, save_pivot


def _rounded(df, columns):
    return df.withColumns({c: F.round(F.col(f"`{c}`"), 4) for c in columns})


def january(step: str | None = "Daily") -> Scope:
    return Scope("January", datetime(2024, 1, 3), datetime(2024, 1, 20), step, 2.0, 9.0, "Meter")


def machinery(spark, d):
    return table(spark, d, "customer").where("c_mktsegment = 'MACHINERY'").select(F.col("c_custkey").cast("string").alias("name"))


MACHINERY_SQL = "(SELECT CAST(c_custkey AS VARCHAR) AS name FROM customer WHERE c_mktsegment = 'MACHINERY')"
IN_JANUARY = "date BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-01-20'"


@query("l1_load_signals_daily", f"""SELECT entity AS "Entity", date_trunc('day', date) AS "Date",
round(sum(value_num) FILTER (signal = 'purchase') * 100, 4) AS "purchase [cent]",
round(avg(value_num + 273.15) FILTER (signal = 'view'), 4) AS "view [K]"
FROM {TIME_SQL} WHERE signal IN ('purchase', 'view') AND {IN_JANUARY} AND entity IN (SELECT name FROM {MACHINERY_SQL})
GROUP BY 1, 2""")
def load_daily(spark, d):
    data = SignalData(time=time_samples(spark, d))
    context = Context("c", january(), machinery(spark, d))
    done = load_signals(data, signals(spark), units(spark), ["pur [cent]", ("view", "K")], context)
    return _rounded(done, ["purchase [cent]", "view [K]"])


@query("l1_load_signals_all_aggregations", f"""SELECT entity AS "Entity", date_trunc('month', date) AS "Date",
round(sum(value_num) FILTER (signal = 'purchase'), 4) AS "purchase [usd]", round(avg(value_num) FILTER (signal = 'view'), 4) AS "view [C]",
round(max(value_num) FILTER (signal = 'click') / 1000, 7) AS "click [kusd]",
round(max_by(value_num, {{'d': date, 'v': value_num}}) FILTER (signal = 'signup') / 0.3048, 6) AS "signup [ft]",
round(quantile_cont(value_num, 0.5) FILTER (signal = 'error'), 4) AS "error [%]",
string_agg(kind, '' ORDER BY date, kind) AS "kind [ ]"
FROM (SELECT *, signal AS kind FROM {TIME_SQL}) GROUP BY 1, 2""")
def load_all_aggregations(spark, d):
    data = SignalData(time=time_samples(spark, d).drop("event_id").unionByName(text_samples(spark, d)))
    wanted = ["purchase", "view", "click [kusd]", "signup [ft]", "error", "kind"]
    done = load_signals(data, signals(spark), units(spark), wanted, Context(scope=Scope(time_step="Monthly")))
    done = _rounded(done, ["purchase [usd]", "view [C]", "error [%]"])
    return done.withColumns({"click [kusd]": F.round("`click [kusd]`", 7), "signup [ft]": F.round("`signup [ft]`", 6)})


@query("l1_load_signals_rolled_up", f"""WITH RECURSIVE e AS {EDGES_SQL},
up AS (SELECT child AS d, parent AS a FROM e UNION ALL SELECT up.d, e.parent FROM up JOIN e ON up.a = e.child),
daily AS (SELECT entity, date_trunc('day', date) AS b, sum(value_num) FILTER (signal = 'purchase') AS p, avg(value_num) FILTER (signal = 'view') AS v
FROM {TIME_SQL} WHERE signal IN ('purchase', 'view') GROUP BY ALL)
SELECT a AS "Entity", b AS "Date", round(sum(p), 4) AS "purchase [usd]", round(avg(v), 7) AS "view [C]" FROM daily JOIN up ON entity = d
WHERE a IN (SELECT r_name FROM region) GROUP BY 1, 2""")
def load_rolled_up(spark, d):
    regions = table(spark, d, "region").select(F.col("r_name").alias("name"))
    context = Context("regions", Scope(time_step="Daily"), regions, edges(spark, d))
    done = load_signals(SignalData(time=time_samples(spark, d)), signals(spark), units(spark), ["purchase", "view"], context)
    return _rounded(done, ["purchase [usd]"]).withColumn("view [C]", F.round("`view [C]`", 7))


@query("l1_load_signals_raw", f"""SELECT entity AS "Entity", date AS "Date", value_num AS "purchase [usd]" FROM {TIME_SQL} WHERE signal = 'purchase' AND {IN_JANUARY}""")
def load_raw(spark, d):
    return load_signals(SignalData(time=time_samples(spark, d)), signals(spark), units(spark), ["purchase"], Context(scope=january(None)), strict=True)


@query("l1_from_store", f"""WITH t AS (SELECT entity, date_trunc('day', date) AS b, round(sum(value_num) * 100, 4) AS p FROM {TIME_SQL}
WHERE signal = 'purchase' AND {IN_JANUARY} GROUP BY ALL),
k AS (SELECT CAST(user_id AS VARCHAR) AS entity, date_trunc('day', ts) AS b, string_agg(event_type, '' ORDER BY ts, event_type) AS k FROM events
WHERE ts BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-01-20' GROUP BY ALL),
s AS (SELECT CAST(c_custkey AS VARCHAR) AS entity, c_acctbal AS b FROM customer)
SELECT k.entity AS "Entity", k.b AS "Date", p AS "purchase [cent]", k AS "kind [ ]", s.b AS "balance [usd]" FROM k LEFT JOIN t ON t.entity = k.entity AND t.b = k.b
JOIN s ON s.entity = k.entity""")
def load_from_store(spark, d):
    """Numbers, texts and static values of one table, all from the store."""
    store = SignalStore(spark, new_folder(spark, "l1s"))
    store.save(time_samples(spark, d), "time")
    store.save(text_samples(spark, d), "time string")
    store.save(static_samples(spark, d).where("signal = 'balance'"), "static")
    wanted, context = ["purchase [cent]", "kind", "balance"], Context(scope=january())
    data = stored_data(store, wanted, signals(spark), units(spark), context)
    return _rounded(load_signals(data, signals(spark), units(spark), wanted, context), ["purchase [cent]"])


# Signal number, aggregation and wanted unit of the 500 signals of a wide table; stored in usd.
WIDE_SIGNALS = [(i, ("Sum", "Average", "Max", "Count", "Last")[i % 5], "cent" if i % 2 else "usd") for i in range(500)]
_WIDE_SQL = {"Sum": "sum(v)", "Average": "avg(v)", "Max": "max(v)", "Count": "count(v)", "Last": "max_by(v, {'d': date, 'v': v})"}


def _wide_cell(i: int, how: str, unit: str) -> str:
    value = f"{_WIDE_SQL[how]} FILTER (k = {i})"
    return value if how == "Count" else f"round({value}{' * 100' if unit == 'cent' else ''}, 4)"


@query("l1_load_signals_500", f"""SELECT l_returnflag AS "Entity", date_trunc('quarter', date) AS "Date",
{", ".join(f'{_wide_cell(*s)} AS "s{s[0]} [{s[2]}]"' for s in WIDE_SIGNALS)}
FROM (SELECT l_returnflag, l_shipdate AS date, l_partkey % 500 AS k, l_extendedprice AS v FROM lineitem) GROUP BY 1, 2""")
def load_wide(spark, d):
    """A table of 500 signals by five aggregations, half of them in another unit."""
    rows = table(spark, d, "lineitem").select(
        F.col("l_returnflag").alias("entity"), F.concat(F.lit("s"), (F.col("l_partkey") % 500).cast("string")).alias("signal"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("date"), F.col("l_extendedprice").alias("value_num"), F.lit(None).cast("string").alias("value_str"))
    defined = literal_table(spark, [(f"s{i}", "", "TimeDependent", "usd", "Currency", "Sum", how) for i, how, _ in WIDE_SIGNALS], SIGNAL_SCHEMA)
    done = load_signals(SignalData(time=rows), defined, units(spark), [(f"s{i}", unit) for i, _, unit in WIDE_SIGNALS], Context(scope=Scope(time_step="Quarterly")))
    return _rounded(done, [f"s{i} [{unit}]" for i, how, unit in WIDE_SIGNALS if how != "Count"])


_TWO_MEDIANS = "round(quantile_cont(value_num, 0.5) FILTER (signal = '{}'){}, 4)"


@query("l1_load_signals_medians", f"""SELECT entity AS "Entity", date_trunc('month', date) AS "Date", {_TWO_MEDIANS.format("purchase", "")} AS "purchase [usd]",
{_TWO_MEDIANS.format("purchase", " * 100")} AS "purchase [cent]", {_TWO_MEDIANS.format("view", " + 273.15")} AS "view [K]", {_TWO_MEDIANS.format("error", "")} AS "error [%]"
FROM {TIME_SQL} WHERE signal IN ('purchase', 'view', 'error') GROUP BY 1, 2""")
def load_medians(spark, d):
    """Several medians share one pass, a signal in two units among them."""
    defined = signals(spark).withColumn("interval_agg", F.lit("Median"))
    wanted = ["purchase", "purchase [cent]", "view [K]", "error"]
    done = load_signals(SignalData(time=time_samples(spark, d)), defined, units(spark), wanted, Context(scope=Scope(time_step="Monthly")))
    return _rounded(done, done.columns[2:])


@query("l2_load_first_values", f"""SELECT entity, signal, date, value_num FROM (SELECT *, row_number() OVER (PARTITION BY entity, signal ORDER BY date, value_num) AS rn
FROM {TIME_SQL} WHERE entity IN (SELECT name FROM {MACHINERY_SQL}) AND signal = 'view') WHERE rn <= 2""")
def load_first(spark, d):
    pairs = machinery(spark, d).select(F.col("name").alias("entity"), F.lit("view").alias("signal"))
    return load_data(time_samples(spark, d), "time", pairs, num_values=2).select("entity", "signal", "date", "value_num")


@query("l2_load_range_resampled", f"""SELECT entity, signal, date_trunc('hour', date) AS date, round(avg(value_num), 4) AS value_num FROM {TIME_SQL} WHERE {IN_JANUARY} GROUP BY ALL""")
def load_range(spark, d):
    s = january()
    done = load_data(time_samples(spark, d), "time", start=s.time_start, end=s.time_end, step="hour", how="Average")
    return done.withColumn("value_num", F.round("value_num", 4))


@query("l2_load_gap_filled", f"""WITH daily AS (SELECT entity, signal, date_trunc('day', date) AS b, sum(value_num) AS v FROM {TIME_SQL} WHERE {IN_JANUARY} GROUP BY ALL),
g AS (SELECT entity, signal, unnest(generate_series(TIMESTAMP '2024-01-03', TIMESTAMP '2024-01-20', INTERVAL 1 DAY)) AS b FROM (SELECT DISTINCT entity, signal FROM daily))
SELECT g.entity, g.signal, CAST(g.b AS TIMESTAMP) AS date, round(coalesce(v, 0), 4) AS value_num FROM g LEFT JOIN daily d ON g.entity = d.entity AND g.signal = d.signal AND g.b = d.b""")
def load_gap_filled(spark, d):
    s = january()
    done = load_data(time_samples(spark, d), "time", start=s.time_start, end=s.time_end, step="day", gap_value=0.0)
    return done.withColumn("value_num", F.round("value_num", 4))


@query("l2_load_range_without_step", f"SELECT entity, signal, date, value_num FROM {TIME_SQL} WHERE {IN_JANUARY}")
def load_range_plain(spark, d):
    s = january()
    return load_data(time_samples(spark, d), "time", start=s.time_start, end=s.time_end).select("entity", "signal", "date", "value_num")


@query("l2_load_depth_resampled", f"""SELECT entity, signal, round(b * 0.5::DOUBLE, 9) AS depth, round(v, 4) AS value_num FROM (
SELECT entity, signal, CAST(floor(round(depth / 0.5::DOUBLE, 9)) AS BIGINT) AS b, sum(value_num) AS v FROM {DEPTH_SQL} WHERE depth BETWEEN 2 AND 9 GROUP BY ALL)""")
def load_depth(spark, d):
    done = load_data(depth_samples(spark, d), "depth", start=2.0, end=9.0, step="half meter")
    return done.withColumn("value_num", F.round("value_num", 4))


@query("l3_save_table", """WITH w AS (SELECT c_name AS e, o_orderdate AS d, o_totalprice AS p, o_orderpriority AS k FROM orders JOIN customer ON o_custkey = c_custkey
WHERE c_mktsegment = 'BUILDING')
SELECT e AS entity, 'purchase' AS signal, 'cent' AS unit, 'TimeDependent' AS signal_type, d AS date, p AS value_num, CAST(NULL AS VARCHAR) AS value_str FROM w
UNION ALL SELECT e, 'kind', ' ', 'StringTimeDependent', d, NULL, k FROM w
UNION ALL SELECT c_name, 'balance', 'usd', 'Static', CAST(NULL AS TIMESTAMP), c_acctbal, NULL FROM customer WHERE c_mktsegment = 'BUILDING' AND c_custkey IN (SELECT o_custkey FROM orders)""")
def save_table(spark, d):
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    wide = o.join(c, o["o_custkey"] == c["c_custkey"]).select(
        F.concat(F.lit("K"), F.col("c_custkey").cast("string")).alias("Entity"), F.col("o_orderdate").alias("Date"), "o_orderkey",
        F.col("o_totalprice").alias("total [usd]"), F.col("o_orderpriority").alias("kind"), F.col("c_acctbal").alias("balance"), F.lit(1.0).alias("unknown"),
    )
    ids = c.select(F.concat(F.lit("K"), F.col("c_custkey").cast("string")).alias("old"), F.col("c_name").alias("new"))
    known = c.where("c_mktsegment = 'BUILDING'").select(F.col("c_name").alias("name"), F.lit("Customer").alias("type"))
    rows = table_to_samples(wide, signals(spark), {"total": ("purchase", "cent")}, ids, known, "customer", "o_orderkey")
    return rows.select("entity", "signal", "unit", "signal_type", "date", "value_num", "value_str")


@query("l3_save_wide_table", """SELECT e AS entity, s AS signal, d AS date, v AS value_num FROM (
SELECT 'A' AS e, 'purchase' AS s, o_orderdate AS d, o_totalprice AS v FROM orders UNION ALL SELECT 'B', 'view', o_orderdate, o_totalprice * 2 FROM orders
UNION ALL SELECT 'A', 'view', o_orderdate, CAST(NULL AS DOUBLE) FROM orders UNION ALL SELECT 'B', 'purchase', o_orderdate, CAST(NULL AS DOUBLE) FROM orders)""")
def save_wide(spark, d):
    wide = table(spark, d, "orders").select(F.col("o_orderdate").alias("Date"), F.col("o_totalprice").alias("A : purchase"), (F.col("o_totalprice") * 2).alias("B : view"))
    return table_to_samples(wide, signals(spark)).select("entity", "signal", "date", "value_num")


def definitions(spark, d):
    """Table definitions, written for every order priority as table name."""
    names = table(spark, d, "orders").select(F.col("o_orderpriority").alias("table_name")).distinct()
    columns = [(0, "Spent", "cent", '"purchase" in "cent"'), (1, "Seen", "", 'E "view" in "K"')]
    cells = [F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"), F.lit(u).alias("unit"), F.lit(f).alias("formula")) for i, c, u, f in columns]
    return names.select("table_name", F.inline(F.array(*cells)))


_SCRIPT = f"""SELECT entity AS "Entity", date_trunc('day', date) AS "Date", round(sum(value_num) FILTER (signal = 'purchase') * 100, 4) AS "Spent [cent]",
round(avg(value_num + 273.15) FILTER (signal = 'view'), 4) AS "Seen [K]" FROM {TIME_SQL} WHERE signal IN ('purchase', 'view') GROUP BY 1, 2"""


def _script(spark, d, which):
    data = SignalData(time=time_samples(spark, d))
    done = load_script_table(definitions(spark, d), which, data, signals(spark), units(spark), Context(scope=Scope(time_step="Daily")))
    return _rounded(done, ["Spent [cent]", "Seen [K]"])


@query("l4_script_table_by_name", _SCRIPT)
def script_by_name(spark, d):
    return _script(spark, d, "1-URGENT")


@query("l4_script_table_by_index", _SCRIPT)
def script_by_index(spark, d):
    return _script(spark, d, -1)


@query("l4_one_signal_two_units", f"""SELECT entity AS "Entity", date_trunc('day', date) AS "Date", round(sum(value_num), 4) AS "A [usd]",
round(sum(value_num) * 100, 4) AS "B [cent]", round(sum(value_num), 4) AS "C [usd]" FROM {TIME_SQL} WHERE signal = 'purchase' GROUP BY 1, 2""")
def one_signal_two_units(spark, d):
    names = table(spark, d, "orders").select(F.col("o_orderpriority").alias("table_name")).distinct()
    columns = [(0, "A", '"purchase" in "usd"'), (1, "B", '"purchase" in "cent"'), (2, "C", '"purchase" in "usd"')]
    cells = [F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"), F.lit("").alias("unit"), F.lit(f).alias("formula")) for i, c, f in columns]
    done = load_script_table(
        names.select("table_name", F.inline(F.array(*cells))), 0, SignalData(time=time_samples(spark, d)), signals(spark), units(spark), Context(scope=Scope(time_step="Daily")),
    )
    return _rounded(done, ["A [usd]", "B [cent]", "C [usd]"])


@query("l4_all_tables", f"""WITH daily AS (SELECT entity, date_trunc('day', date) AS b, sum(value_num) FILTER (signal = 'purchase') AS p,
avg(value_num + 273.15) FILTER (signal = 'view') AS v FROM {TIME_SQL} WHERE signal IN ('purchase', 'view') GROUP BY ALL)
SELECT o_orderpriority AS "Table", entity AS "Entity", b AS "Date", round(p * 100, 4) AS "Spent [cent]", round(v, 4) AS "Seen [K]"
FROM daily, (SELECT DISTINCT o_orderpriority FROM orders)""")
def all_script_tables(spark, d):
    found = load_all_script_tables(definitions(spark, d), SignalData(time=time_samples(spark, d)), signals(spark), units(spark), Context(scope=Scope(time_step="Daily")))
    named = [t.select(F.lit(name).alias("Table"), "*") for name, t in found.items()]
    return _rounded(reduce(lambda a, b: a.unionByName(b), named), ["Spent [cent]", "Seen [K]"])


@query("l5_table_names", "SELECT DISTINCT o_orderpriority AS table_name FROM orders")
def names(spark, d):
    return table_names(definitions(spark, d))


_PIVOT = f"""SELECT entity AS "Entity", date_trunc('month', date) AS "Date", round(sum(value_num) FILTER (signal = 'purchase'), 4) AS "purchase [usd]"
FROM {TIME_SQL} WHERE signal = 'purchase' AND entity IN (SELECT name FROM {MACHINERY_SQL}) GROUP BY 1, 2"""


def _pivot(spark, d):
    context = Context("p", january())
    done = pivot_table(["purchase"], SignalData(time=time_samples(spark, d)), signals(spark), units(spark), context,
                       entities=machinery(spark, d), scope=Scope(time_step="Monthly"))
    return _rounded(done, ["purchase [usd]"])


@query("l6_pivot_with_overrides", _PIVOT)
def pivot_with_overrides(spark, d):
    return _pivot(spark, d)


@query("l7_saved_pivot", _PIVOT)
def saved_pivot(spark, d):
    root = new_folder(spark, "l7")
    save_pivot(_pivot(spark, d), root, "monthly")
    save_pivot(_pivot(spark, d), root, "other")
    assert delete_pivot(spark, root, "other")
    return load_pivot(spark, root, "monthly")


@query("l2_load_rolled_up", f"""WITH RECURSIVE e AS {EDGES_SQL},
up AS (SELECT child AS d, parent AS a FROM e UNION ALL SELECT up.d, e.parent FROM up JOIN e ON up.a = e.child),
m AS (SELECT entity, signal, date_trunc('month', date) AS date, max(value_num) AS v FROM {TIME_SQL} WHERE {IN_JANUARY} GROUP BY ALL)
SELECT entity, signal, date, v AS value_num FROM m UNION ALL SELECT a, signal, date, max(v) FROM m JOIN up ON entity = d GROUP BY ALL""")
def load_data_rolled_up(spark, d):
    s = january()
    return load_data(time_samples(spark, d), "time", start=s.time_start, end=s.time_end, step="month", how="Max", hierarchy=edges(spark, d))


@query("l2_load_rolled_up_count", f"""WITH RECURSIVE e AS {EDGES_SQL},
up AS (SELECT child AS d, parent AS a FROM e UNION ALL SELECT up.d, e.parent FROM up JOIN e ON up.a = e.child),
m AS (SELECT entity, signal, date_trunc('month', date) AS date, count(value_num) AS v FROM {TIME_SQL} WHERE {IN_JANUARY} GROUP BY ALL)
SELECT entity, signal, date, v AS value_num FROM m UNION ALL SELECT a, signal, date, count(v) FROM m JOIN up ON entity = d GROUP BY ALL""")
def load_data_rolled_up_count(spark, d):
    s = january()
    return load_data(time_samples(spark, d), "time", start=s.time_start, end=s.time_end, step="month", how="Count", hierarchy=edges(spark, d))


@query("l2_load_pvt", """SELECT CAST(s_suppkey AS VARCHAR) AS entity, round(s_acctbal / 1000, 6) AS pressure, round(CAST(s_nationkey + 300 AS DOUBLE) - 273.15, 6) AS temperature, 1.5::DOUBLE AS value_num FROM supplier""")
def load_pvt_rows(spark, d):
    rows = table(spark, d, "supplier").select(
        F.col("s_suppkey").cast("string").alias("entity"), F.col("s_acctbal").alias("pressure"), (F.col("s_nationkey") + 300).cast("double").alias("temperature"), F.lit(1.5).alias("value_num"))
    done = load_pvt(rows, units(spark), "kPa", "C")
    return done.withColumns({c: F.round(c, 6) for c in ("pressure", "temperature")})


@query("k8_load_contexts", f"""SELECT 'first half' AS "Context", entity AS "Entity", date_trunc('day', date) AS "Date", round(sum(value_num), 4) AS "purchase [usd]" FROM {TIME_SQL}
WHERE signal = 'purchase' AND date <= TIMESTAMP '2024-01-15' GROUP BY ALL
UNION ALL SELECT 'machinery', entity, date_trunc('month', date), round(sum(value_num), 4) FROM {TIME_SQL} WHERE signal = 'purchase' AND entity IN (SELECT name FROM {MACHINERY_SQL}) GROUP BY ALL""")
def contexts_loaded(spark, d):
    contexts = ContextList((
        Context("first half", Scope(time_end=datetime(2024, 1, 15), time_step="Daily")),
        Context("machinery", Scope(time_step="Monthly"), machinery(spark, d)),
    ))
    done = load_contexts(SignalData(time=time_samples(spark, d)), signals(spark), units(spark), ["purchase"], contexts)
    return _rounded(done, ["purchase [usd]"])
