"""Naming, casts and attribute lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import query
from catalog.frames import SIGNALS_SQL, TIME_SQL, UNITS_SQL, signals, table, time_samples, units, values
from gaugework.functions import casts, names
from gaugework.functions.vocabulary import canonical_column, comparison_key
from gaugework.operators.definitions import pairs_to_map, remapped, signal_attributes
from gaugework.operators.reshape import drop_empty_rows, signal_columns_last
from gaugework.plans.signals import column_mapping

_HEADERS = "(SELECT p_partkey, ' ' || p_name || CASE WHEN p_partkey % 3 = 0 THEN '' ELSE ' [' || p_type || '] [x]' END AS h FROM part)"


def _headers(spark, d):
    p = table(spark, d, "part")
    unit = F.when(F.col("p_partkey") % 3 == 0, "").otherwise(F.concat(F.lit(" ["), "p_type", F.lit("] [x]")))
    return p.select("p_partkey", F.concat(F.lit(" "), "p_name", unit).alias("h"))


@query("b1_split_name_unit", f"""SELECT p_partkey, trim(split_part(h, '[', 1)) AS name, regexp_extract(h, '\\[(.*?)\\]', 1) AS unit FROM {_HEADERS}""")
def split_name_unit(spark, d):
    h = F.col("h")
    return _headers(spark, d).select("p_partkey", names.name_part(h).alias("name"), names.unit_part(h).alias("unit"))


@query("b2_rename_with_units", """SELECT c_custkey, c_acctbal AS "balance [usd]", c_mktsegment AS "segment [ ]" FROM customer""")
def rename_with_units(spark, d):
    heads = {r["name"]: names.header(r["name"], r["unit"]) for r in signals(spark).where("name IN ('balance', 'segment')").collect()}
    rows = table(spark, d, "customer").select("c_custkey", F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    return rows.withColumnsRenamed(heads)


@query("b3_signals_last", """SELECT c_custkey AS "Entity", c_name AS "Alias", c_acctbal AS "balance [usd]" FROM customer""")
def signals_last(spark, d):
    rows = table(spark, d, "customer").select(F.col("c_acctbal").alias("balance [usd]"), F.col("c_custkey").alias("Entity"), F.col("c_name").alias("Alias"))
    return signal_columns_last(rows, ["balance"])


@query("b4_rename_depth", """SELECT p_brand AS "Entity", CAST(p_size AS DOUBLE) AS "Depth [ft]" FROM part""")
def rename_depth(spark, d):
    rows = table(spark, d, "part").select(F.col("p_brand").alias("Entity"), F.col("p_size").cast("double").alias("Depth"))
    return rows.withColumnRenamed("Depth", names.header("Depth", "ft"))


@query("b5_split_entity_header", """SELECT p_partkey, 'Well 1' AS entity, p_retailprice AS rate FROM part""")
def split_entity_header(spark, d):
    wide = table(spark, d, "part").select("p_partkey", F.col("p_retailprice").alias("Well 1 : rate"))
    entity, column = names.split_entity_header(wide.columns[1])
    return wide.select("p_partkey", F.lit(entity).alias("entity"), names.col(wide.columns[1]).alias(column))


_TEXTS = """(SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS k, CAST(o_totalprice AS VARCHAR) AS price, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS day,
CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE o_orderstatus END AS status FROM orders)"""


def _texts(spark, d):
    o = table(spark, d, "orders")
    return o.select(
        "o_orderkey", F.col("o_orderkey").cast("string").alias("k"), F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("price"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("day"),
        F.when(F.col("o_orderkey") % 4 == 0, "").otherwise(F.col("o_orderstatus")).alias("status"),
    )


@query("b6_cast_by_map", f"""SELECT o_orderkey, CAST(k AS DOUBLE) AS k, CAST(price AS DOUBLE) AS price, CAST(day AS TIMESTAMP) AS day, length(status) > 0 AS status FROM {_TEXTS}""")
def cast_by_map(spark, d):
    rows = _texts(spark, d)
    done = casts.cast_columns(rows.drop("o_orderkey"), {"price": "float64", "day": "Time", "status": "bool"}, "numeric")
    return done.withColumn("o_orderkey", F.col("k").cast("bigint"))


@query("b7_to_numeric", """SELECT p_partkey, TRY_CAST(CASE WHEN p_partkey % 6 = 0 THEN p_name ELSE CAST(p_size AS VARCHAR) END AS DOUBLE) AS lenient,
CAST(p_size AS DOUBLE) AS strict FROM part""")
def to_numeric(spark, d):
    p = table(spark, d, "part")
    mixed = F.when(F.col("p_partkey") % 6 == 0, F.col("p_name")).otherwise(F.col("p_size").cast("string"))
    return p.select(
        "p_partkey", casts.to_number(mixed, strict=False).alias("lenient"), casts.to_number(F.col("p_size").cast("string")).alias("strict")
    )


@query("b8_to_datetime", f"""SELECT o_orderkey, CAST(day AS TIMESTAMP) AS at, CASE WHEN o_orderkey % 4 <> 0 THEN CAST(day AS TIMESTAMP) END AS lenient FROM {_TEXTS}""")
def to_datetime(spark, d):
    rows, pattern = _texts(spark, d), "yyyy-MM-dd HH:mm:ss"
    spoilt = F.when(F.col("o_orderkey") % 4 == 0, "n/a").otherwise(F.col("day"))
    return rows.select(
        "o_orderkey", casts.to_time(F.col("day"), pattern).alias("at"), casts.to_time(spoilt, pattern, strict=False).alias("lenient")
    )


@query("b9_to_bool", f"""SELECT o_orderkey, length(status) > 0 AS from_text, o_orderkey % 3 <> 0 AS from_number, k AS as_text FROM {_TEXTS}""")
def to_bool(spark, d):
    rows = _texts(spark, d).withColumn("n", F.col("o_orderkey") % 3)
    return rows.select(
        "o_orderkey", casts.cast_column(rows, "status", "boolean").alias("from_text"), casts.cast_column(rows, "n", "bool").alias("from_number"),
        casts.cast_column(rows, "k", "object").alias("as_text"),
    )


@query("b10_date_text", """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 4 THEN '' WHEN 3 THEN 'not a date'
ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') END AS at FROM orders""")
def date_text(spark, d):
    o, k = table(spark, d, "orders"), F.col("o_orderkey") % 5
    text = (
        F.when(k == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(k == 1, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"))
        .when(k == 2, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        .when(k == 3, " not a date ")
    )
    return o.select("o_orderkey", casts.date_text(text).alias("at"))


@query("b11_text_to_time", f"SELECT o_orderkey, CAST(day AS TIMESTAMP) AS at FROM {_TEXTS}")
def text_to_time(spark, d):
    return _texts(spark, d).select("o_orderkey", casts.text_to_time(F.col("day")).alias("at"))


@query("b12_missing_values", f"""SELECT o_orderkey, CASE WHEN status = '' THEN 'NaN' ELSE status END AS as_numeric, status AS as_string,
nullif(status, '') AS as_object, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE k END AS null_string FROM {_TEXTS}""")
def missing_values(spark, d):
    rows = _texts(spark, d).withColumn("n", F.when(F.col("o_orderkey") % 3 != 0, F.col("k")))
    t = rows.schema["status"].dataType
    return rows.select(
        "o_orderkey", casts.or_missing(F.col("status"), "numeric", t).alias("as_numeric"), casts.or_missing(F.col("status"), "string", t).alias("as_string"),
        casts.or_missing(F.col("status"), "object", t).alias("as_object"), casts.or_missing(F.col("n"), "string", t).alias("null_string"),
    )


@query("b13_column_types", """SELECT n_nationkey, 'Numeric' AS n_nationkey_type, 'String' AS n_name_type, 'Bool' AS flag_type, 'DateTime' AS day_type FROM nation""")
def column_types(spark, d):
    rows = table(spark, d, "nation").withColumns({"flag": F.lit(True), "day": F.lit("2024-01-01").cast("timestamp_ntz")})
    kinds = {f.name: casts.column_type(f.dataType) for f in rows.schema}
    return rows.select("n_nationkey", *[F.lit(kinds[c]).alias(f"{c}_type") for c in ("n_nationkey", "n_name", "flag", "day")])


@query("b14_pairs_to_map", """SELECT o_orderkey, 'status' AS k, o_orderstatus AS v FROM orders UNION ALL SELECT o_orderkey, 'priority', o_orderpriority FROM orders""")
def pairs_map(spark, d):
    o = table(spark, d, "orders")
    pairs = o.select("o_orderkey", F.lit("status").alias("k"), F.col("o_orderstatus").alias("v")).unionByName(
        o.select("o_orderkey", F.lit("priority").alias("k"), F.col("o_orderpriority").alias("v")))
    return pairs_to_map(pairs, ["o_orderkey"], ["k", "v"], "k").select("o_orderkey", F.explode("pairs").alias("k", "v"))


@query("b14_positions_to_map", """SELECT n_regionkey, CAST(row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS VARCHAR) AS k, n_name AS v FROM nation""")
def positions_map(spark, d):
    done = pairs_to_map(table(spark, d, "nation"), ["n_regionkey"], ["n_name"], "n_nationkey")
    return done.select("n_regionkey", F.explode("pairs").alias("k", "v"))


@query("b15_drop_empty_rows", """SELECT CASE WHEN p_size > 10 THEN p_size END AS a, CASE WHEN p_size < 30 THEN p_retailprice END AS b FROM part
WHERE p_size > 10 OR (p_size < 30 AND p_size <> 7)""")
def drop_empty(spark, d):
    rows = table(spark, d, "part").select(
        F.when(F.col("p_size") > 10, F.col("p_size")).alias("a"),
        F.when((F.col("p_size") < 30) & (F.col("p_size") != 7), F.col("p_retailprice")).alias("b"),
    )
    return drop_empty_rows(rows)


@query("b16_column_remap", """SELECT o_orderkey, 'purchase' AS signal, 'cent' AS unit, o_totalprice AS value FROM orders
UNION ALL SELECT o_orderkey, 'view', 'usd', o_totalprice + 1 FROM orders UNION ALL SELECT o_orderkey, 'click', 'usd', o_totalprice + 2 FROM orders""")
def column_remap(spark, d):
    o = table(spark, d, "orders").select(
        "o_orderkey", F.col("o_totalprice").alias("total [usd]"), (F.col("o_totalprice") + 1).alias("seen [usd]"), (F.col("o_totalprice") + 2).alias("click")
    )
    mapping = {"total": ("purchase", "cent"), "seen [usd]": "view"}
    rows = column_mapping(o.columns[1:], mapping)
    stored = {r["name"]: r["unit"] for r in signals(spark).select("name", "unit").collect()}
    cells = [
        F.struct(F.lit(s).alias("signal"), F.lit(u or stored[s]).alias("unit"), names.col(c).alias("value")) for c, s, u in rows
    ]
    return o.select("o_orderkey", F.inline(F.array(*cells)))


@query("b17_entity_remap", """SELECT o_orderkey, coalesce(c_name, CAST(o_custkey AS VARCHAR)) AS entity FROM orders
LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment = 'MACHINERY') ON o_custkey = c_custkey""")
def entity_remap(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("entity"))
    c = table(spark, d, "customer").where("c_mktsegment = 'MACHINERY'")
    return remapped("entity", c.select(F.col("c_custkey").cast("string").alias("old"), F.col("c_name").alias("new")), rows)


@query("b18_signal_attributes", f"""SELECT s.signal AS name, d.type, d.measurement, d.unit AS storage_unit, u.name AS unit_name
FROM (SELECT DISTINCT signal FROM {TIME_SQL}) s JOIN {SIGNALS_SQL} d ON s.signal = d.name JOIN {UNITS_SQL} u ON d.measurement = u.measurement""")
def attributes(spark, d):
    used = time_samples(spark, d).select(F.col("signal").alias("name")).distinct()
    return signal_attributes(signals(spark).join(used, "name", "left_semi"), units(spark))


@query("b19_comparison_key", """SELECT p_partkey, trim(lower(translate(p_name || '_-. ,' || p_brand, ' _-.,', ''))) AS k FROM part""")
def comparison(spark, d):
    text = F.concat("p_name", F.lit("_-. ,"), "p_brand")
    return table(spark, d, "part").select("p_partkey", comparison_key(text).alias("k"))


_FORMULAS = """(SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_name WHEN 1 THEN '"' || p_name || '"'
ELSE 'E "' || p_name || '" in "' || p_type || '"' END AS f FROM part)"""


@query("b20_formula_refs", f"""SELECT p_partkey, CASE WHEN f LIKE '%"%' THEN split_part(f, '"', 2) ELSE '' END AS signal,
CASE WHEN f LIKE '%"%"%"%' THEN split_part(f, '"', 4) ELSE ' ' END AS unit FROM {_FORMULAS}""")
def formula_refs(spark, d):
    k = F.col("p_partkey") % 3
    f = F.when(k == 0, F.col("p_name")).when(k == 1, F.concat(F.lit('"'), "p_name", F.lit('"'))).otherwise(
        F.concat(F.lit('E "'), "p_name", F.lit('" in "'), "p_type", F.lit('"')))
    rows = table(spark, d, "part").select("p_partkey", f.alias("f"))
    return rows.select("p_partkey", names.formula_signal(F.col("f")).alias("signal"), names.formula_unit(F.col("f")).alias("unit"))


@query("b21_short_name", """SELECT p_partkey, substr(CASE WHEN p_partkey % 2 = 0 THEN p_brand ELSE p_name || ' of the type ' || p_type || p_brand END, 1, 29) AS short FROM part""")
def short(spark, d):
    given = F.when(F.col("p_partkey") % 4 == 0, F.col("p_brand")).when(F.col("p_partkey") % 2 == 0, F.col("p_brand")).otherwise("")
    name = F.concat("p_name", F.lit(" of the type "), "p_type", "p_brand")
    return table(spark, d, "part").select("p_partkey", names.short_name(given, name).alias("short"))


_SPELLED = [("1 Hour", "Hourly"), ("5-min", "EveryFiveMinutes"), ("D", "Daily"), ("q", "Quarterly"), ("Every Second", "EverySecond")]
_AGGS = [("Mean", "Average"), ("LONGEST", "Max"), ("std", "StandardDeviation"), ("no agg", "NoAggregation"), ("concat", "Sum")]


@query("b22_canonical_names", f"""SELECT event_id, i.b AS increment, a.b AS aggregation FROM events
JOIN {values([(i, t) for i, (_, t) in enumerate(_SPELLED)], 'i, b')} i ON event_id % 5 = i.i
JOIN {values([(i, t) for i, (_, t) in enumerate(_AGGS)], 'i, b')} a ON event_id % 5 = a.i""")
def canonical_names(spark, d):
    at = (F.col("event_id") % 5).cast("int") + 1
    step = F.element_at(F.array(*[F.lit(s) for s, _ in _SPELLED]), at)
    how = F.element_at(F.array(*[F.lit(s) for s, _ in _AGGS]), at)
    return table(spark, d, "events").select(
        "event_id", canonical_column("time increment", step).alias("increment"), canonical_column("aggregation", how).alias("aggregation")
    )
