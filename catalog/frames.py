"""The given tables in the shapes of the data model, for Spark and as SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugework.operators.definitions import SIGNAL_SCHEMA
from gaugework.operators.units import SCHEMA as UNIT_SCHEMA
from gaugework.session import literal_table, tune


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    """One of the given tables; its schema is read from the files once, then stated."""
    path = f"{d}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = tune(spark).read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


# --- units -----------------------------------------------------------------------------------------
UNITS = [
    (" ", "Dimensionless", 1.0, 0.0),
    ("%", "Dimensionless", 0.01, 0.0),
    ("usd", "Currency", 1.0, 0.0),
    ("cent", "Currency", 0.01, 0.0),
    ("kusd", "Currency", 1000.0, 0.0),
    ("m", "Length", 1.0, 0.0),
    ("cm", "Length", 0.01, 0.0),
    ("ft", "Length", 0.3048, 0.0),
    ("Pa", "Pressure", 1.0, 0.0),
    ("kPa", "Pressure", 1000.0, 0.0),
    ("K", "Temperature", 1.0, 0.0),
    ("C", "Temperature", 1.0, 273.15),
    ("F", "Temperature", 0.5555555555555556, 255.3722222222222),
]


def values(rows: list[tuple], names: str) -> str:
    """Rows as a SQL VALUES relation with doubles spelled as doubles."""
    def cell(v) -> str:
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return str(v).lower()
        if isinstance(v, float):
            return f"CAST({v!r} AS DOUBLE)"
        if isinstance(v, int):
            return str(v)
        return "'" + str(v).replace("'", "''") + "'"

    return "(SELECT * FROM (VALUES " + ", ".join("(" + ", ".join(map(cell, r)) + ")" for r in rows) + f") t({names}))"


UNITS_SQL = values(UNITS, "name, measurement, factor, summand")


def units(spark: SparkSession) -> DataFrame:
    return literal_table(spark, UNITS, UNIT_SCHEMA)


# --- signal definitions ----------------------------------------------------------------------------
SIGNALS = [
    ("purchase", "pur", "TimeDependent", "usd", "Currency", "Sum", "Sum"),
    ("view", "", "TimeDependent", "C", "Temperature", "Average", "Average"),
    ("click", "clk", "TimeDependent", "usd", "Currency", "Max", "Max"),
    ("signup", "", "TimeDependent", "m", "Length", "Min", "Last"),
    ("error", "err", "TimeDependent", "%", "Dimensionless", "Sum", "Median"),
    ("balance", "bal", "Static", "usd", "Currency", "Sum", "Sum"),
    ("segment", "", "String", " ", "Dimensionless", "Max", "Sum"),
    ("price", "", "DepthDependent", "usd", "Currency", "Sum", "Average"),
    ("kind", "", "StringTimeDependent", " ", "Dimensionless", "Max", "Sum"),
]
SIGNALS_SQL = values(SIGNALS, "name, short_name, type, unit, measurement, hierarchy_agg, interval_agg")


def signals(spark: SparkSession) -> DataFrame:
    return literal_table(spark, SIGNALS, SIGNAL_SCHEMA)


# --- samples ---------------------------------------------------------------------------------------
def time_samples(spark: SparkSession, d: str) -> DataFrame:
    """Numeric time series: a user's events by type."""
    return table(spark, d, "events").select(
        F.col("user_id").cast("string").alias("entity"), F.col("event_type").alias("signal"),
        F.col("ts").alias("date"), F.col("value").alias("value_num"), F.lit(None).cast("string").alias("value_str"),
        F.col("event_id"),
    )


TIME_SQL = (
    "(SELECT CAST(user_id AS VARCHAR) AS entity, event_type AS signal, ts AS date, value AS value_num, event_id FROM events)"
)


def text_samples(spark: SparkSession, d: str) -> DataFrame:
    """Text time series: the kind of a user's events."""
    return table(spark, d, "events").select(
        F.col("user_id").cast("string").alias("entity"), F.lit("kind").alias("signal"),
        F.col("ts").alias("date"), F.lit(None).cast("double").alias("value_num"), F.col("event_type").alias("value_str"),
    )


TEXT_SQL = "(SELECT CAST(user_id AS VARCHAR) AS entity, 'kind' AS signal, ts AS date, event_type AS value_str FROM events)"


def depth_samples(spark: SparkSession, d: str) -> DataFrame:
    """Depth series: price of a brand's parts over their size, in quarter metres."""
    return table(spark, d, "part").select(
        F.col("p_brand").alias("entity"), F.lit("price").alias("signal"),
        (F.col("p_size") * F.lit(0.25)).alias("depth"), F.col("p_retailprice").alias("value_num"),
        F.lit(None).cast("string").alias("value_str"),
    )


DEPTH_SQL = (
    "(SELECT p_brand AS entity, 'price' AS signal, p_size * CAST(0.25 AS DOUBLE) AS depth, p_retailprice AS value_num FROM part)"
)


def static_samples(spark: SparkSession, d: str) -> DataFrame:
    """Static series: a customer's balance and segment."""
    c = table(spark, d, "customer")
    entity, no_text, no_num = F.col("c_custkey").cast("string").alias("entity"), F.lit(None).cast("string"), F.lit(None).cast("double")
    balance = c.select(entity, F.lit("balance").alias("signal"), F.col("c_acctbal").alias("value_num"), no_text.alias("value_str"))
    segment = c.select(entity, F.lit("segment").alias("signal"), no_num.alias("value_num"), F.col("c_mktsegment").alias("value_str"))
    return balance.unionByName(segment)


# --- entities and hierarchy ------------------------------------------------------------------------
def entities(spark: SparkSession, d: str) -> DataFrame:
    """Customers and suppliers; negative balances stand for opportunities."""
    c = table(spark, d, "customer").select(
        F.col("c_name").alias("name"), F.lit("Customer").alias("type"),
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("alias"), (F.col("c_acctbal") < 0).alias("is_opportunity"),
    )
    s = table(spark, d, "supplier").select(
        F.col("s_name").alias("name"), F.lit("Supplier").alias("type"),
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("alias"), (F.col("s_acctbal") < 0).alias("is_opportunity"),
    )
    return c.unionByName(s)


ENTITIES_SQL = """(SELECT c_name AS name, 'Customer' AS type, 'C' || CAST(c_custkey AS VARCHAR) AS alias, c_acctbal < 0 AS is_opportunity FROM customer
UNION ALL SELECT s_name, 'Supplier', 'S' || CAST(s_suppkey AS VARCHAR), s_acctbal < 0 FROM supplier)"""


def edges(spark: SparkSession, d: str) -> DataFrame:
    """customer and nation to nation and region."""
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, d, "nation")
    r = table(spark, d, "region")
    leaf = c.join(n, c["c_nationkey"] == n["n_nationkey"]).select(
        F.col("c_custkey").cast("string").alias("child"), F.col("n_name").alias("parent")
    )
    top = n.join(r, n["n_regionkey"] == r["r_regionkey"]).select(F.col("n_name").alias("child"), F.col("r_name").alias("parent"))
    return leaf.unionByName(top)


EDGES_SQL = """(SELECT CAST(c_custkey AS VARCHAR) AS child, n_name AS parent FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION ALL SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey)"""


# --- reference table -------------------------------------------------------------------------------
def order_table(spark: SparkSession, d: str) -> DataFrame:
    """Orders as a reference table with headers; every seventh order has no entity, every ninth no time."""
    o = table(spark, d, "orders")
    return o.select(
        F.when(F.col("o_orderkey") % 7 != 0, F.col("o_custkey").cast("string")).alias("Entity"),
        F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderdate")).alias("Time"),
        F.col("o_orderkey").alias("Key"), F.col("o_totalprice").alias("Price [usd]"),
        F.col("o_orderstatus").alias("Status"), F.col("o_orderpriority").alias("Priority"),
    )


ORDERS_SQL = """(SELECT CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS "Entity",
CASE WHEN o_orderkey % 9 <> 0 THEN o_orderdate END AS "Time", o_orderkey AS "Key", o_totalprice AS "Price", o_orderstatus AS "Status",
o_orderpriority AS "Priority" FROM orders)"""
