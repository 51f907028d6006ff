"""Reference tables: define, load, save, delete."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from catalog import query
from catalog.frames import ORDERS_SQL, order_table, table, units
from gaugework.operators.reftable import define, delete_rows, info_rows, load_rows, to_stored, upsert
from gaugework.session import new_folder
from gaugework.sources.ref_store import RefTableStore

_KEYS = ["Entity", "Time", "Key"]
_ALL = '"Entity", "Time", "Key" AS "Key [ ]", "Price" AS "Price [usd]", "Status" AS "Status [ ]", "Priority" AS "Priority [ ]"'


def _table(spark, d):
    t = define("orders", order_table(spark, d))
    return t, to_stored(order_table(spark, d), t, units(spark))


def _load(spark, d, **options):
    t, rows = _table(spark, d)
    return load_rows(rows, t, units(spark), **options)


def _store(spark, d, label):
    store = RefTableStore(spark, new_folder(spark, label), units(spark))
    store.create("orders", order_table(spark, d))
    return store


@query("j1_create", f"""SELECT "Entity", "Time", "Key" AS "Key [ ]", "Price" AS "Price [usd]", "Status" AS "Status [ ]", "Priority" AS "Priority [ ]" FROM {ORDERS_SQL}""")
def create(spark, d):
    shuffled = order_table(spark, d).select("Price [usd]", "Key", "Status", "Priority", "Time", "Entity")
    store = RefTableStore(spark, new_folder(spark, "j1"), units(spark))
    store.create("orders", shuffled)
    return store.load("orders")


@query("j2_load_by_entities", f"""SELECT {_ALL} FROM {ORDERS_SQL} WHERE "Entity" IN ('8', '11', '769')""")
def load_by_entities(spark, d):
    return _load(spark, d, entities=["8", "11", "769"])


@query("j2_load_by_entity_table", f"""SELECT {_ALL} FROM {ORDERS_SQL} WHERE "Entity" IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'MACHINERY')""")
def load_by_entity_table(spark, d):
    names = table(spark, d, "customer").where("c_mktsegment = 'MACHINERY'").select(F.col("c_custkey").cast("string"))
    return _load(spark, d, entities=names)


@query("j3_load_exact_time", f"""SELECT {_ALL} FROM {ORDERS_SQL} WHERE "Time" = TIMESTAMP '1997-05-28'""")
def load_exact(spark, d):
    return _load(spark, d, start=datetime(1997, 5, 28), end=datetime(1997, 5, 28))


@query("j3_load_time_range", f"""SELECT {_ALL} FROM {ORDERS_SQL} WHERE "Time" >= TIMESTAMP '1996-01-01' AND "Time" <= TIMESTAMP '1997-06-30'""")
def load_range(spark, d):
    return _load(spark, d, start="1996-01-01", end="1997-06-30")


@query("j3_load_open_range", f"""SELECT {_ALL} FROM {ORDERS_SQL} WHERE "Time" >= TIMESTAMP '1998-01-01'""")
def load_open(spark, d):
    return _load(spark, d, start="1998-01-01")


@query("j4_load_columns", f"""SELECT "Entity", "Time", "Key" AS "Key [ ]", round("Price" * 100, 2) AS "Price [cent]", "Status" AS "Status [ ]" FROM {ORDERS_SQL}""")
def load_columns(spark, d):
    done = _load(spark, d, columns=["Price [cent]", ("Status",)], all_columns=False)
    return done.withColumn("Price [cent]", F.round("`Price [cent]`", 2))


@query("j4_load_all_columns", f"""SELECT "Entity", "Time", "Key" AS "Key [ ]", round("Price" / 1000, 6) AS "Price [kusd]", "Status" AS "Status [ ]", "Priority" AS "Priority [ ]" FROM {ORDERS_SQL}""")
def load_all_columns(spark, d):
    done = _load(spark, d, columns={"Price": "kusd"}, all_columns=True)
    return done.withColumn("Price [kusd]", F.round("`Price [kusd]`", 6))


@query("j5_load_where", f"""SELECT {_ALL} FROM {ORDERS_SQL} WHERE "Status" = 'F' AND "Key" >= 2000 AND "Priority" <> '[Key]' AND "Time" <= TIMESTAMP '1999-01-01'""")
def load_where(spark, d):
    return _load(spark, d, where="[Status] = 'F' AND [Key] >= '2000' AND [Priority] <> '[Key]'", end="1999-01-01")


_UPSERTED = f"""SELECT "Entity", "Time", "Key", CASE WHEN "Status" = 'O' THEN "Price" + 1 ELSE "Price" END AS "Price" FROM {ORDERS_SQL}"""


@query("j6_upsert", _UPSERTED)
def upsert_rows(spark, d):
    _, rows = _table(spark, d)
    rows = rows.select(*_KEYS, "Price")
    return upsert(rows, rows.where("Key >= 0").join(_open(spark, d), "Key", "left_semi").withColumn("Price", F.col("Price") + 1), _KEYS)


def _open(spark, d):
    return table(spark, d, "orders").where("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("Key"))


@query("j6_upsert_stored", f"""SELECT "Entity", "Time", "Key" AS "Key [ ]", CASE WHEN "Status" = 'O' THEN "Price" + 1 ELSE "Price" END AS "Price [usd]" FROM {ORDERS_SQL}""")
def upsert_stored(spark, d):
    store = _store(spark, d, "j6")
    again = order_table(spark, d).where("Status = 'O'").withColumn("Price [usd]", F.col("`Price [usd]`") + 1)
    store.save("orders", again)
    store.save("orders", again)
    return store.load("orders", columns=["Price"], all_columns=False)


@query("j6_upsert_repeated_keys", f"""SELECT "Entity", "Time", "Key" AS "Key [ ]", CASE WHEN "Status" = 'O' THEN "Price" + 2 ELSE "Price" END AS "Price [usd]" FROM {ORDERS_SQL}""")
def upsert_repeated(spark, d):
    store = _store(spark, d, "j6r")
    open_rows = order_table(spark, d).where("Status = 'O'")
    twice = open_rows.withColumn("turn", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn("Price [usd]", F.col("`Price [usd]`") + F.col("turn"))
    store.save("orders", twice, order="turn")
    return store.load("orders", columns=["Price"], all_columns=False)


@query("j6_skip_stored", f"""SELECT "Entity", "Time", "Key" AS "Key [ ]", "Price" AS "Price [usd]" FROM {ORDERS_SQL}""")
def skip_stored(spark, d):
    store = _store(spark, d, "j6s")
    store.save("orders", order_table(spark, d).withColumn("Price [usd]", F.lit(0.0)), skip_existing=True)
    return store.load("orders", columns=["Price"], all_columns=False)


@query("j7_save_converts_units", f"""SELECT "Entity", "Time", "Key", round("Price" / 100, 4) AS "Price", "Status", "Priority" FROM {ORDERS_SQL}""")
def save_converts(spark, d):
    t, _ = _table(spark, d)
    cents = order_table(spark, d).withColumnRenamed("Price [usd]", "Price [cent]")
    return to_stored(cents, t, units(spark)).withColumn("Price", F.round("Price", 4))


_KEPT = """SELECT "Entity", "Time", "Key", "Price" FROM {src} WHERE NOT coalesce({gone}, false)"""


def _kept(spark, d, **conditions):
    t, rows = _table(spark, d)
    return delete_rows(rows, t, **conditions).select(*_KEYS, "Price")


@query("j8_delete_by_entities", _KEPT.format(src=ORDERS_SQL, gone='"Entity" IN (\'8\', \'11\') OR "Entity" IS NULL'))
def delete_by_entities(spark, d):
    return _kept(spark, d, entities=["8", "11", None])


@query("j9_delete_by_time", _KEPT.format(src=ORDERS_SQL, gone="\"Time\" BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1997-12-31' OR \"Time\" IS NULL"))
def delete_by_time(spark, d):
    return _kept(spark, d, start="1996-01-01", end="1997-12-31", drop_null_times=True)


@query("j9_delete_by_time_keep_null", _KEPT.format(src=ORDERS_SQL, gone="\"Time\" <= TIMESTAMP '1997-12-31'"))
def delete_by_time_keep(spark, d):
    return _kept(spark, d, end="1997-12-31")


@query("j10_delete_by_keys", f"""SELECT "Entity", "Time", "Key", "Price" FROM {ORDERS_SQL} WHERE "Status" <> 'P'""")
def delete_by_keys(spark, d):
    t, rows = _table(spark, d)
    return delete_rows(rows, t, keys=rows.where("Status = 'P'").select(*_KEYS)).select(*_KEYS, "Price")


@query("j11_delete_where", _KEPT.format(src=ORDERS_SQL, gone="\"Status\" = 'F' AND \"Entity\" IS NULL AND \"Price\" > 100000"))
def delete_where(spark, d):
    return _kept(spark, d, entities=[None], where="[Status] = 'F' AND [Price] > '100000'")


@query("j11_delete_stored", f"""SELECT "Entity", "Time", "Key" AS "Key [ ]", "Price" AS "Price [usd]" FROM {ORDERS_SQL}
WHERE NOT coalesce("Time" <= TIMESTAMP '1997-12-31' OR "Time" IS NULL, false)""")
def delete_stored(spark, d):
    store = _store(spark, d, "j11")
    store.delete("orders", end="1997-12-31", drop_null_times=True)
    return store.load("orders", columns=["Price"], all_columns=False)


@query("j10_delete_keys_stored", f"""SELECT "Entity", "Time", "Key" AS "Key [ ]", "Price" AS "Price [usd]" FROM {ORDERS_SQL} WHERE "Status" <> 'P'""")
def delete_keys_stored(spark, d):
    store = _store(spark, d, "j10")
    store.delete("orders", keys=order_table(spark, d).where("Status = 'P'").select(*_KEYS))
    return store.load("orders", columns=["Price"], all_columns=False)


@query("j12_drop_table", """SELECT count(*) AS n_before, false AS is_left FROM orders""")
def drop_table(spark, d):
    store = _store(spark, d, "j12")
    before = store.load("orders").count()
    store.drop("orders")
    return table(spark, d, "orders").agg(F.count(F.lit(1)).alias("n_before"), F.lit("orders" in store.names() or before == 0).alias("is_left"))


@query("j13_table_info", """SELECT n_nationkey, u.role, u.name, u.unit, u.type FROM nation, (VALUES ('key', 'Key', ' ', 'Numeric'), ('value', 'Price', 'usd', 'Numeric'),
('value', 'Status', ' ', 'String'), ('value', 'Priority', ' ', 'String')) u(role, name, unit, type)""")
def table_info(spark, d):
    t = define("orders", order_table(spark, d))
    cells = [F.struct(F.lit(r).alias("role"), F.lit(n).alias("name"), F.lit(u).alias("unit"), F.lit(k).alias("type")) for _, r, n, u, k in info_rows(t)]
    return table(spark, d, "nation").select("n_nationkey", F.inline(F.array(*cells)))


@query("j6_two_versions", """WITH o AS (SELECT o_orderkey AS "Key [ ]", o_totalprice AS p, o_orderstatus AS s FROM orders)
SELECT 'first' AS version, "Key [ ]", p AS "Price [usd]" FROM o
UNION ALL SELECT 'second', "Key [ ]", CASE WHEN s = 'O' THEN p + 1 ELSE p END FROM o
UNION ALL SELECT 'third', "Key [ ]", CASE WHEN s = 'O' THEN p + 1 ELSE p END FROM o WHERE s <> 'F'""")
def two_versions(spark, d):
    """A table before an upsert, after it, and after a delete, each read as its own version."""
    store = _store(spark, d, "j6v")
    numbers = [store.version("orders")]
    store.save("orders", order_table(spark, d).where("Status = 'O'").withColumn("Price [usd]", F.col("`Price [usd]`") + 1))
    numbers.append(store.version("orders"))
    store.delete("orders", where="[Status] = 'F'")
    numbers.append(store.version("orders"))
    parts = [
        store.load("orders", version=n).select(F.lit(name).alias("version"), "`Key [ ]`", "`Price [usd]`")
        for name, n in zip(("first", "second", "third"), numbers)
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
