"""Behaviour that once depended on size, zone or luck."""

import os
import subprocess
import sys
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gaugework import session
from gaugework.operators import definitions, filters, reftable, units
from gaugework.session import literal_table, new_folder
from gaugework.sources.partitioned import PartitionedTable
from gaugework.sources.signal_store import SignalStore

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bounds_are_wall_clock():
    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "from datetime import datetime\n"
        "from pyspark.sql import functions as F\n"
        "from gaugework.session import local_session\n"
        "from gaugework.operators.filters import in_range\n"
        "from gaugework.sources.partitioned import months\n"
        "spark = local_session(1)\n"
        "df = spark.range(48).select(F.expr(\"timestamp_ntz'2024-01-31 00:00:00' + make_dt_interval(0, cast(id as int))\").alias('date'))\n"
        "print('N', in_range(df, 'date', datetime(2024, 1, 31, 0), datetime(2024, 1, 31, 12)).count(),"
        " df.withColumn('month', F.date_format('date', 'yyyy-MM')).where(months(None, datetime(2024, 1, 31, 22))).count())\n"
    ) % ROOT
    done = subprocess.run([sys.executable, "-c", code], env=os.environ | {"TZ": "America/New_York"}, capture_output=True, text=True, timeout=300)
    assert "N 13 24" in done.stdout, done.stdout + done.stderr[-500:]


def test_repeated_keys_of_a_batch_are_refused(spark):
    store = SignalStore(spark, new_folder(spark, "dup"))
    rows = [("w", "s", datetime(2025, 1, 1), 1.0), ("w", "s", datetime(2025, 1, 1), 2.0)]
    df = literal_table(spark, rows, "entity string, signal string, date timestamp_ntz, value_num double")
    with pytest.raises(Exception, match="share a key"):
        store.save(df, "time")
    store.save(df.limit(1), "time")
    store.save(df.limit(1), "time")
    assert store.scan().count() == 1
    assert isinstance(store.table, PartitionedTable)


def test_conversion_of_unknown_or_foreign_units_raises(spark):
    known = literal_table(spark, [("ft", "Length", 0.3048, 0.0), ("m", "Length", 1.0, 0.0), ("usd", "Money", 1.0, 0.0)], units.SCHEMA)
    for source, target in (("ft", "gone"), ("usd", "m")):
        df = literal_table(spark, [(1.0, source, target)], "v double, s string, t string")
        with pytest.raises(Exception, match="cannot convert"):
            units.convert_rows(df, known, "v", "s", "t").collect()


def test_the_last_of_repeated_keys_wins(spark):
    df = literal_table(spark, [(1, "a", "x"), (2, "b", "y"), (3, "a", "z")], "i int, k string, v string").withColumn("g", F.lit(0))
    assert definitions.pairs_to_map(df, ["g"], ["k", "v"], "i").first()["pairs"] == {"a": "z", "b": "y"}
    got = spark.range(1).select(definitions.enumeration(F.array(F.lit("p"), F.lit("q"), F.lit("p"))).alias("m")).first()["m"]
    assert got == {"p": 2, "q": 1}
    assert definitions.parameter("n", (("a", 5), "b", "c"))["enum"] == {"a": 5, "b": 6, "c": 7}


def test_an_empty_entity_list_finds_nothing(spark):
    df = literal_table(spark, [("w",), (None,)], "Entity string")
    assert df.where(reftable.entity_condition(F.col("Entity"), [])).count() == 0


def test_pages_do_not_overlap(spark):
    items = literal_table(spark, [(t, "same") for t in "abcdef"], "type string, name string")
    pages = [r["type"] for p in (1, 2, 3) for r in filters.item_page(items, p, 2).collect()]
    assert sorted(pages) == list("abcdef")


def test_no_temporary_folder_on_a_cluster(spark, monkeypatch):
    class Elsewhere:
        conf = type("C", (), {"get": staticmethod(lambda *a: None)})
        sparkContext = type("S", (), {"master": "spark://host:7077", "getConf": staticmethod(lambda: type("G", (), {"get": staticmethod(lambda *a: None)}))})

    with pytest.raises(ValueError, match="checkpoint"):
        session.shared_folder(Elsewhere)


def test_labels_only_where_there_are_some(spark):
    from gaugework.plans.models import label_names

    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import StringIndexer, VectorAssembler
    from pyspark.ml.regression import LinearRegression

    rows = spark.createDataFrame([(float(i), "low" if i < 10 else "high", "u" if i % 2 else "v") for i in range(20)], "x double, y string, z string")
    other, own, parts = StringIndexer(inputCol="z", outputCol="zi"), StringIndexer(inputCol="y", outputCol="yi", stringOrderType="alphabetAsc"), VectorAssembler(inputCols=["x"], outputCol="f")
    of = lambda *stages: Pipeline(stages=list(stages)).fit(rows)
    assert label_names(of(other, own, parts, LogisticRegression(featuresCol="f", labelCol="yi"))) == ["high", "low"]
    assert label_names(of(other, parts, LinearRegression(featuresCol="f", labelCol="x"))) is None


def test_gaps_before_between_and_after(spark):
    from gaugework.operators.window import fill_grid

    day = lambda d: datetime(2024, 1, d)
    rows = [("a", day(3), 3.0, "x"), ("a", day(6), None, "y"), ("b", day(9), 9.0, "z"), ("c", day(1), 1.0, "w")]
    df = literal_table(spark, rows, "k string, t timestamp_ntz, v double, o string")
    at = lambda d: F.lit(str(day(d))).cast("timestamp_ntz")
    got = sorted((r["k"], r["t"].day, r["v"], r["o"]) for r in fill_grid(df, ["k"], "t", "v", "Daily", -1.0, at(2), at(7)).collect())
    values = {("a", 3): (3.0, "x"), ("a", 6): (-1.0, "y")}
    assert got == [(k, d, *values.get((k, d), (-1.0, None))) for k in "abc" for d in range(2, 8)]
    own = sorted((r["k"], r["t"].day, r["v"]) for r in fill_grid(df, ["k"], "t", "v", "Daily", -1.0).collect())
    assert own == [("a", 3, 3.0), ("a", 4, -1.0), ("a", 5, -1.0), ("a", 6, -1.0), ("b", 9, 9.0), ("c", 1, 1.0)]


@pytest.mark.parametrize("parts, entities", [
    ([(0, 1, 900.0)], {"2"}), ([(0, 1, 900.0)] * 2, {"2"}), ([(7, 1, 900.0)], set()), ([(0, 40, 900.0)], set()), ([(0, 1, None)], set()), ([], set()),
])
def test_a_query_with_a_missing_or_empty_parameter(spark, tmp_path, parts, entities):
    from catalog import QUERIES, load

    load()
    schema = "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    spark.createDataFrame([(k, "a b", "c", "d", size, price) for k, size, price in parts], schema).write.parquet(f"{tmp_path}/part.parquet")
    events = [(1, 1, "view", datetime(2024, 1, 1), 45.0), (2, 2, "view", datetime(2024, 1, 1), 46.0), (3, 3, "view", datetime(2024, 1, 1), None)]
    spark.createDataFrame(events, "event_id long, user_id long, event_type string, ts timestamp_ntz, value double").write.parquet(f"{tmp_path}/events.parquet")
    assert {r["entity"] for r in QUERIES["n5_parameter_in_query"](spark, str(tmp_path)).collect()} == entities
