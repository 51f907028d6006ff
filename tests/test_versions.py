"""Stores in versions: what readers and broken-off changes see, and which files are opened."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gaugework.session import literal_table, new_folder
from gaugework.sources.partitioned import Conflict
from gaugework.sources.signal_store import SignalStore

START = datetime(2025, 1, 1)


def samples(spark, signals=3, days=120):
    n = signals * days
    at = (F.lit(START) + F.make_dt_interval(days=(F.col("id") % days).cast("int"))).cast("timestamp_ntz")
    return spark.range(n).select(
        F.lit("w").alias("entity"), F.concat(F.lit("s"), (F.col("id") / days).cast("int")).alias("signal"), at.alias("date"), F.col("id").cast("double").alias("value_num"),
    )


@pytest.fixture()
def store(spark):
    s = SignalStore(spark, new_folder(spark, "versions"))
    s.save(samples(spark), "time")
    return s


def pair(spark, signal):
    return literal_table(spark, [("w", signal)], "entity string, signal string")


def broken_off(table, change, step):
    def lost(*_):
        raise KeyError("lost")

    setattr(table, step, lost)
    with pytest.raises(KeyError):
        change()
    delattr(table, step)


@pytest.mark.parametrize("step", ["_write", "_commit"])
def test_a_broken_off_change_leaves_nothing(spark, store, step):
    before = sorted(store.scan().collect())
    broken_off(store.table, lambda: store.delete(pair(spark, "s1")), step)
    broken_off(store.table, lambda: store.save(samples(spark).withColumn("value_num", F.lit(-1.0)), "time"), step)
    assert sorted(store.scan().collect()) == before and store.table.versions() == [0]
    store.delete(pair(spark, "s1"))
    assert store.scan().count() == 240 and store.table.versions() == [0, 1]


def test_a_reader_keeps_its_version(spark, store):
    old = store.scan()
    store.delete(pair(spark, "s0"))
    store.save(samples(spark, 1).withColumn("value_num", F.lit(7.0)), "time")
    assert old.count() == 360 and store.scan(version=0).count() == 360 and store.scan(version=1).count() == 240
    assert store.scan().where("value_num = 7").count() == 120 and store.scan().count() == 360
    store.table.expire(keep=1)
    assert store.table.versions() == [2] and store.scan().count() == 360


def test_of_two_writers_one_is_told(spark, store):
    other = SignalStore(spark, store.table.path)
    write = other.table._write

    def slow(rows):
        found = write(rows)
        store.delete(pair(spark, "s2"))
        return found

    other.table._write = slow
    with pytest.raises(Conflict):
        other.delete(pair(spark, "s1"))
    assert {r["signal"] for r in store.scan().select("signal").distinct().collect()} == {"s0", "s1"}


def test_only_files_that_can_hold_rows_are_opened(spark):
    s = SignalStore(spark, new_folder(spark, "files"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        s.save(samples(spark, 12), "time")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    every, some = s.scan(), s.scan(["s3"], start=datetime(2025, 3, 1), end=datetime(2025, 3, 31))
    assert 0 < len(some.inputFiles()) < len(every.inputFiles()) and some.count() == 31
    assert s.scan(["nothing"]).count() == 0 and s.scan(start=START - timedelta(days=9), end=START - timedelta(days=1)).count() == 0
    s.save(samples(spark, 12).where("signal = 's3' and month(date) = 3").withColumn("value_num", F.lit(0.0)), "time")
    kept = s.files(version=0).select("file").intersect(s.files(version=1).select("file"))
    assert 0 < kept.count() < len(every.inputFiles()) and s.scan().where("value_num = 0").count() == 32


def test_many_signals_need_few_files(spark):
    s = SignalStore(spark, new_folder(spark, "many"))
    s.save(samples(spark, 5000, 2), "time")
    assert s.files().select("file").distinct().count() <= 16
    assert s.scan(["s4321"]).count() == 2


def test_ranges_of_both_axes(spark):
    s = SignalStore(spark, new_folder(spark, "axes"))
    s.save(samples(spark, 1, 30), "time")
    s.save(literal_table(spark, [("w", "d", float(i), float(i)) for i in range(10)], "entity string, signal string, depth double, value_num double"), "depth")
    s.save(literal_table(spark, [("w", "x", "t")], "entity string, signal string, value_str string"), "static string")
    assert s.scan(start=START, end=START, depth_start=3, depth_end=5).count() == 4
    assert s.scan(depth_start=3).count() == 7 and s.scan(signal_type=["depth", "static string"]).count() == 11
    s.delete(pair(spark, "d"), "depth", 2.0, 4.0)
    assert s.scan(signal_type="depth").count() == 7


def test_a_compressible_side_is_counted(spark):
    from gaugework.operators.joins import BROADCAST_ROWS, fits

    path = new_folder(spark, "wide")
    spark.range(BROADCAST_ROWS + 50_000).select(F.lit("x" * 60).alias("k"), F.lit(1).alias("v")).coalesce(1).write.parquet(path)
    assert not fits(spark.read.parquet(path)) and fits(spark.read.parquet(path).limit(1000)) and fits(literal_table(spark, [(1,)], "k int"))
