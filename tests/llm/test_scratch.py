"""What stored results leave on disk, and the split of rows by keys."""

import os
import time

import pytest
from pyspark.sql import functions as F

from gaugework.llm import hyperminhash as H
from gaugework.llm.frames import possible_keys, scratch, stored
from gaugework.session import shared_folder
from test_fingerprints import edited, text


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ").split()
    return {f for f in files if os.path.basename(f).startswith("shuffle_")}


def here(df):
    return os.path.isdir(df._folder.removeprefix("file://"))


def test_shuffle_files_go_with_the_job(spark):
    """Without waiting for the driver to collect its garbage."""
    before = shuffle_files(spark)
    df = spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count()
    out = stored(df, "counted")
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    assert not left and out.count() == 100 and stored(df, "again").count() == 100 and df.count() == 100


def test_scratch_deletes_what_is_not_kept(spark):
    with scratch(spark) as keep:
        a = stored(spark.range(3), "a")
        with scratch(spark) as keep_on:
            b, c, d = (stored(spark.range(n), "x") for n in (4, 5, 6))
            keep_on(b)
            keep_on(d)
            assert all(map(here, (a, b, c, d)))
        assert here(a) and here(b) and not here(c) and here(d)
        keep(b)
    assert not here(a) and here(b) and not here(d) and b.count() == 4 and here(stored(spark.range(1), "outside"))
    with pytest.raises(ZeroDivisionError), scratch(spark):
        1 / 0
    assert here(stored(spark.range(1), "after"))


@pytest.mark.parametrize("most", [1, 4, 1 << 20])
def test_possible_keys_hold_all_keys(spark, most):
    rows = spark.range(4000).select((F.col("id") % 1000).alias("_word"), F.when(F.col("id") % 7 > 0, F.col("id") % 7).alias("b"), F.col("id").alias("x"))
    keys = rows.where("x % 10 = 3 and x < 1000").select("_word", "b")
    some, others = possible_keys(rows, keys, ["_word", "b"], most)
    assert some.columns == others.columns == rows.columns
    a, b = {r["x"] for r in some.collect()}, {r["x"] for r in others.collect()}
    wanted = {tuple(r) for r in keys.collect()}
    assert len(a) + len(b) == 4000 and not a & b and not any((x % 1000, x % 7 or None) in wanted for x in b)
    assert most < 1 << 20 or len(a) < 400
    nothing = possible_keys(rows, keys.limit(0), ["_word", "b"])
    assert nothing[0].count() == 0 and nothing[1].count() == 4000


def test_near_duplicates_leave_little_behind(spark, make):
    """Registers, sets, differences and levels are gone before the documents themselves are read again."""
    texts = [text(300, i) for i in range(80)]
    docs = make([(i, t, "en", "a") for i, t in enumerate(texts)] + [(1000 + 100 * k + i, edited(t, 0.01, k), "en", "b") for k in range(1, 4) for i, t in enumerate(texts[:40])])
    folder = shared_folder(spark).removeprefix("file://")
    before = set(os.listdir(folder))
    out = H.without_near_duplicates(docs)
    assert {d.rpartition("-")[0] for d in set(os.listdir(folder)) - before} == {"touched"}
    assert sorted(r["doc_id"] for r in out.collect()) == list(range(80)) and out.columns == docs.columns
