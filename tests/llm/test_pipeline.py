"""The pipeline's stages one by one, and the registered queries against their SQL."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline as P
from gaugework.llm import registry
from tools.check import database, difference

NUMBERED = {f"op{n}" for n in range(1, 14)}


def test_every_operator_has_one_query():
    assert sorted(name.split("_")[0] for name in registry.QUERIES) == sorted(NUMBERED)
    assert set(registry.QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_sql(spark, sf, name):
    wrong, n = difference(registry.QUERIES[name](spark, sf), database(sf), registry.ORACLES[name])
    assert wrong is None and n > 0


def test_stages_on_odd_rows(spark, odd, none, sf):
    docs, empty = odd, none
    for name, stage in P.STAGES:
        before = {r["doc_id"] for r in docs.collect()}
        docs, empty = stage(spark, docs, sf), stage(spark, empty, sf)
        if name != "shards":
            assert docs.columns == odd.columns and empty.columns == odd.columns
        docs, empty = spark.createDataFrame(docs.collect(), docs.schema), empty
        assert {r["doc_id"] for r in docs.collect()} <= before and empty.count() == 0
        empty = none
    left = {r["doc_id"] for r in docs.collect()}
    assert left <= {None, 4, 6, 7, 10, 11} and {7, 10} <= left


def test_run(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = P.run(spark, sf)
    assert {"shard", "curve"} <= set(out.columns) and set(docs.columns) <= set(out.columns)
    assert out.select("doc_id").distinct().join(docs, "doc_id").count() == out.select("doc_id").distinct().count()
    near = {r["doc_id"] for r in P.near_duplicates(spark, docs, sf).select("doc_id").collect()}
    leaks = {r["doc_id"] for r in registry.QUERIES["op5_latent_decontamination"](spark, sf).select("doc_id").collect()}
    assert {r["doc_id"] for r in out.collect()} == near - leaks
    times = out.groupBy("doc_id").count().agg(F.max("count")).first()[0]
    assert times == 2
