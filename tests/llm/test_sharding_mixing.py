"""Hilbert sharding and mixing."""

import itertools

import pytest
from pyspark.sql import functions as F

from gaugework.llm import hilbert_shards as H
from gaugework.llm import mixing as M


def curve(spark, n, bits):
    cells = list(itertools.product(range(1 << bits), repeat=n))
    df = spark.createDataFrame(cells, [f"p{i}" for i in range(n)])
    rows = df.withColumn("h", H.index([f"p{i}" for i in range(n)], bits)).orderBy("h").collect()
    return [tuple(r)[:n] for r in rows], [r["h"] for r in rows]


@pytest.mark.parametrize("n,bits", [(1, 3), (2, 1), (2, 4), (3, 3), (4, 2)])
def test_curve_visits_every_cell_by_single_steps(spark, n, bits):
    cells, index = curve(spark, n, bits)
    assert index == list(range(1 << n * bits))
    assert all(sum(abs(a - b) for a, b in zip(x, y)) == 1 for x, y in zip(cells, cells[1:]))


def test_shards_of_odd_rows(odd):
    rows = H.shard(odd, shards=4).collect()
    assert len(rows) == odd.count()
    for s in {r["shard"] for r in rows}:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows)))
    sizes = {r["doc_id"]: r["size"] for r in rows}
    assert sizes[1] == 1 and sizes[2] == 1 and sizes[4] == 5 and {r["text_crc32"] for r in rows if r["doc_id"] in (1, 2)} == {0}


def test_shards_are_near_equal_and_prune(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = H.shard(docs).collect()
    by = {s: sum(r["size"] for r in rows if r["shard"] == s) for s in range(16)}
    assert max(by.values()) - min(by.values()) <= 2 * max(r["size"] for r in rows)
    langs = H.sharded(docs).groupBy("shard").agg(F.countDistinct("lang").alias("n")).collect()
    assert sum(r["n"] for r in langs) < 16 * docs.select("lang").distinct().count()


def test_sharded_keeps_rows_and_agrees(odd):
    out = H.sharded(odd, shards=4)
    assert set(out.columns) == set(odd.columns) and out.count() == odd.count()
    same = {r["doc_id"]: r["shard"] for r in H.shard(odd, shards=4).collect()}
    got = {r["doc_id"]: r["shard"] for r in out.collect()}
    assert all(got[k] == same[k] for k in (1, 2, 3, 7, 8, 10))


def test_shards_of_nothing(none):
    assert H.shard(none).count() == 0 and H.sharded(none).count() == 0


def test_targets_meet_their_bounds():
    a, b, c = M.targets([("a", 100), ("b", 100), (None, 100)])
    assert a == 200 and b + c == 250 and b <= 200 and c <= 200
    assert M.targets([("a", 0), ("b", 10)]) == [0.0, 15.0]
    assert M.targets([]) == []
    low = M.targets([("a", 10), ("b", 100), ("c", 10)], least=1.0)
    assert all(x >= n for x, n in zip(low, (10, 100, 10)))


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000])
def test_shuffle_is_a_permutation(spark, n):
    df = spark.range(n).select(F.expr(M.shuffled("id", f"{n}L", "'k'")).alias("x"))
    assert sorted(r["x"] for r in df.collect()) == list(range(n))


def test_mix_of_odd_rows(odd):
    rows = M.mix(odd, block=8).collect()
    assert len(rows) == odd.count() and all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    assert rows and M.mix(odd, block=8).exceptAll(M.mix(odd, block=8)).count() == 0
    by = {}
    for r in rows:
        by.setdefault(r["source"], []).append(r)
    for part in by.values():
        assert sum(r["size"] for r in part) == part[0]["source_size"]
        assert abs(sum(r["taken"] for r in part) - part[0]["target"]) <= max(8, 0.01 * part[0]["target"])


def test_packed_blocks_hold_what_the_mix_takes(odd):
    blocks = M.packed(odd, block=8).collect()
    taken = sum(p["to"] - p["from"] for b in blocks for p in b["parts"])
    assert taken == M.mix(odd, block=8).agg(F.sum("taken")).first()[0]
    assert all(sum(p["to"] - p["from"] for p in b["parts"]) <= 8 for b in blocks)


def test_mixed_documents(odd, none):
    out = M.mixed_documents(odd, block=8, least=1.0)
    assert out.columns == odd.columns
    words = {r["doc_id"] for r in out.collect()}
    assert {4, 5, 6, 7, 8, 9, 10, 11, 12, None} <= words and not words & {1, 2, 3}
    assert M.mixed_documents(none).count() == 0 and M.mix(none).count() == 0


def test_mixed_documents_meet_the_targets(make):
    """Documents of many blocks, each of which averages its source's ratio."""
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(300 + i)), "en", "abc"[i % 3]) for i in range(150)]
    docs = make(rows)
    target = {r["source"]: r["target"] for r in M.mix(docs, block=8, least=1.0, share=1.4).collect()}
    words = {}
    for r in M.mixed_documents(docs, block=8, least=1.0, share=1.4).collect():
        words[r["source"]] = words.get(r["source"], 0) + len(r["text"].split())
    assert set(words) == set(target) and all(abs(words[s] - target[s]) <= 500 for s in target), (words, target)
