"""The caller's columns come through every operator that passes rows on, whatever their names."""

import pytest
from pyspark.sql import functions as F

from gaugework.llm import hilbert_shards, hyperminhash, language_id, mixing, surrogates

NAMES = ("_id", "_size", "_text_key", "_letters", "_found", "_key", "_row", "_lang_score", "id", "row", "Times", "_Source", "a.b")


@pytest.mark.parametrize("step", [
    hilbert_shards.sharded, hyperminhash.without_near_duplicates, language_id.recognised, lambda d: mixing.mixed_documents(d, block=8, least=1.0), surrogates.replaced,
], ids=["shards", "near_duplicates", "language", "mix", "surrogates"])
def test_columns_pass_through(make, step):
    rows = [(i, f"the sea and the land number {i} were there and so was the wind {i * 7}", "en", "ab"[i % 2]) for i in range(30)]
    docs = make(rows, clash=False)
    docs = docs.select("*", *[F.concat(F.lit(f"{c}:"), F.col("doc_id").cast("string")).alias(c) for c in NAMES])
    out = step(docs)
    assert set(docs.columns) <= set(out.columns)
    got = out.select("doc_id", *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(NAMES)]).collect()
    assert got and all(r[f"c{i}"] == f"{c}:{r['doc_id']}" for r in got for i, c in enumerate(NAMES))


def test_columns_of_the_result_are_replaced_in_any_case(make):
    docs = make([(1, "a", "en", "a"), (2, "b", "en", "a")], clash=False).withColumns({"Shard": F.lit("x"), "CURVE": F.lit("x")})
    assert [c for c in hilbert_shards.sharded(docs).columns if c.lower() in ("shard", "curve")] == ["shard", "curve"]


def test_a_repeated_text_neither_hides_its_language_nor_fills_the_sample(make):
    de = ["der Hund und die Katze sind nicht zu Hause", "wir haben das schöne Wetter gestern noch genossen", "ich weiß nicht, ob er morgen kommen wird"]
    en = [f"the dog and the cat of house {i} were not at home when we came by with {i} friends" for i in range(400)]
    rows = [(i, de[0] if i % 3 else de[1 + i % 2], "de", "a") for i in range(3000)] + [(5000 + i, t, "en", "a") for i, t in enumerate(en)]
    docs = make(rows, clash=False)
    for per_language in (64, 2048):
        model = language_id.learn(docs, per_language)
        found = model.probabilities("die Katze und der Hund sind nicht gekommen")
        assert model.labels == ["de", "en"] and found[0] > 0.5, per_language


def test_uncertain_texts_go_and_clean_ones_stay(make):
    rows = [(i, ("the river and the house of the old man", "der alte Mann und das Haus am Fluss")[i % 2] + f" {i}", ("en", "de")[i % 2], "a") for i in range(400)]
    docs = make([*rows, (900, "123 456 !!!", None, "a"), (901, None, None, "a")], clash=False)
    kept = {r["doc_id"] for r in language_id.recognised(docs).select("doc_id").collect()}
    assert kept == {i for i, *_ in rows}
    assert language_id.sure(1) == 1 and 0.5 < language_id.sure(2) < 0.6 and 1 / 100 < language_id.sure(100) < 1.2 / 99


def test_slots_come_from_the_counts_that_were_drawn(make):
    docs = make([(i, "word " * (40 + i), "en", "abc"[i % 3]) for i in range(60)], clash=False)
    sources = mixing.plan(mixing.intervals(docs, 1), 8, mixing.WEIGHTS, 1.5, 0.0, 2.0)
    wanted = {r["source_no"]: r["slots"] for r in sources.collect()}
    counts = {(r["source_no"], r["shard"]): r["slots"] for r in mixing.drawn_counts(sources, 4, 1).collect()}
    found = mixing.slots(sources, 4, 1).collect()
    for source, n in wanted.items():
        mine = [r for r in found if r["source_no"] == source]
        assert sorted(r["slot"] for r in mine) == list(range(n)) and n == sum(c for (s, _), c in counts.items() if s == source)
        for shard in range(4):
            assert sum(r["shard"] == shard for r in mine) == counts.get((source, shard), 0) > n / 8
