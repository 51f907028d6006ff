"""Bottom-k sketches and HyperMinHash near-dedup."""

import hashlib
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from gaugework.llm import bottom_k as B
from gaugework.llm import hyperminhash as H
from gaugework.llm.words import shingle_hashes, word_hashes

random.seed(3)
VOCABULARY = ["".join(random.choice("abcdefghij") for _ in range(6)) for _ in range(400)]


def text(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(VOCABULARY) for _ in range(n))


def edited(t, share, seed):
    r, w = random.Random(seed), t.split()
    for i in range(len(w)):
        if r.random() < share:
            w[i] = f"new{seed}x{i}"
    return " ".join(w)


def shingles(t, size):
    w = (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).replace("\x0b", " ").split()
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


def likeness(a, b):
    return 1.0 if not a | b else len(a & b) / len(a | b)


def test_word_and_shingle_hashes_tell_texts_apart():
    texts = ["a b c", "A  B\tc", "", "ab c", "c b a", "x"]
    column = pa.array(texts)
    for _, _, data, offsets in H.text_runs(column, 4):
        pass
    got = []
    for _, _, data, offsets in H.text_runs(column, 1 << 20):
        s, by = shingle_hashes(*word_hashes(data, offsets), 2)
        got = [tuple(s[a:b]) for a, b in zip(by[:-1], by[1:])]
    assert got[0] == got[1] and len(got[0]) == 2 and got[2] == () and len(got[5]) == 1
    assert len({got[0], got[3], got[4], got[5]}) == 4


def test_sketches_estimate_likeness(spark, make):
    base = [text(1500, i) for i in range(12)]
    rows = [(i, t, None, None) for i, t in enumerate(base)] + [(100 + i, edited(t, 0.02 * i, i), None, None) for i, t in enumerate(base)]
    docs = make(rows)
    got = {r["doc_id"]: r for r in B.sketched(docs, "text", "s").select("doc_id", "s", B.distinct("s").alias("d")).collect()}
    pairs = spark.createDataFrame([(got[i]["s"], got[100 + i]["s"], i) for i in range(12)], "a array<bigint>, b array<bigint>, i int")
    for r in pairs.select("i", B.resemblance("a", "b").alias("r"), B.containment("a", "b").alias("c")).collect():
        a, b = shingles(base[r["i"]], 5), shingles(rows[12 + r["i"]][1], 5)
        assert abs(r["r"] - likeness(a, b)) < 0.2 and abs(r["c"] - len(a & b) / len(a)) < 0.25
        assert 0.7 < got[r["i"]]["d"] / len(a) < 1.4
    whole = B.merged(spark.createDataFrame([(1, got[0]["s"]), (1, got[1]["s"])], "g int, s array<bigint>"), ["g"], "s").first()["s"]
    assert whole == sorted(set(got[0]["s"]) | set(got[1]["s"]))[:B.K]


def test_the_shortcut_never_shows(spark, make):
    repeated = " ".join(["one two three four five six seven"] * 400)
    docs = make([(1, repeated, None, None), (2, text(3000, 5), None, None)])
    for k in (4, 64):
        small = {r["doc_id"]: r["s"] for r in B.sketched(docs, "text", "s", k=k).collect()}
        full = {r["doc_id"]: r["s"] for r in B.sketched(docs, "text", "s", k=5000).collect()}
        assert all(small[d] == full[d][:k] for d in small)


def test_fingerprints_of_odd_rows(odd, none):
    rows = B.fingerprints(odd).collect()
    assert len(rows) == odd.count() and B.fingerprints(none).count() == 0
    by = {r["doc_id"]: r for r in rows}
    assert by[2]["sketch"] == [] and by[2]["near_edited"] == 1.0 and by[1]["n_chars"] == 0
    assert by[4]["sketch"] == by[5]["sketch"] and len(by[4]["sketch"]) == 1
    empty = hashlib.sha256(b"").hexdigest()
    assert by[1]["edited_sha256"] == by[2]["edited_sha256"] == empty
    # 12 is the last; the row without an id comes first.
    t, first = "same words here again and again", "some words without an id, more of them than five"
    assert by[12]["edited_sha256"] == hashlib.sha256((t[:len(t) - len(t) // 4] + first[:len(t) // 4]).encode()).hexdigest()
    assert by[10]["edited_sha256"] == hashlib.sha256((("ünï cödé " * 40)[:270] + t).encode()).hexdigest()
    assert by[11]["near_next"] == 1.0


def test_edited_texts_on_the_tables(spark, sf):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    ids = sorted(docs)
    rows = {r["doc_id"]: r for r in B.fingerprints(spark.read.parquet(f"{sf}/documents.parquet")).collect()}
    off = []
    for d, after in zip(ids, ids[1:] + ids[:1]):
        t, q = docs[d], len(docs[d]) // 4
        new = t[:len(t) - q] + docs[after][:q]
        assert rows[d]["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        off.append(abs(rows[d]["near_edited"] - likeness(shingles(t, 5), shingles(new, 5))))
    assert np.mean(off) < 0.03 and max(off) < 0.25


def test_registers_compress_and_estimate():
    x = np.array([1, 2, 3, 1 << 62, (1 << 63) + 5, (1 << 64) - 1], np.uint64)
    r = H.compress(x)
    assert [v >> H.MANTISSA for v in r.tolist()] == [63, 62, 62, 1, 0, 0]
    rng = np.random.default_rng(0)
    for true in (0.3, 0.6, 0.8, 0.95):
        errors = []
        for _ in range(20):
            n = 2000
            both = int(2 * n * true / (1 + true))
            pool = rng.integers(0, 1 << 63, 2 * n, dtype=np.int64).view(np.uint64)
            sets = [np.sort(pool[:n]), np.sort(pool[n - both:2 * n - both])]
            regs = [H.registers(s, np.array([0, n])) for s in sets]
            errors.append(H.estimate(*regs, np.array([n]), np.array([n]))[0] - true)
        assert abs(np.mean(errors)) < 0.04
    assert 0 < H.chance(np.array([1000]), np.array([1000]))[0] < 2e-3


def components_of(texts, size, percent):
    sets = {d: shingles(t, size) for d, t in texts.items()}
    parent = {d: d for d in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(texts)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {d: find(d) for d in ids}, {d: len(s) for d, s in sets.items()}


def test_near_duplicates_against_all_pairs(make):
    texts, base = {}, text(150, 99)
    for i in range(60):  # a group around one text, with copies on either side of the threshold
        texts[i] = edited(base, 0.004 * i, i)
    chain = text(200, 7)
    for i in range(12):  # a chain: neighbours are near, ends are not
        texts[100 + i] = chain
        chain = edited(chain, 0.06, 1000 + i)
    for i in range(40):
        texts[200 + i] = text(3 + i % 7, i % 5)
    want, sizes = components_of(texts, 2, 80)
    got = {r["doc_id"]: r for r in H.near_duplicates(make([(d, t, None, None) for d, t in texts.items()]), 2, 80).collect()}
    assert {d: r["component_id"] for d, r in got.items()} == want
    assert {d: r["n_shingles"] for d, r in got.items()} == sizes and all(r["kept"] == (want[d] == d) for d, r in got.items())


def test_near_duplicates_of_odd_rows(odd, none):
    rows = H.near_duplicates(odd).collect()
    by = {r["doc_id"]: r for r in rows}
    assert len(rows) == odd.count() and H.near_duplicates(none).count() == 0
    assert all(by[d]["n_shingles"] == 0 and by[d]["kept"] and by[d]["component_id"] == d for d in (1, 2, 3))
    assert by[5]["component_id"] == 4 and by[12]["component_id"] == 11 and by[8]["component_id"] == 7
    assert by[None]["component_id"] is None and by[None]["kept"]
    kept = H.without_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 6, 7, 9, 10, 11]


def test_repeated_rows_stay_once(make):
    docs = make([(1, text(30, 1), None, None)] * 3 + [(2, text(30, 2), None, None)] * 2)
    assert sorted(r["doc_id"] for r in H.without_near_duplicates(docs).collect()) == [1, 2]
    assert H.near_duplicates(docs).where(F.col("kept")).count() == 5
