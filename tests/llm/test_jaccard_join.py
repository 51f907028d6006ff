"""PartEnum signatures and components by pivots."""

import random

import numpy as np
from pyspark.sql import functions as F

from gaugework.llm import partenum as P
from gaugework.llm import pivots as V
from gaugework.llm.words import word_hashes
from test_fingerprints import components_of, edited, text


def test_linked_sets_share_a_signature():
    rng = np.random.default_rng(5)
    for percent in (75, 80, 90, 95):
        bands = P.Bands(percent)
        for n in [*range(1, 80), 150, 400, 1500]:
            for _ in range(4):
                pool = rng.integers(0, 1 << 63, 3 * n, dtype=np.int64).view(np.uint64)
                most = bands.highs[bands.of(np.array([n]))[0]]
                gone, more = int(rng.integers(0, n)), int(rng.integers(0, most + 1))
                while n - gone < 1 or 100 * (n - gone) < percent * (n + more):
                    gone, more = gone - (gone >= more), more - (more > gone)
                a, b = np.sort(pool[:n]), np.sort(pool[gone:n + more])
                if gone or more:
                    found, owner = P.signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), bands)
                    assert set(found[owner == 0].tolist()) & set(found[owner == 1].tolist()), (percent, n, gone, more)


def test_sets_with_empty_cells_are_signed_whole():
    bands = P.Bands(50)
    sets = [np.array(x, np.uint64) for x in ([7, 8, 9], [7, 8], [7, 9])]
    found, owner = P.signatures(np.concatenate(sets), np.array([0, 3, 5, 7]), bands)
    by = [set(found[owner == i].tolist()) for i in range(3)]
    assert by[0] & by[1] and by[0] & by[2]


def test_join_against_all_pairs(make):
    texts, base = {}, text(150, 99)
    for i in range(90):  # a group around one text that is not in the table itself, many of it too far from the middle
        texts[i] = edited(base, 0.003 + 0.0007 * (i % 60), i)
    for i in range(40):  # copies of copies: linked with each other, mostly not with the middle
        texts[300 + i] = edited(texts[i % 4 + 50], 0.012, 500 + i)
    chain = text(300, 7)
    for i in range(12):
        texts[100 + i] = chain
        chain = edited(chain, 0.02, 1000 + i)
    for i in range(60):
        texts[200 + i] = text(1 + i % 14, i % 5)
    for i in range(40):  # short texts that share most words
        texts[400 + i] = text(14, 77) + f" {' '.join('xyz'[:i % 4])}"
    want, sizes = components_of(texts, 3, 90)
    docs = make([(d, t, None, None) for d, t in texts.items()])
    got = {r["doc_id"]: r for r in P.joined(docs, 3, 90).collect()}
    assert {d: r["component_id"] for d, r in got.items()} == want
    assert {d: r["n_shingles"] for d, r in got.items()} == sizes
    assert 30 < len(set(want.values())) < 250


def test_join_of_odd_rows(odd, none):
    by = {r["doc_id"]: r for r in P.joined(odd).collect()}
    assert P.joined(odd).count() == odd.count() and P.joined(none).count() == 0
    assert all(by[d]["n_shingles"] == 0 and by[d]["component_id"] == d for d in (1, 2, 3))
    assert by[5]["component_id"] == 4 and by[12]["component_id"] == 11 and by[8]["component_id"] == 7
    assert by[None]["component_id"] is None


def packed_sets(spark, sets):
    rows = [(bytes([i % 256, i // 256]), np.sort(np.array(sorted(s), np.uint64)).tobytes()) for i, s in enumerate(sets)]
    return spark.createDataFrame(rows, "node binary, members binary")


def copies(g, seed):
    """A set of 150 and copies with 1 to 12 elements replaced, most of them not linked with it at 90 %."""
    r = random.Random(seed)
    base = [r.getrandbits(62) for _ in range(150)]
    out = [set(base)]
    for _ in range(g):
        gone = r.sample(range(150), r.randint(1, 16))
        out.append({x for i, x in enumerate(base) if i not in gone} | {r.getrandbits(62) for _ in gone})
    return out


def test_components_of_one_bucket(spark):
    r = random.Random(2)
    sets = copies(60, 1)
    far = copies(0, 9)[0]
    near = [set(x) for x in sets[1:6]]
    for s in near * 3:  # a second level: copies of copies
        out = set(s)
        for x in r.sample(sorted(out), 4):
            out.remove(x)
            out.add(r.getrandbits(62))
        sets.append(out)
    sets += [far, far | {1, 2, 3}]
    full = packed_sets(spark, sets)
    members = full.select(F.lit(1).cast("long").alias("bucket"), "node")
    label = {r["node"]: r["label"] for r in V.resolve(members, full, 90).collect()}
    names = [r["node"] for r in full.collect()]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j]):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    groups = lambda of: {frozenset(i for i in range(len(sets)) if of(i) == k) for k in {of(i) for i in range(len(sets))}}
    assert groups(find) == groups(lambda i: label.get(names[i], names[i]))


def test_candidates_grow_with_the_group(spark):
    rows = []
    for g in (400, 1200):
        full = packed_sets(spark, copies(g, 3))
        pivot = full.where("node = X'0000'").select(F.col("node").alias("pivot"))
        groups = full.select("node").crossJoin(pivot).where("node <> pivot").withColumn("parent", F.lit(0).cast("long"))
        labels = spark.createDataFrame([], "node binary, label binary")
        _, pairs, members = V.meetings(groups, labels, full, 90)
        rows.append(pairs.count() + members.count())
    assert rows[0] <= 2 * 400 and rows[1] <= 2 * 1200  # 79,800 and 719,400 pairs


def test_members_of_the_pivots_component_meet_only_others(spark, monkeypatch):
    """Of 300 copies linked with the pivot, those are entered that share a hash of another member's prefix; no level follows."""
    r = random.Random(8)
    base, pool = ([r.getrandbits(62) for _ in range(n)] for n in (150, 60))
    sets = [set(base)]
    for i in range(303):
        gone = r.sample(range(0 if i < 300 else 60, 90 if i < 300 else 150), 4 if i < 300 else 12)
        sets.append({x for k, x in enumerate(base) if k not in gone} | set(r.sample(pool, len(gone))))
    full, kept = packed_sets(spark, sets), {}
    monkeypatch.setattr(V, "stored", lambda df, label, stored=V.stored: kept.setdefault(label, stored(df, label)))
    groups = full.where("node <> X'0000'").select("node", F.unhex(F.lit("0000")).alias("pivot"), F.lit(0).cast("long").alias("parent"))
    labels = spark.createDataFrame([(bytes([i % 256, i // 256]), b"\0\0") for i in range(301)], "node binary, label binary")
    _, pairs, members = V.meetings(groups, labels, full, 90)
    rows = kept["indexed"].select("h", (F.col("label") == F.unhex(F.lit("0000"))).alias("of_pivot"))
    assert rows.where("of_pivot").count() > 0
    assert rows.where("of_pivot").join(rows.where("not of_pivot"), "h", "left_anti").count() == 0
    assert members.count() == 0 and pairs.count() <= 3 * 304


def test_long_words_that_a_polynomial_cannot_tell_apart():
    word = b"a"
    for _ in range(11):
        word += word.translate(bytes.maketrans(b"ab", b"ba"))
    other = word.translate(bytes.maketrans(b"ab", b"ba"))
    data = np.frombuffer(word + b" " + other + b" " + word.upper(), np.uint8)
    h, _ = word_hashes(data, np.array([0, len(data)]))
    assert h[0] != h[1] and h[0] == h[2]
