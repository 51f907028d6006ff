"""Suffix-array dedup: the construction, and removal against brute force."""

import hashlib
import random
from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gaugework.llm import suffix_dedup as S
from gaugework.llm.suffix_order import suffix_order


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=60))
def test_suffix_order(symbols):
    assert suffix_order(symbols) == sorted(range(len(symbols)), key=lambda i: symbols[i:])


def test_suffix_order_of_runs_and_words():
    for s in ([5] * 300, list(range(1, 200)), list(range(200, 0, -1)), [1, 2] * 150, [ord(c) for c in "mississippi banana abracadabra " * 9]):
        assert suffix_order(s) == sorted(range(len(s)), key=lambda i: s[i:])


def brute(texts):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + S.LENGTH] for b in raw for i in range(len(b) - S.LENGTH + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - S.LENGTH + 1):
            if seen[b[i:i + S.LENGTH]] > 1:
                gone[i:i + S.LENGTH] = b"\1" * S.LENGTH
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(b), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest()))
    return out


def cases():
    r = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyz é"
    new = lambda n: "".join(r.choice(letters) for _ in range(n))
    passage, longer = new(199), new(260)
    exact = new(200)
    while len(exact.encode()) != 200:
        exact = new(200)
    texts = [new(r.randint(0, 900)) for _ in range(12)]
    texts += [new(r.randint(0, 300)) + longer + new(r.randint(0, 300)) for _ in range(25)]
    texts += ["q" + exact, exact + "z", new(50) + passage.replace("é", "e")[:199] + "1", new(50) + passage.replace("é", "e")[:199] + "2"]
    texts += ["x" * 700, "y" * 200, "y" * 199, "ab" * 400, texts[0] + texts[1], longer + longer, None, "", "", " "]
    texts += [new(400)] * 3 + [new(150)] * 2
    return texts


@pytest.mark.parametrize("large", [S.LARGE, 1])
def test_removed_bytes(make, monkeypatch, large):
    monkeypatch.setattr(S, "LARGE", large)
    texts = cases()
    rows = S.without_repeats(make([(i, t, None, None) for i, t in enumerate(texts)])).collect()
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows}
    assert [got[i] for i in range(len(texts))] == brute(texts)


def test_removed_bytes_on_the_tables(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = docs.orderBy("doc_id").select("doc_id", "text").collect()
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in S.without_repeats(docs).collect()}
    assert [got[r["doc_id"]] for r in texts] == brute([r["text"] for r in texts])


def test_odd_rows(odd, none):
    rows = S.without_repeats(odd).collect()
    by = {r["doc_id"]: r for r in rows}
    assert len(rows) == odd.count() and S.without_repeats(none).count() == 0
    assert by[1]["n_bytes"] == 0 and by[1]["kept_sha256"] == hashlib.sha256(b"").hexdigest()
    assert by[7]["n_removed"] == by[7]["n_bytes"] and by[8]["n_bytes"] - by[8]["n_removed"] == len("tail")


def test_marks_of_many_buckets_leave_in_few_batches():
    n = 3 * S.OUT_ROWS
    # Buckets of one copied slice, and of two that share some of their windows.
    left, right = b"a" * (S.STEP - 1), b"b" * (S.STEP - 1)
    slices = [(core, 0, left, right, True) for core in range(0, n, 2)] + [(core, 0, x + left[1:], right, False) for core in range(1, n, 2) for x in (b"a", b"c")]
    slices.sort(key=lambda s: s[0])
    columns = [pa.array([s[k] for s in slices], t) for k, t in enumerate((pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.bool_()))]
    batch = pa.RecordBatch.from_arrays(columns, names=["core", "low", "left", "right", "copied"])
    out = list(S.bucket_marks(iter([batch.slice(i, 1000) for i in range(0, len(slices), 1000)])))
    rows = [r for b in out for r in b.to_pylist()]
    every = (1 << S.STEP) - 1
    assert sorted((r["core"], r["mark"]) for r in rows) == sorted((s[0], every if s[4] else every >> 1) for s in slices)
    assert len(out) <= len(rows) // S.OUT_ROWS + 1
    assert [b.num_rows for b in S.bucket_marks(iter([]))] == [0]
