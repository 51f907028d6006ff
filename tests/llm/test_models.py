"""Language ID and the language model."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from gaugework.llm import language_id as L
from gaugework.llm import maxent_lm as M

SYLLABLES = {"aa": "ka lo mi tu re", "bb": "schu wer ung ich ken", "cc": "eau oi qué ent lle"}


def crc(i):
    return zlib.crc32(str(i).encode())


def corpus(n, seed=0):
    r, rows = random.Random(seed), []
    for i in range(n):
        lang = r.choice(list(SYLLABLES))
        words = ["".join(r.choice(SYLLABLES[lang].split()) for _ in range(r.randint(1, 3))) for _ in range(r.randint(1, 60))]
        rows.append((i, " ".join(words), lang if r.random() < 0.9 else None, r.choice("xy")))
    return rows


def test_languages_of_held_out_texts(make):
    rows = corpus(400)
    true = {i: next(k for k, v in SYLLABLES.items() if any(t[:2] == s[:2] for s in v.split())) for i, t, _, _ in rows}
    got = L.labelled(make(rows)).collect()
    held = [r for r in got if crc(r["doc_id"]) % 4 == 2]
    assert len(got) == 400 and len(held) > 50
    assert np.mean([r["_lang_pred"] == true[r["doc_id"]] for r in held]) > 0.95
    assert all(0 < r["_lang_score"] < 1 for r in got)


def test_prediction_takes_only_the_text(make):
    rows = corpus(200)
    hidden = [(i, t, "zz" if crc(i) % 4 == 2 else lang, "other" if crc(i) % 4 == 2 else s) for i, t, lang, s in rows]
    a, b = ({r["doc_id"]: (r["_lang_pred"], r["_lang_score"]) for r in L.labelled(make(x)).collect()} for x in (rows, hidden))
    assert a == b


def test_languages_of_odd_rows(odd, none, make):
    out = L.labelled(odd)
    assert out.columns == [*odd.columns, "_lang_pred", "_lang_score"]
    got = {r["doc_id"]: (r["_lang_pred"], r["_lang_score"]) for r in out.collect()}
    assert all(got[d] == (L.UNKNOWN, 0.0) for d in (1, 2, 3, 9)) and got[4][0] != L.UNKNOWN
    assert L.labelled(none).count() == 0
    assert {r["_lang_pred"] for r in L.labelled(make([(1, "some text", None, None)])).collect()} == {L.UNKNOWN}


def test_weights_are_sparse_and_temperature_calibrates():
    r = np.random.default_rng(0)
    rows = [(np.array([0 if y else 1, 2 + i % 50]), np.array([0.8, 0.6]), y) for i, y in enumerate(r.integers(0, 2, 400).tolist())]
    w = L.fit(rows, 2)
    assert (w != 0).sum() < 200 and w[0, 1] > 0 > w[1, 1]
    logits = r.normal(size=(4000, 3)) * 2
    y = np.array([r.choice(3, p=L.softmax(z / 2)) for z in logits])
    assert 1.5 < L.temperature(logits, y) < 2.7


def tokens(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return [*[w for w in low.replace("\x0b", " ").split()], "<end>"]


def base(rows):
    counts = Counter(t for i, text, _, _ in rows if crc("" if i is None else i) % 10 for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    return n, [(i, len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(t))) for i, t, _, _ in rows]


@pytest.mark.parametrize("frequent", [M.FREQUENT, 50])
def test_base_scores(make, monkeypatch, frequent):
    monkeypatch.setattr(M, "FREQUENT", frequent)
    rows = corpus(150, 1) + [(1000, "Unknown WORDS here", None, None), (1010, None, None, None)]
    n, want = base(rows)
    got = {r["doc_id"]: r for r in M.scored(make(rows)).collect()}
    for i, length, known, score in want:
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (length, known, n, crc(i) % 10 == 0)
        assert abs(r["base_score"] - score) < 1e-6 * max(1, abs(score))


def test_model_beats_the_base_on_held_out_texts(spark, sf):
    rows = [r for r in M.scored(spark.read.parquet(f"{sf}/documents.parquet")).collect() if r["held_out"]]
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_probabilities_sum_to_one():
    r = np.random.default_rng(1)
    counts = np.sort(r.integers(5, 100, 300))[::-1]
    h = np.append(r.integers(0, 1 << 62, 299).astype(np.uint64), M.END)
    words = M.Vocabulary(h, counts, int(counts.sum()) + 40, 310)
    classes, c = words.look_up(np.sort(h))
    inside = sum((k + 0.1) / words.mass[q] for q, k in zip(classes, c))
    classes_used = len(set(classes.tolist()))
    assert abs(inside - classes_used) < 1e-9 and abs(words.rare - (40 + 0.1 * 11)) < 1e-9
    w, bias = r.normal(size=(M.BUCKETS, M.CLASSES)).astype(np.float32), np.zeros(M.CLASSES, np.float32)
    z = M.logits(w, bias, [np.array([1, 2]), np.array([3, 4]), np.array([5, 6])])
    assert np.allclose((np.exp(z) / np.exp(z).sum(1, keepdims=True)).sum(1), 1)


def test_scores_of_odd_rows(odd, none):
    rows = M.scored(odd).collect()
    by = {r["doc_id"]: r for r in rows}
    assert len(rows) == odd.count() and M.scored(none).count() == 0
    assert by[1]["n_tokens"] == by[2]["n_tokens"] == by[3]["n_tokens"] == 1
    assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in rows)
