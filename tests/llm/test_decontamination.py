"""Latent decontamination."""

import random

import numpy as np

from gaugework.llm import latent_decontamination as D
from gaugework.llm.words import NO_LETTER, word_hashes

R = random.Random(11)
WORDS = ["".join(R.choice("abcdefghijklmnop") for _ in range(R.randint(2, 8))) for _ in range(3000)]


def sentence(n, r=R):
    return " ".join(r.choice(WORDS) for _ in range(n)).capitalize() + "."


ITEMS = [(i, sentence(20) + " " + sentence(8)) for i in range(30)]


def corpus():
    rows = [(i, " ".join(sentence(15) for _ in range(1 + i % 9)), None, None) for i in range(60)]
    for i, t in ITEMS[:15]:  # verbatim, within other text
        rows.append((1000 + i, sentence(40 * (i % 4)) + " " + t + " " + sentence(30), None, None))
    for i, t in ITEMS[15:20]:  # paraphrases: the question changed, the answer kept
        q, a = t.split(". ")
        w = q.split()
        w[::3] = [R.choice(WORDS) for _ in w[::3]]
        rows.append((1000 + i, sentence(30) + " " + " ".join(w) + ". " + a, None, None))
    for i, t in ITEMS[20:25]:  # half of the question without its answer is no leak
        rows.append((1000 + i, sentence(30) + " " + " ".join(t.split()[:9]) + " " + sentence(30), None, None))
    rows.append((2000, ITEMS[3][1].upper() + "!!! " + ITEMS[4][1], None, None))
    return rows


def items(spark, rows=None):
    return spark.createDataFrame(ITEMS if rows is None else rows, "item_id long, text string")


def test_leaks(spark, make):
    found = {(r["doc_id"], r["item_id"]) for r in D.leaks(make(corpus()), items(spark)).collect()}
    assert found == {(1000 + i, i) for i in range(20)} | {(2000, 3), (2000, 4)}


def test_blocks_give_the_same(spark, make, monkeypatch):
    monkeypatch.setattr(D, "BLOCK", 7)
    found = {(r["doc_id"], r["item_id"]) for r in D.leaks(make(corpus()), items(spark)).collect()}
    assert found == {(1000 + i, i) for i in range(20)} | {(2000, 3), (2000, 4)}


def test_candidates_recall_brute_force_cosine(spark, make):
    """All passages by exact TF-IDF cosine against those found through a latent space of lower rank."""
    docs = make(corpus())
    idf = D.frequencies(docs)
    support, latent = D.basis(items(spark), idf, rank=24)
    assert np.allclose(latent.T @ latent, np.eye(latent.shape[1]), atol=1e-3)
    queries = D.Queries(ITEMS, idf, support, latent)
    wanted = got = 0
    for _, text, _, _ in corpus():
        data = np.frombuffer(text.encode(), np.uint8)
        words, by_doc = word_hashes(data, np.array([0, len(data)]), NO_LETTER)
        found = {(f, i) for _, f, i, _ in zip(*queries.candidates(words, by_doc))}
        for first in range(0, len(words), D.WINDOW // 2):
            at, x = D.vector(words[first:first + D.WINDOW], idf)
            for i, w in enumerate(queries.words):
                q = dict(zip(*D.vector(w, idf)))
                if sum(q.get(k, 0) * v for k, v in zip(at.tolist(), x.tolist())) >= 0.4:
                    wanted += 1
                    got += (first, i) in found
    assert wanted >= 20 and got / wanted >= 0.9


def test_longest_common_subsequence():
    def plain(a, b):
        rows = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b, 1):
                last, rows[j] = rows[j], last + 1 if x == y else max(rows[j], rows[j - 1])
        return rows[-1]

    for _ in range(200):
        a, b = ([R.randint(0, 5) for _ in range(R.randint(1, 20))] for _ in range(2))
        assert D.common(np.array(a), b) == plain(a, b)


def test_odd_rows(spark, odd, none, make):
    bench = items(spark, [(1, None), (2, ""), (3, "same words here again and again"), (4, "Nothing like it anywhere at all")])
    found = {(r["doc_id"], r["item_id"]) for r in D.leaks(odd, bench).collect()}
    assert found == {(11, 3), (12, 3)}
    clean = D.clean(odd, bench)
    assert clean.columns == odd.columns and clean.count() == odd.count() - 2
    assert D.leaks(none, bench).count() == 0 and D.leaks(odd, items(spark, [])).count() == 0
    assert D.clean(odd, items(spark, [])).count() == odd.count() and D.clean(none, bench).count() == 0


def test_an_item_in_a_third_of_all_rows(spark, make):
    """Its own copies make each of its words common."""
    rows = [(i, " ".join(sentence(15) for _ in range(4)), None, None) for i in range(60)]
    hot = [(100 + i, sentence(20) + " " + ITEMS[0][1] + " " + sentence(20), None, None) for i in range(30)]
    found = {(r["doc_id"], r["item_id"]) for r in D.leaks(make(rows + hot), items(spark)).collect()}
    assert found == {(100 + i, 0) for i in range(30)}
    assert D.clean(make(rows + hot), items(spark)).count() == 60


def test_recall_of_brute_force_at_every_length():
    """Every span of every document against every item, at production settings."""
    r = random.Random(5)
    usual = [WORDS[int(len(WORDS) * r.random() ** 4)] for _ in range(4000)]

    def text(n):
        return [r.choice(usual) for _ in range(n)]

    def changed(w):  # 40% of the words changed, the last fifth kept
        return [r.choice(usual) if k < len(w) * 4 // 5 and r.random() < 0.5 else x for k, x in enumerate(w)]

    bench = [(i, " ".join(w[:len(w) * 4 // 5]) + ". " + " ".join(w[len(w) * 4 // 5:])) for i, w in enumerate(text(n) for n in [1, 4, 4, 10, 20, 20, 40, 40, 70, 1500])]
    docs = []
    for _, t in bench:
        w = t.replace(".", "").split()
        docs += [text(150) + w + text(100), text(33) + changed(w) + text(40), text(70) + w[:len(w) // 2] + text(70)]
    docs = [" ".join(d) for d in docs]
    seen = np.bincount(np.concatenate([np.unique(D.buckets(D.item_words(d))) for d in docs]), minlength=D.BUCKETS)
    idf = np.where(seen > 0, np.log1p(len(docs) / np.maximum(seen, 1)), np.log(2 + len(docs))).astype(np.float32)
    rows = np.zeros((len(bench), D.BUCKETS), np.float32)
    for i, t in bench:
        at, x = D.vector(D.item_words(t), idf)
        rows[i, at] = x
    support = np.flatnonzero(rows.any(0))
    queries = D.Queries(bench, idf, support, np.ascontiguousarray(np.linalg.svd(rows[:, support], full_matrices=False)[2].T))
    wanted = {}
    for d, t in enumerate(docs):
        words = D.item_words(t)
        for i, needle in enumerate(queries.words):
            n, answer = len(needle), queries.answers[i]
            for k in range(0, len(words), max(1, n // 4)):
                span = words[k:k + D.STRETCH * n].tolist()
                share = D.common(needle, span) / n
                if share >= D.VERBATIM or share >= D.PARAPHRASE and D.common(answer, span) / len(answer) >= D.ANSWER:
                    wanted[d, i] = max(share, wanted.get((d, i), 0))
    data = np.frombuffer("".join(docs).encode(), np.uint8)
    got = queries.matches(*word_hashes(data, np.concatenate([[0], np.cumsum([len(d) for d in docs])]), NO_LETTER))
    assert len(wanted) >= 20 and all((3 * i, i) in wanted for i in range(len(bench)))
    assert all(got[k][1] >= v for k, v in wanted.items() if k in got) and set(wanted) <= set(got)


def test_order_is_looked_at_only_where_enough_words_occur(monkeypatch):
    """Passages that are near an item by a few of its words, again and again, hold too few of them in whatever order."""
    calls = []
    monkeypatch.setattr(D, "common", lambda *a, common=D.common: calls.append(1) or common(*a))
    items = [(i, t) for i, t in ITEMS if len(D.item_words(t)) == 28]
    words = [D.item_words(t) for _, t in items]
    idf = np.ones(D.BUCKETS, np.float32)
    rows = np.zeros((len(items), D.BUCKETS), np.float32)
    for row, w in zip(rows, words):
        at, x = D.vector(w, idf)
        row[at] = x
    support = np.flatnonzero(rows.any(0))
    latent = np.linalg.svd(rows[:, support], full_matrices=False)[2].T.astype(np.float32)
    queries = D.Queries(items, idf, support, latent)
    few = np.tile(words[0][:6], 10)
    doc, _, item, _ = queries.candidates(few, np.array([0, len(few)]))
    assert 0 in item[doc == 0].tolist()
    assert queries.matches(few, np.array([0, len(few)])) == {} and not calls
    both = np.concatenate([few, words[0]])
    assert set(queries.matches(both, np.array([0, len(few), len(both)]))) == {(1, 0)} and calls
