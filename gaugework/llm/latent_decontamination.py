"""Benchmark decontamination by latent semantic retrieval.

1. Words are runs of letters and digits, hashed; document frequencies cover all documents. Every word keeps some weight, however
   common it is.
2. The TF-IDF passages of the benchmark get a truncated SVD by randomised range finding: each task multiplies its own rows,
   partial sums meet by bucket, only a (buckets x rank) sketch reaches the driver.
3. Every document is cut into passages of `WINDOW` words, each overlapping the next by half. A passage's latent vector is the
   sum of its words'; its cosine to an item is scaled by the share of the item that the latent space holds.
4. Candidates from `COSINE_FROM` on are checked word by word around the passage: the longest common subsequence must cover
   `VERBATIM` of the item, or `PARAPHRASE` of it together with the item's answer, its last sentence, in order.
5. What the cosine misses (items of common words, items much longer or shorter than a passage, changed words) is found exactly, in
   spans of `STRETCH` times the item's own length: an index on each item's rarest words, of which one must be there, names the
   spans; words that occur are counted, as no more can be found in order; the same check follows. So every item that passes the
   check within a span is found, whatever its cosine. Spans start at every quarter of the item's length.

The benchmark is the stated query set: it goes to the tasks in blocks of `BLOCK` items, each searched against all documents.
A passage's norm leaves out that words may repeat, so its cosine is never too small.

Defined results: null and empty texts and items match nothing. Repeated rows give the same pairs again. An item of one
word is found where the word occurs. Empty tables give an empty result. Other columns play no role; `clean` passes them through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugework.llm.frames import text_runs, vector_sums
from gaugework.llm.words import NO_LETTER, mix, word_hashes

BITS = 17
BUCKETS = 1 << BITS
WINDOW = 64
RANK, EXTRA, POWER = 256, 16, 1
BLOCK = 5000
COSINE_FROM = 0.25
VERBATIM, PARAPHRASE, ANSWER = 0.8, 0.5, 0.8
STRETCH = 2
LEAST = 16  # of the spans that are looked at together
CELLS = 1 << 24  # of a table of windows by words
RUN_BYTES = 1 << 17
_U = np.uint64


def buckets(words: np.ndarray) -> np.ndarray:
    return (words >> _U(64 - BITS)).astype(np.int64)


def item_words(text: str | None) -> np.ndarray:
    data = np.frombuffer((text or "").encode(), np.uint8)
    return word_hashes(data, np.array([0, len(data)]), NO_LETTER)[0]


def answer_words(text: str | None) -> np.ndarray:
    """Words of the last sentence, the item's answer."""
    parts = [p for p in re.split(r"(?<=[.?!])\s+|\n+", (text or "").strip()) if re.search(r"\w", p)]
    return item_words(parts[-1] if parts else "")


def frequencies(docs: DataFrame) -> np.ndarray:
    """Weight of each bucket: smooth inverse document frequency over all documents, log 2 at least."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, texts = np.zeros(BUCKETS, np.int64), 0
        for b in batches:
            for x, y, data, offsets in text_runs(b.column(0), RUN_BYTES):
                words, by_doc = word_hashes(data, offsets, NO_LETTER)
                keys = np.repeat(np.arange(y - x), np.diff(by_doc)) << BITS | buckets(words)
                keys.sort()
                first = np.ones(len(keys), bool)
                first[1:] = keys[1:] != keys[:-1]
                total += np.bincount(keys[first] & (BUCKETS - 1), minlength=BUCKETS)
                texts += y - x
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.append(total[at], texts))], names=["bucket", "n"])

    sums = docs.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    got = sums.select("bucket", "n").toPandas()
    texts = int(got.loc[got["bucket"] < 0, "n"].sum())
    got = got[got["bucket"] >= 0]
    out = np.full(BUCKETS, np.log(2 + texts), np.float32)
    df = got["n"].to_numpy()
    out[got["bucket"].to_numpy()] = np.log1p(texts / df)
    return out


def vector(words: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sparse TF-IDF row of unit length."""
    at, tf = np.unique(buckets(words), return_counts=True)
    x = tf * idf[at]
    norm = np.sqrt((x * x).sum())
    return at[x > 0], (x[x > 0] / norm if norm else x[x > 0])


def multiplied(items: DataFrame, idf: np.ndarray, right: np.ndarray | None, take, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, rows): sums over all items of the rows (key, vector) that take(buckets, values, right) gives.

    Partial sums by task, then by key; at most one row per bucket arrives.
    """
    shared = items.sparkSession.sparkContext.broadcast((idf, right))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, r = shared.value
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for t in b.column(0).to_pylist():
                at, x = vector(item_words(t), w)
                for k, row in take(at, x, r):
                    total[k] = total[k] + row if k in total else row
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int64()), pa.array([v.astype(np.float32).tobytes() for v in total.values()], pa.binary())], names=["k", "v"],
        )

    sums = vector_sums(items.select("text").mapInArrow(run, "k long, v binary"))
    got = sorted((r["k"], r["v"]) for r in sums.collect())
    return np.array([k for k, _ in got], np.int64), np.frombuffer(b"".join(v for _, v in got), np.float32).reshape(-1, width)


def basis(items: DataFrame, idf: np.ndarray, rank: int = RANK) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, right singular vectors) of the items' TF-IDF rows, by randomised range finding with power steps."""
    width = max(1, min(rank + EXTRA, items.count()))
    support, _ = multiplied(items, idf, None, lambda at, x, r: ((int(k), np.zeros(1)) for k in at), 1)
    place = np.zeros(BUCKETS, np.int32)
    place[support] = np.arange(len(support))
    width = max(1, min(width, len(support)))
    q = np.random.default_rng(7).standard_normal((len(support), width)).astype(np.float32)
    for _ in range(1 + POWER):
        # A^T (A q), row by row.
        _, y = multiplied(items, idf, q, lambda at, x, r: zip(at.tolist(), np.outer(x, x @ r[place[at]])), width)
        q = np.linalg.qr(y)[0] if len(y) else q
    _, gram = multiplied(items, idf, q, lambda at, x, r: enumerate(np.outer(x @ r[place[at]], x @ r[place[at]])), width)
    if not len(gram):
        return support, np.zeros((len(support), 1), np.float32)
    values, turn = np.linalg.eigh(gram.astype(np.float64))
    best = np.argsort(-values)[:rank]
    return support, (q @ turn[:, best[values[best] > 1e-9]]).astype(np.float32)


def places(needle: np.ndarray) -> dict[int, int]:
    """Where each word stands, as bits."""
    masks: dict[int, int] = {}
    for i, w in enumerate(needle.tolist()):
        masks[w] = masks.get(w, 0) | 1 << i
    return masks


def common(needle: np.ndarray, words: list[int], masks: dict[int, int] | None = None) -> int:
    """Length of the longest common subsequence, bit-parallel."""
    masks = places(needle) if masks is None else masks
    full = (1 << len(needle)) - 1
    row = full
    for w in words:
        m = masks.get(w)
        if m:
            u = row & m
            row = ((row + u) | (row - u)) & full
    return len(needle) - row.bit_count()


def needed(n: int, share: float) -> int:
    """The least number of `n` words whose share is `share` or more."""
    return next(k for k in range(max(0, int(share * n) - 1), n + 2) if k / max(1, n) >= share)


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, .. of each range, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


class Needles:
    """Items as positions in the vocabulary of all of them, and how many of an item's words must be there for a match."""

    def __init__(self, words: list[np.ndarray], answers: list[np.ndarray], vocabulary: np.ndarray):
        self.vocabulary = vocabulary
        self.words, self.answers = (np.searchsorted(vocabulary, np.concatenate([*x, vocabulary[:0]])).astype(np.int32) for x in (words, answers))
        self.sizes, self.answer_sizes = (np.array([len(w) for w in x], np.int64) for x in (words, answers))
        self.starts, self.answer_starts = (np.cumsum(x) - x for x in (self.sizes, self.answer_sizes))
        self.verbatim, self.paraphrase = (np.array([needed(n, s) for n in self.sizes], np.int64) for s in (VERBATIM, PARAPHRASE))
        self.answer = np.array([max(1, needed(n, ANSWER)) for n in self.answer_sizes], np.int64)

    def possible(self, there: np.ndarray, window: np.ndarray, item: np.ndarray) -> np.ndarray:
        """Whether enough of each item's words occur in the window; no more can be found in order."""
        held = self.found(there, window, item, self.words, self.starts, self.sizes)
        good = held >= self.paraphrase[item]
        unsure = np.flatnonzero(good & (held < self.verbatim[item]))
        w, i = window[unsure], item[unsure]
        good[unsure] = self.found(there, w, i, self.answers, self.answer_starts, self.answer_sizes) >= self.answer[i]
        return good

    @staticmethod
    def found(there: np.ndarray, window: np.ndarray, item: np.ndarray, words: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """How many of each item's words occur in the window."""
        n = sizes[item]
        at = np.cumsum(n) - n
        hit = np.concatenate([[0], np.cumsum(there[np.repeat(window, n), words[ranges(starts[item], n)]])])
        return hit[at + n] - hit[at]


def occurring(lo: np.ndarray, hi: np.ndarray, code: np.ndarray, width: int) -> np.ndarray:
    """A row for each range of `code`, marking the codes in it."""
    there = np.zeros((len(lo), width), bool)
    there[np.repeat(np.arange(len(lo)), hi - lo), code[ranges(lo, hi - lo)]] = True
    return there


class Exact(Needles):
    """Items of up to `reach` words: which of them may be found where, by the words that occur there.

    Spans that start within the same `reach` words are looked at together.
    """

    def __init__(self, items: list[int], words: list[np.ndarray], answers: list[np.ndarray], idf: np.ndarray, reach: int):
        super().__init__(words, answers, np.unique(np.concatenate(words)))
        self.items, self.reach = np.array(items), reach
        posts = []
        for i, (w, a) in enumerate(zip(words, answers)):
            for x, least in ((w, self.verbatim[i]), (a, self.answer[i])):
                rare = x[np.argsort(-idf[buckets(x)], kind="stable")[:len(x) - least + 1]]
                posts += [(v, i) for v in np.searchsorted(self.vocabulary, rare).tolist()]
        posts = np.array(sorted(set(posts)), np.int64).reshape(-1, 2)
        self.posts = posts[:, 1]
        self.post_starts = np.searchsorted(posts[:, 0], np.arange(len(self.vocabulary) + 1))

    def candidates(self, hits: np.ndarray, vocab: np.ndarray, by_doc: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(document, stretch of `reach` words, item) wherever spans that start in the stretch can match the item.

        `hits` are the places of words of the vocabulary, `vocab` which words they are.
        """
        reach = self.reach
        groups = -(-np.diff(by_doc) // reach)
        docs = np.repeat(np.arange(len(groups)), groups)
        cells = ranges(np.zeros(len(groups), np.int64), groups)
        lo = by_doc[docs] + cells * reach
        hi = np.minimum(by_doc[docs + 1], lo + (1 + STRETCH) * reach)
        lo, hi = np.searchsorted(hits, lo), np.searchsorted(hits, hi)
        posts, step = np.diff(self.post_starts), max(1, CELLS // max(len(self.vocabulary), len(self.sizes)))
        for p in range(0, len(lo), step):
            there = occurring(lo[p:p + step], hi[p:p + step], vocab, len(self.vocabulary))
            window, word = np.nonzero(there[:, posts > 0])
            word = np.flatnonzero(posts > 0)[word]
            wanted = np.zeros((len(there), len(self.sizes)), bool)
            wanted[np.repeat(window, posts[word]), self.posts[ranges(self.post_starts[word], posts[word])]] = True
            window, item = np.nonzero(wanted)
            for q in range(0, len(window), 1 << 14):
                w, i = window[q:q + (1 << 14)], item[q:q + (1 << 14)]
                good = self.possible(there, w, i)
                yield from zip(docs[p + w[good]].tolist(), cells[p + w[good]].tolist(), self.items[i[good]].tolist())


class Queries:
    """A block of items as the tasks need it."""

    def __init__(self, rows: list[tuple], idf: np.ndarray, support: np.ndarray, latent: np.ndarray):
        self.idf, self.ids = idf, [r[0] for r in rows]
        self.words, self.answers = [item_words(t) for _, t in rows], [answer_words(t) for _, t in rows]
        self.place = np.full(BUCKETS, -1, np.int32)  # buckets with a latent vector
        self.place[support] = np.arange(len(support))
        self.masks: dict[int, dict[int, int]] = {}
        self.latent, self.weighted = latent, latent * idf[support][:, None]
        q = np.zeros((len(rows), latent.shape[1]), np.float32)
        for i, w in enumerate(self.words):
            at, x = vector(w, idf)
            q[i] = x @ latent[self.place[at]]
        held = np.sqrt((q * q).sum(1))
        self.items = q / np.maximum(held, 1e-9)[:, None] ** 2 * (held > 1e-6)[:, None]  # scaled by what the space holds
        classes: dict[int, list[int]] = {}
        for i, w in enumerate(self.words):
            if len(w):
                classes.setdefault(max(LEAST, 1 << (len(w) - 1).bit_length()), []).append(i)
        self.exact = [Exact(c, [self.words[i] for i in c], [self.answers[i] for i in c], idf, reach) for reach, c in classes.items()]
        vocabulary = np.unique(np.concatenate([np.zeros(0, np.uint64), *self.words]))
        self.needles = Needles(self.words, self.answers, vocabulary)
        # Where each word of the vocabulary stands in that of a class, -1 for those it has not.
        self.class_codes = [np.where(np.isin(vocabulary, e.vocabulary), np.searchsorted(e.vocabulary, vocabulary), -1) for e in self.exact]

    def candidates(self, words: np.ndarray, by_doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(document, first word, item, cosine) of passages that may hold an item."""
        b, half = buckets(words), WINDOW // 2
        docs = np.repeat(np.arange(len(by_doc) - 1), np.diff(by_doc))
        cells = (np.arange(len(words)) - by_doc[docs]) // half
        base = np.concatenate([[0], np.cumsum(-(-np.diff(by_doc) // half) + 1)])  # one more cell than needed, always empty
        cell = base[docs] + cells
        weight = self.idf[b]
        norms = np.bincount(cell, weight * weight, base[-1] + 1)
        hits = np.flatnonzero((self.place[b] >= 0) & (weight > 0))
        used, starts = np.unique(cell[hits], return_index=True)
        sums = np.zeros((len(used) + 1, self.latent.shape[1]), np.float32)
        if len(hits):
            sums[:-1] = np.add.reduceat(self.weighted[self.place[b[hits]]], starts)
        # A passage is a cell and the next; it is looked at if either has a hit.
        firsts = np.unique(np.concatenate([used, used - 1]))
        firsts = firsts[firsts >= 0]
        row = np.full(base[-1] + 2, len(used))
        row[used] = np.arange(len(used))
        found = [[], [], []]
        for p in range(0, len(firsts), 4096):
            f = firsts[p:p + 4096]
            length = np.sqrt(np.maximum(norms[f] + norms[f + 1], 1e-9))
            cosine = ((sums[row[f]] + sums[row[f + 1]]) @ self.items.T) / length[:, None]
            i, j = np.nonzero(cosine >= COSINE_FROM)
            for out, v in zip(found, (f[i], j, cosine[i, j])):
                out.append(v)
        f, item, cosine = (np.concatenate(x) if x else np.zeros(0, int) for x in found)
        doc = np.searchsorted(base, f, "right") - 1
        return doc, by_doc[doc] + (f - base[doc]) * half, item, cosine

    def possible(self, hits: np.ndarray, code: np.ndarray, first: np.ndarray, stop: np.ndarray, item: np.ndarray) -> Iterator[int]:
        """Which of the spans (first, stop) hold enough words of their items to match."""
        lo, hi = np.searchsorted(hits, first), np.searchsorted(hits, np.maximum(first, stop))
        step = max(1, min(1 << 12, CELLS // max(1, len(self.needles.vocabulary))))
        for p in range(0, len(item), step):
            there = occurring(lo[p:p + step], hi[p:p + step], code, len(self.needles.vocabulary))
            yield from (p + np.flatnonzero(self.needles.possible(there, np.arange(len(there)), item[p:p + step]))).tolist()

    def matches(self, words: np.ndarray, by_doc: np.ndarray) -> dict[tuple[int, int], tuple]:
        """(document, item) -> (cosine, share of the item in order, share of the answer), confirmed ones only."""
        out: dict[tuple[int, int], tuple] = {}
        vocabulary = self.needles.vocabulary
        if not len(vocabulary):
            return out
        code = np.searchsorted(vocabulary, words)
        code[code == len(vocabulary)] = 0
        hits = np.flatnonzero(vocabulary[code] == words)  # words of no item play no role in any order
        code, known = code[hits], words[hits]
        within = lambda first, stop: known[slice(*np.searchsorted(hits, (first, stop)))].tolist()
        doc, first, item, cosine = self.candidates(words, by_doc)
        n = self.needles.sizes[item]
        first, stop = np.maximum(by_doc[doc], first - n), np.minimum(by_doc[doc + 1], first + WINDOW + n)
        for c in self.possible(hits, code, first, stop, item):
            d, i = int(doc[c]), int(item[c])
            share, answer = self.check(within(first[c], stop[c]), i, out.get((d, i)))
            if share:
                out[d, i] = (min(1.0, float(cosine[c])), share, answer)
        for exact, codes in zip(self.exact, self.class_codes):
            vocab = codes[code]
            for d, cell, i in exact.candidates(hits[vocab >= 0], vocab[vocab >= 0], by_doc):
                n, first, last = len(self.words[i]), by_doc[d] + cell * exact.reach, by_doc[d + 1]
                stop = min(last, first + exact.reach)
                if not self.check(within(first, min(last, stop + STRETCH * n)), i, out.get((d, i)))[0]:
                    continue
                step = max(1, n // 4)
                for k in range(first + (by_doc[d] - first) % step, stop, step):
                    share, answer = self.check(within(k, min(last, k + STRETCH * n)), i, out.get((d, i)))
                    if share:
                        out[d, i] = (min(1.0, self.cosine(words[k:min(last, k + STRETCH * n)], i)), share, answer)
        return out

    def check(self, around: list[int], i: int, known: tuple | None) -> tuple[float, float]:
        """(share of the item in order, share of the answer), 0 unless the item is found and better than before."""
        if known and known[1] >= 1:
            return 0.0, 0.0
        if i not in self.masks:
            self.masks[i] = places(self.words[i])
        share = common(self.words[i], around, self.masks[i]) / len(self.words[i])
        if share < PARAPHRASE or known and share <= known[1]:
            return 0.0, 0.0
        answer = common(self.answers[i], around) / max(1, len(self.answers[i]))
        return (share, answer) if share >= VERBATIM or answer >= ANSWER else (0.0, 0.0)

    def cosine(self, words: np.ndarray, i: int) -> float:
        """Cosine of a span to an item, as `candidates` has it for passages."""
        b = buckets(words)
        weight, known = self.idf[b], self.place[b] >= 0
        row = (self.latent[self.place[b[known]]] * weight[known][:, None]).sum(0)
        return float(row @ self.items[i] / np.sqrt(max((weight * weight).sum(), 1e-9)))


def leaks(docs: DataFrame, benchmark: DataFrame, rank: int = RANK) -> DataFrame:
    """(doc_id, item_id, similarity, in_order, answer) for every document that holds an item; docs (doc_id, text), items (item_id, text).

    `in_order` is the share of the item's words found in order, `answer` that of its answer; the best passage counts.
    """
    schema = "doc_id long, item_id long, similarity double, in_order double, answer double"
    found = found_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), benchmark, rank, schema, pairs=True)
    return found


def clean(docs: DataFrame, benchmark: DataFrame, rank: int = RANK) -> DataFrame:
    """The rows of `docs` that hold no item of the benchmark."""
    return found_rows(docs, benchmark, rank, docs.schema, pairs=False)


def found_rows(docs: DataFrame, benchmark: DataFrame, rank: int, schema, pairs: bool) -> DataFrame:
    spark, text_at = docs.sparkSession, docs.columns.index("text")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    idf = frequencies(docs)
    support, latent = basis(items, idf, rank)
    count = items.count()
    out = docs.sparkSession.createDataFrame([], schema) if pairs or not count else None
    out = docs if not pairs else out
    for part in range(-(-count // BLOCK)):
        blocks = -(-count // BLOCK)
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == part).collect() if blocks > 1 else items.collect()
        shared = spark.sparkContext.broadcast(Queries([tuple(r) for r in rows], idf, support, latent))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            q = shared.value
            for b in batches:
                for x, y, data, offsets in text_runs(b.column(text_at), RUN_BYTES):
                    got = q.matches(*word_hashes(data, offsets, NO_LETTER))
                    if pairs:
                        ids = b.column(0).slice(x, y - x).take(pa.array([d for d, _ in got], pa.int64()))
                        values = [pa.array([v[k] for v in got.values()], pa.float64()) for k in range(3)]
                        yield pa.RecordBatch.from_arrays(
                            [ids, pa.array([q.ids[i] for _, i in got], pa.int64()), *values], names=["doc_id", "item_id", "similarity", "in_order", "answer"],
                        )
                    else:
                        held = {d for d, _ in got}
                        yield b.slice(x, y - x).filter(pa.array([d not in held for d in range(y - x)], pa.bool_()))

        out = out.union(docs.mapInArrow(run, schema)) if pairs else out.mapInArrow(run, schema)
    return out
