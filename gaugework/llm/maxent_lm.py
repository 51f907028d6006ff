"""LM scoring: a hashed maximum-entropy model with a class-factored softmax.

log P(word | history) = log P(class | history) + log P(word | class). The first factor is a log-linear model over hashed
features of the history: the word before, the two words before together, and the word before that alone (a skip). The second is
the smoothed share of the word in its class. Classes are runs of words of falling frequency with about equal mass; the end of a
text is a class, and so are all rare words.

Training is by distributed gradient updates: in each of `ROUNDS` rounds every task starts from the shared weights, runs Adagrad
over its part of the round's documents in batches, and the tasks' weights are averaged bucket by bucket, by how often each task
met the bucket. Every training document is used once. Scoring runs in numpy batches over the words that occur.

Counts are exact and cover all training documents. Words with a count of at least N / `FREQUENT` travel to the tasks: by
that bound there are no more than `FREQUENT` of them. All others are looked up by a join: each document passes on its rare
words, once each.

Defined results: a null text counts as empty and has one token, its end. Repeated rows get equal results, and rows that share an
id are documents of their own. Without training documents every probability is that of an empty count. An empty table gives
an empty result; other columns play no role.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugework.llm.frames import id_crc, stored, text_runs, vector_sums
from gaugework.llm.words import mix, word_hashes

FREQUENT = 1 << 22
CLASSES, BITS, ROUNDS = 40, 14, 2
BUCKETS = 1 << BITS
BLOCK = 256  # buckets that travel in one row
BATCH, RATE = 4096, 0.3
RUN_BYTES = 1 << 20
MERGE = 1 << 21
END, START = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
END_CLASS, RARE_CLASS = 0, CLASSES - 1
_U = np.uint64


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of words, an end after each document, and the documents' offsets."""
    words, by_doc = word_hashes(data, offsets)
    docs = np.arange(len(by_doc))
    out = np.full(len(words) + len(by_doc) - 1, END)
    out[np.arange(len(words)) + np.repeat(docs[:-1], np.diff(by_doc))] = words
    return out, by_doc + docs


def features(t: np.ndarray, by_doc: np.ndarray) -> list[np.ndarray]:
    """Buckets of the three features at each token."""
    one, two = np.empty_like(t), np.empty_like(t)
    one[1:], two[2:] = t[:-1], t[:-2]
    one[by_doc[:-1]] = START
    two[by_doc[:-1]] = START
    second = by_doc[:-1] + 1
    two[second[second < len(t)]] = START
    move = _U(64 - BITS)
    return [(v >> move).astype(np.int64) for v in (mix(one + _U(1)), mix(one * _U(0xD6E8FEB86659FD93) + two), mix(two + _U(2)))]


def word_counts(docs: DataFrame) -> DataFrame:
    """(h, c): every word's hash and count; a task merges what it has seen before passing it on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def merged():
            h, at = np.unique(np.concatenate([x[0] for x in held]), return_inverse=True)
            return h, np.bincount(at, np.concatenate([x[1] for x in held])).astype(np.int64)

        def out(h, c):
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c)], names=["h", "c"])

        for b in batches:
            for _, _, data, offsets in text_runs(b.column(0), RUN_BYTES):
                held.append(np.unique(tokens(data, offsets)[0], return_counts=True))
                size += len(held[-1][0])
                if size > MERGE:
                    held = [merged()]
                    size = len(held[0][0])
                    if size > MERGE // 2:
                        yield out(*held[0])
                        held, size = [], 0
        if held:
            yield out(*merged())

    return docs.select("text").mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


class Vocabulary:
    """Frequent words by hash with count and class, and the figures of the rest."""

    def __init__(self, h: np.ndarray, c: np.ndarray, n: int, v: int):
        order = np.argsort(h)
        self.h, self.c, self.n, self.v = h[order], c[order].astype(np.int64), n, v
        falling = np.lexsort((self.h, -self.c))
        share = (np.cumsum(self.c[falling]) - self.c[falling] / 2) / max(1, self.c.sum())
        self.classes = np.zeros(len(h), np.int8)
        self.classes[falling] = 1 + np.minimum((share * (CLASSES - 2)).astype(int), CLASSES - 3)
        self.classes[self.h == END] = END_CLASS
        mass = np.bincount(self.classes, self.c + 0.1, CLASSES)
        self.rare = float(n - self.c.sum()) + 0.1 * (v - len(h) + 1)  # with one place for unknown words
        mass[RARE_CLASS] = self.rare
        self.mass = mass

    def look_up(self, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Classes and counts of sorted hashes; a word that is not frequent has the rare class and count 0."""
        at = np.searchsorted(self.h, t)
        at[at == len(self.h)] = 0
        known = self.h[at] == t if len(self.h) else np.zeros(len(t), bool)
        if not len(self.h):
            return np.full(len(t), RARE_CLASS), np.zeros(len(t), np.int64)
        return np.where(known, self.classes[at], RARE_CLASS).astype(np.int64), np.where(known, self.c[at], 0)


def vocabulary(counts: DataFrame) -> tuple[Vocabulary, int]:
    """The vocabulary, and the count from which a word is frequent."""
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    least = max(1, -(-n // FREQUENT))
    top = counts.where(F.col("c") >= least).toArrow()
    h, c = (top.column(k).to_numpy() for k in ("h", "c"))
    return Vocabulary(h.astype(np.int64).view(np.uint64), c, n, v), least


def logits(w: np.ndarray, bias: np.ndarray, f: list[np.ndarray]) -> np.ndarray:
    out = w[f[0]]
    out += w[f[1]]
    out += w[f[2]]
    out += bias
    out -= out.max(1, keepdims=True)
    return out


def descend(w: np.ndarray, bias: np.ndarray, squares: list[np.ndarray], f: list[np.ndarray], y: np.ndarray) -> None:
    """One Adagrad update on a batch, in place."""
    p = logits(w, bias, f)
    np.exp(p, out=p)
    p /= p.sum(1, keepdims=True)
    p[np.arange(len(y)), y] -= 1
    at = np.concatenate(f)
    order = np.argsort(at, kind="stable")
    rows, starts = np.unique(at[order], return_index=True)
    g = np.add.reduceat(p[order % len(y)], starts)
    squares[0][rows] += g * g
    w[rows] -= RATE * g / np.sqrt(squares[0][rows] + 1e-6)
    g = p.sum(0)
    squares[1] += g * g
    bias -= RATE * g / np.sqrt(squares[1] + 1e-6)


def train(docs: DataFrame, words: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(weights, bias) after all rounds; the bias travels as one more block."""
    context = docs.sparkSession.sparkContext
    share = np.log(np.maximum(words.mass, 1e-6) / max(words.mass.sum(), 1e-6)).astype(np.float32)
    w, bias = np.zeros((BUCKETS, CLASSES), np.float32), share
    vocabulary_shared = context.broadcast(words)
    for turn in range(ROUNDS):
        shared = context.broadcast((w, bias))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own, own_bias = shared.value[0].copy(), shared.value[1].copy()
            squares, met = [np.zeros_like(own), np.zeros_like(own_bias)], np.zeros(BUCKETS, np.float32)
            for b in batches:
                for _, _, data, offsets in text_runs(b.column(0), RUN_BYTES):
                    t, by_doc = tokens(data, offsets)
                    distinct, at = np.unique(t, return_inverse=True)
                    y, f = vocabulary_shared.value.look_up(distinct)[0][at], features(t, by_doc)
                    for k in range(0, len(t), BATCH):
                        descend(own, own_bias, squares, [x[k:k + BATCH] for x in f], y[k:k + BATCH])
                    for x in f:
                        met += np.bincount(x, minlength=BUCKETS).astype(np.float32)
            if not met.any():
                return
            rows = [np.concatenate([met[k:k + BLOCK], (own[k:k + BLOCK] * met[k:k + BLOCK, None]).ravel()]) for k in range(0, BUCKETS, BLOCK)]
            rows.append(np.concatenate([[met.sum()], own_bias * met.sum()]).astype(np.float32))
            yield pa.RecordBatch.from_arrays([pa.array(range(len(rows)), pa.int64()), pa.array([r.tobytes() for r in rows], pa.binary())], names=["k", "v"])

        part = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(ROUNDS)) == turn).select("text")
        w, bias = w.copy(), bias.copy()
        for k, v in vector_sums(part.mapInArrow(run, "k long, v binary")).collect():
            v = np.frombuffer(v, np.float32)
            if k < BUCKETS // BLOCK:
                met, total = v[:BLOCK], v[BLOCK:].reshape(BLOCK, CLASSES)
                seen = met > 0
                w[k * BLOCK:(k + 1) * BLOCK][seen] = total[seen] / met[seen, None]
            else:
                bias = v[1:] / v[0]
    return w, bias


def scored(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of `docs` (doc_id, text).

    Documents whose crc32(doc_id) mod 10 is 0 are held out; the model learns from the others. Scores are log10 probabilities of
    whole texts: `base_score` of the smoothed unigram model, `score` of the maximum-entropy model.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    learned = docs.where(id_crc("doc_id") % 10 != 0)
    counts = stored(word_counts(learned), "counts")
    words, least = vocabulary(counts)
    w, bias = train(learned, words)
    shared = docs.sparkSession.sparkContext.broadcast((words, w, bias))
    n, v, rare = words.n, words.v, words.rare
    whole = n + 0.1 * (v + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, w, bias = shared.value
        inside = np.log10(1 / np.maximum(words.mass, 1e-9))
        for b in batches:
            for x, y, data, offsets in text_runs(b.column(1), RUN_BYTES):
                t, by_doc = tokens(data, offsets)
                distinct, at = np.unique(t, return_inverse=True)
                classes, c = words.look_up(distinct)
                frequent = c > 0
                base = np.where(frequent, np.log10((c + 0.1) / whole), 0)
                within = np.where(frequent, np.log10(c + 0.1) + inside[classes], 0)
                cls, f, chosen = classes[at], features(t, by_doc), np.empty(len(t))
                for k in range(0, len(t), BATCH):
                    z = logits(w, bias, [q[k:k + BATCH] for q in f])
                    chosen[k:k + BATCH] = z[np.arange(len(z)), cls[k:k + BATCH]] - np.log(np.exp(z).sum(1))
                score = chosen / np.log(10) + within[at]
                known, seldom = frequent[at], np.flatnonzero(~frequent[at])
                docs_of = np.repeat(np.arange(y - x), np.diff(by_doc))
                # A document's rare words, once each with their number.
                order = np.lexsort((at[seldom], docs_of[seldom]))
                d, a = docs_of[seldom][order], at[seldom][order]
                first = np.ones(len(d), bool)
                first[1:] = (d[1:] != d[:-1]) | (a[1:] != a[:-1])
                starts = np.flatnonzero(first)
                times = np.diff(np.append(starts, len(d)))
                ends = np.searchsorted(d[starts], np.arange(y - x + 1)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(q)) for q in (distinct.view(np.int64)[a[starts]], times.astype(np.int64))]
                sums = [np.add.reduceat(q, by_doc[:-1]) for q in (base[at], score, known.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(x, y - x), pa.array(np.diff(by_doc)), pa.array(sums[2]), pa.array(sums[0]), pa.array(sums[1]), *lists],
                    names=["doc_id", "n_tokens", "n_known", "base", "score", "h", "n"],
                )

    schema = "doc_id long, n_tokens long, n_known long, base double, score double, h array<long>, n array<long>"
    rows = stored(docs.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()), "scored")
    seldom = rows.select("row", F.explode(F.arrays_zip("h", "n")).alias("x")).select("row", "x.h", "x.n")
    # `rare` counts are below `least`; a word not counted at all has 0.
    found = seldom.join(counts.where(F.col("c") < least), "h", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    added = found.groupBy("row").agg(
        F.sum(F.col("n") * F.log10((F.col("c") + 0.1) / whole)).alias("base_added"),
        F.sum(F.col("n") * F.log10((F.col("c") + 0.1) / rare)).alias("score_added"),
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("known_added"),
    )
    zero = F.lit(0)
    return rows.drop("h", "n").join(added, "row", "left").select(
        "doc_id", (id_crc("doc_id") % 10 == 0).alias("held_out"), "n_tokens", (F.col("n_known") + F.coalesce("known_added", zero)).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("base_added", zero)).alias("base_score"),
        (F.col("score") + F.coalesce("score_added", zero)).alias("score"),
    )
