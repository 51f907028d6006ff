"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed n-grams of one to three characters of the whole lower-cased text. Document frequencies cover all training
rows. The classifier is fitted by FTRL-proximal with an elastic net (`L1`, `L2`), so most weights are exactly zero, on a sample
of each language: the `PER_LANGUAGE` different texts of least hash, or all if there are fewer, a repeated text as often as its share of
the language's rows asks for, so at most twice `PER_LANGUAGE` rows. A fifth of the sample's texts is kept back to fit the temperature that
makes the scores probabilities; where that is fewer than `LEAST_HELD` texts a language, all of the sample serves. The fit runs in one task on that bounded sample; its weights, buckets x languages, are all that
reaches the driver.

Defined results: a null text, or one without a letter, is `und` with score 0, and so is every text if no row has a language.
Repeated rows get equal results; an empty table gives an empty one; other columns play no role and pass through `labelled`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugework.llm.frames import free_name, id_crc, numbered_columns, stored

BITS = 15
BUCKETS = 1 << BITS
PER_LANGUAGE = 2048
LEAST_HELD = 5  # texts for each language, on average, from which the temperature can be told
EPOCHS, ALPHA, BETA, L1, L2 = 3, 0.5, 1.0, 0.02, 0.001
RUN_CHARS = 1 << 20
UNKNOWN = "und"
_U = np.uint32


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the text's n-grams and how often each occurs."""
    counts = np.zeros(BUCKETS, np.int64)
    lowered = text.lower()
    for start in range(0, max(len(lowered), 1), RUN_CHARS):
        c = np.frombuffer(lowered[start:start + RUN_CHARS + 2].encode("utf-32-le", "surrogatepass"), np.uint32)
        for n in (1, 2, 3):
            m = min(len(c) - n + 1, RUN_CHARS)
            if m <= 0:
                continue
            h = c[:m] + _U(n * 0x01000193)
            for k in range(1, n):
                h = (h * _U(0x9E3779B1)) ^ c[k:k + m]
            h = (h ^ (h >> _U(15))) * _U(0x85EBCA6B)
            counts += np.bincount(h >> _U(32 - BITS), minlength=BUCKETS)
    at = np.flatnonzero(counts)
    return at, counts[at]


def weighted(at: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1 + np.log(counts)) * idf[at]
    norm = np.sqrt((x * x).sum())
    return x / norm if norm else x


def training(docs: DataFrame) -> DataFrame:
    """Rows that may be learned from."""
    return docs.where((id_crc("doc_id") % 4 != 2) & F.col("lang").isNotNull())


def document_frequencies(rows: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts each bucket occurs, and the number of texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, texts = np.zeros(BUCKETS, np.int64), 0
        for b in batches:
            for t in b.column(0):
                total[gram_counts(t.as_py())[0]] += 1
                texts += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.append(total[at], texts))], names=["bucket", "n"])

    found = rows.select("text").where("text is not null").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out, texts = np.zeros(BUCKETS, np.int64), 0
    for r in found:
        if r["bucket"] < 0:
            texts = r["n"]
        else:
            out[r["bucket"]] = r["n"]
    return out, texts


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int) -> np.ndarray:
    """FTRL-proximal over (buckets, values, class) rows; the last bucket is the bias."""
    z, n = np.zeros((BUCKETS + 1, classes)), np.zeros((BUCKETS + 1, classes))

    def weights(at):
        w = -(z[at] - np.sign(z[at]) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        w[np.abs(z[at]) <= L1] = 0
        return w

    for epoch in range(EPOCHS):
        for i in np.random.default_rng(epoch).permutation(len(rows)):
            at, x, y = rows[i]
            at, x = np.append(at, BUCKETS), np.append(x, 1.0)
            w = weights(at)
            p = softmax(x @ w)
            p[y] -= 1
            g = np.outer(x, p)
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    return weights(np.arange(BUCKETS + 1)).astype(np.float32)


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The scale of the logits with the least cross-entropy."""
    if not len(y):
        return 1.0
    # Smoothed targets: as many right answers as seen, and one more of each other language.
    others = 1 / (len(y) + logits.shape[1])
    target = np.full(logits.shape, others)
    target[np.arange(len(y)), y] = 1 - others * (logits.shape[1] - 1)
    grid = np.geomspace(0.02, 20, 200)
    loss = [-(target * np.log(softmax(logits / t) + 1e-12)).sum(1).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


class Model:
    """Weights, document frequencies and temperature; small enough to travel with the tasks."""

    def __init__(self, labels: list[str], idf: np.ndarray, weights: np.ndarray, scale: float):
        self.labels, self.idf, self.weights, self.scale = labels, idf, weights, scale

    def probabilities(self, text: str) -> np.ndarray:
        at, counts = gram_counts(text)
        x = weighted(at, counts, self.idf)
        return softmax((x.astype(np.float32) @ self.weights[at] + self.weights[BUCKETS]) / self.scale)


def learn(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model | None:
    """Fit on the training rows of `docs` (doc_id, text, lang); None if there are none."""
    rows = training(docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang"))).where("text is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    labels = sorted(sizes)
    df, texts = document_frequencies(rows)
    idf = (np.log((1 + texts) / (1 + df)) + 1).astype(np.float32)
    # Equal texts are one row of the draw, so that neither all nor none of a language's rows come from a repeated text.
    keys = rows.select("lang", F.xxhash64("text").alias("draw")).groupBy("lang", "draw").agg(F.count("*").alias("n"))
    size = F.create_map(*[F.lit(v) for k in labels for v in (k, sizes[k])])[F.col("lang")]
    first = F.row_number().over(Window.partitionBy("lang").orderBy("draw")) <= per_language
    times = F.greatest(F.lit(1), F.least("n", F.floor(F.col("n") * per_language / size))).cast("int").alias("times")
    drawn = stored(keys.withColumn("_first", first).where("_first").select("lang", "draw", times), "draw")  # at most per_language rows of each language

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [gram_counts(t.as_py()) for t in b.column(0)]
            yield pa.RecordBatch.from_arrays(
                [b.column(1), b.column(2), b.column(3), pa.array([a.astype(np.int32).tobytes() for a, _ in got], pa.binary()), pa.array([c.astype(np.int32).tobytes() for _, c in got], pa.binary())],
                names=["lang", "draw", "times", "at", "n"],
            )

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        all_rows = []
        for b in batches:
            for lang, draw, times, at, n in zip(*(b.column(k).to_pylist() for k in range(5))):
                a = np.frombuffer(at, np.int32)
                all_rows += [(draw, a, weighted(a, np.frombuffer(n, np.int32), idf), labels.index(lang))] * times
        all_rows.sort(key=lambda r: r[0])
        part = [r[1:] for r in all_rows if r[0] % 5]
        held = [r[1:] for r in all_rows if r[0] % 5 == 0]
        w = fit(part or held, len(labels))
        if len({draw for draw, *_ in all_rows if draw % 5 == 0}) < LEAST_HELD * len(labels):
            held = part + held
        logits = np.array([x @ w[at] + w[BUCKETS] for at, x, _ in held]).reshape(-1, len(labels))
        scale = temperature(logits, np.array([y for *_, y in held], int))
        yield pa.RecordBatch.from_arrays([pa.array([w.tobytes()], pa.binary()), pa.array([scale])], names=["weights", "scale"])

    sample = rows.select("text", "lang", F.xxhash64("text").alias("draw")).join(F.broadcast(drawn), ["lang", "draw"]).dropDuplicates(["lang", "draw"])
    sample = stored(sample.select("text", "lang", "draw", "times").mapInArrow(features, "lang string, draw long, times int, at binary, n binary"), "sample")
    got = sample.coalesce(1).mapInArrow(train, "weights binary, scale double").first()
    return Model(labels, idf, np.frombuffer(got["weights"], np.float32).reshape(BUCKETS + 1, len(labels)), got["scale"])


def sure(labels: int) -> float:
    """The least score of a recognised text: a fifth over chance among two or more languages, less as chance nears 1. A calibrated score
    that low says that the likeliest language is hardly likelier than the others, however many there are."""
    return (1 + 0.2 * (1 - 1 / labels)) / labels


def recognised(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """The rows of `docs` whose text has a letter and a score of at least `sure`; none if no row has a language."""
    model, names = learn(docs, per_language), (free_name(docs, "_lang_pred"), free_name(docs, "_lang_score"))
    found = scored(docs, model, names)
    return found.where((F.col(names[0]) != UNKNOWN) & (F.col(names[1]) >= sure(len(model.labels) if model else 1))).drop(*names)


def labelled(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """The rows of `docs` (doc_id, text, lang and any others) with `_lang_pred` and `_lang_score`; columns of those names are replaced."""
    docs = docs.drop("_lang_pred", "_lang_score")
    return scored(docs, learn(docs, per_language), ("_lang_pred", "_lang_score"))


def scored(docs: DataFrame, model: Model | None, names: tuple[str, str]) -> DataFrame:
    """The rows of `docs` with the likeliest language and its score under the given names."""
    schema = T.StructType([*docs.schema.fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])
    if model is None:
        return docs.withColumns({names[0]: F.lit(UNKNOWN), names[1]: F.lit(0.0)})
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text_at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            predicted, scores = [], []
            for text, letters in zip(b.column(text_at), b.column(b.num_columns - 1).to_pylist()):
                p = shared.value.probabilities(text.as_py()) if letters else None
                predicted.append(UNKNOWN if p is None else shared.value.labels[int(p.argmax())])
                scores.append(0.0 if p is None else float(p.max()))
            columns = [b.column(i) for i in range(b.num_columns - 1)] + [pa.array(predicted, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    letters = F.coalesce(F.regexp_like("text", F.lit(r"\p{L}")), F.lit(False))
    return numbered_columns(docs.withColumn(free_name(docs, "_letters"), letters)).mapInArrow(run, schema)
