"""MinHash near-dedup on HyperMinHash registers.

A register keeps, of the smallest hash in its bucket, the number of leading zeros and the `MANTISSA` bits after the first one:
16 bits instead of 64. Every bucket hashes all shingles with its own multiplier, so that no bucket is empty. Four registers of
a band lie next to each other and are read as one 64-bit key.

Documents with equal shingle sets are one *class*; all later steps work on classes. A bucket of classes is never paired with
itself: each member is compared with one pivot, links are joined to components, and members of one bucket that still lie
in different components meet on what their differences to the pivot have in common (`pivots`). Candidates are judged by the
collision-corrected estimate first, links by the full sets.

With 32 bands of 4 registers two sets at the threshold 0.8 share no band in fewer than 5 of 10^8 cases, and the estimate of a
pair at the threshold falls below `ESTIMATE_FROM` in fewer than 1 of 10^6. What pivots leave apart meets by an exact bound.

Defined results: a null, empty or blank text has no shingles, is linked with nothing and kept. A text with fewer than
`size` words has one shingle. Repeated rows get the same result. A null doc_id counts as larger than all others; a component
that has no other id gets null and is kept. An empty table gives an empty result. Other columns play no role.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugework.llm.frames import possible_keys, scratch, stored, text_runs
from gaugework.llm.pivots import full_sets, resolve
from gaugework.llm.words import distinct_by_doc, mix, shingle_hashes, word_hashes

REGISTERS, PER_BAND, MANTISSA = 128, 4, 10
BANDS = REGISTERS // PER_BAND
ESTIMATE_FROM = 0.62
RUN_BYTES = 1 << 18  # text worked on at once, so that a register's pass stays in the cache
_U = np.uint64
_SEEDS = mix(np.arange(1, 2 * REGISTERS + 1, dtype=np.uint64) * _U(0xA0761D6478BD642F))
_FLIP, _TIMES = _SEEDS[:REGISTERS], _SEEDS[REGISTERS:] | _U(1)


def compress(least: np.ndarray) -> np.ndarray:
    """64-bit minima to registers: leading zeros above, mantissa below. Larger minima give smaller leading-zero counts."""
    value = least | _U(1)
    top = np.floor(np.log2(value.astype(np.float64))).astype(np.int64).clip(max=63)
    top -= (value >> top.astype(np.uint64)) == 0  # rounding to float may reach the next power
    shifted = value << (63 - top).astype(np.uint64)
    mantissa = (shifted << _U(1)) >> _U(64 - MANTISSA)
    return ((63 - top).astype(np.uint64) << _U(MANTISSA) | mantissa).astype(np.uint16)


def registers(shingles: np.ndarray, by_doc: np.ndarray) -> np.ndarray:
    """One row of registers per document; all ones for a document without shingles."""
    out = np.full((len(by_doc) - 1, REGISTERS), 0xFFFF, np.uint16)
    full = np.flatnonzero(np.diff(by_doc) > 0)
    if len(full):
        starts, least = by_doc[full], np.empty((REGISTERS, len(full)), np.uint64)
        work = np.empty_like(shingles)
        for r in range(REGISTERS):
            np.bitwise_xor(shingles, _FLIP[r], out=work)
            np.multiply(work, _TIMES[r], out=work)
            least[r] = np.minimum.reduceat(work, starts)
        out[full] = compress(least).T
    return out


def sketches(texts: pa.Array, size: int) -> Iterator[tuple[np.ndarray, list[bytes], list[bytes]]]:
    """(set sizes, keys of the sets, registers) of all rows, run by run."""
    for _, _, data, offsets in text_runs(texts, RUN_BYTES):
        shingles, by_doc = distinct_by_doc(*shingle_hashes(*word_hashes(data, offsets), size))
        sizes = np.diff(by_doc)
        full = sizes > 0
        key = np.zeros((len(sizes), 2), np.uint64)
        if full.any():
            for k, seed in enumerate((0x1B873593CC9E2D51, 0x85EBCA6BC2B2AE35)):
                key[full, k] = np.add.reduceat(mix(shingles ^ _U(seed)), by_doc[:-1][full])
        yield sizes, [k.tobytes() for k in key], [r.tobytes() for r in registers(shingles, by_doc)]


def sketch(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, text_key, n_shingles, node, regs): node names the class, text_key tells texts of one id apart."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, nodes, regs = [], [], []
            for s, n, r in sketches(b.column(2), size):
                sizes += s.tolist()
                nodes += n
                regs += r
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(pa.int64()), b.column(1).cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()), pa.array(regs, pa.binary())],
                names=["doc_id", "text_key", "n_shingles", "node", "regs"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    return rows.mapInArrow(run, "doc_id long, text_key long, n_shingles long, node binary, regs binary")


_CELLS: dict = {}


def chance(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Chance that registers of unrelated sets of n and m elements are equal, on a grid of powers of 2^(1/4)."""
    if not _CELLS:
        zeros, step = np.arange(0, 49), 1 << 6  # mantissas in 64 cells; a cell's 16 values are even within it
        edges = np.concatenate([(1 + np.arange(step + 1) / step)[None, :] * 0.5 ** (zeros + 1)[:, None]])
        grid = 2 ** (np.arange(0, 4 * 32 + 1) / 4)
        missed = np.exp(grid[:, None, None] * np.log1p(-np.minimum(edges, 1 - 1e-16))[None])
        cells = (missed[:, :, :-1] - missed[:, :, 1:]).reshape(len(grid), -1)
        _CELLS["table"] = cells @ cells.T / (1 << MANTISSA) * step
    at = [np.clip(np.rint(4 * np.log2(np.maximum(x, 1))), 0, 4 * 32).astype(int) for x in (n, m)]
    return _CELLS["table"][at[0], at[1]]


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard likeness from registers (one row per pair), less what chance collisions add."""
    equal, by_chance = (a == b).mean(1), chance(n, m)
    return np.clip((equal - by_chance) / (1 - by_chance), 0, 1)


def estimated(pairs: DataFrame, classes: DataFrame, from_: float) -> DataFrame:
    """Pairs (a, b) whose sizes allow the threshold and whose estimate reaches `from_`."""
    side = lambda x: classes.select(F.col("node").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("regs").alias(f"r_{x}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            regs = [np.frombuffer(b"".join(b.column(k).to_pylist()), np.uint16).reshape(-1, REGISTERS) for k in (4, 5)]
            likely = estimate(*regs, *(b.column(k).to_numpy(zero_copy_only=False) for k in (2, 3))) >= from_
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(likely))

    rows = pairs.join(side("a"), "a").join(side("b"), "b").where("least(n_a, n_b) >= 0.5 * greatest(n_a, n_b)")
    return rows.select("a", "b", "n_a", "n_b", "r_a", "r_b").mapInArrow(run, "a binary, b binary")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, text_key, n_shingles, component_id, kept) for every row of `docs` (doc_id, text).

    `size` words make a shingle; documents with 100 * intersection >= percent * union of their sets are linked, for
    percent >= 75. component_id is the least doc_id that links reach; kept marks that document.
    """
    spark = docs.sparkSession
    least = F.min_by(F.struct("doc_id", "text_key"), F.struct(F.col("doc_id").isNull(), "doc_id", "text_key"))
    with scratch(spark) as keep:
        with scratch(spark) as keep_on:  # registers are most of what is stored, and only members of shared bands need theirs any longer
            sketches = stored(sketch(docs, size), "sketches")
            every = keep_on(stored(sketches.drop("regs"), "rows"))
            registered = stored(
                sketches.where("n_shingles > 0").groupBy("node").agg(F.first("n_shingles").alias("n_shingles"), F.first("regs").alias("regs"), least.alias("source")), "registered",
            )
            classes = keep_on(stored(registered.select("node", "source"), "classes"))
            # Bands: 16 hexadecimal digits of the registers are one key.
            bands = registered.select("node", "n_shingles", F.posexplode(F.expr(
                f"transform(sequence(0, {BANDS - 1}), i -> substring(regs, 1 + {2 * PER_BAND} * i, {2 * PER_BAND}))",
            )).alias("band", "key"))
            shared = bands.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 1")
            members = keep_on(stored(bands.join(shared, ["band", "key"]), "members"))
            near = keep_on(stored(registered.join(members.select("node").distinct(), "node", "left_semi"), "near"))
        full = full_sets(near.select("node"), docs, near, size)
        labels = resolve(members.select(F.xxhash64("band", "key").alias("bucket"), "node"), full, percent, lambda pairs: estimated(pairs, near, ESTIMATE_FROM))
        for df in (every, classes, labels):
            keep(df)

    first = classes.select("node", F.col("source.doc_id").alias("id"))
    named = first.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    ids = named.groupBy("label").agg(F.min("id").alias("component_id"))
    of_class = named.where("node <> label or id is not null").join(ids, "label").select("node", "component_id")
    out = every.select("doc_id", "text_key", "n_shingles", "node").join(of_class, "node", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "text_key", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def without_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs` with one document of each component, the one with the least doc_id; repeated rows are one document."""
    text_key, no_id, id_ = F.xxhash64("text").alias("text_key"), F.col("doc_id").isNull().alias("no_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")).alias("id")
    keys = ["text_key", "no_id", "id"]
    with scratch(docs.sparkSession) as keep:
        found = near_duplicates(docs, size, percent).select("text_key", no_id, id_, "kept")
        counted = found.groupBy(*keys).agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
        touched = keep(stored(counted.where("not kept or n > 1").select(*keys, "kept"), "touched"))
    # A row whose key is kept and comes once stays as it is, so only the others are shuffled.
    keyed = docs.select(F.struct("*").alias("row"), text_key, no_id, id_)  # the caller's columns apart, whatever their names
    some, others = possible_keys(keyed, touched, keys)
    kept = some.join(touched, keys, "left").where("coalesce(kept, true)").dropDuplicates(keys)
    return kept.select("row").union(others.select("row")).select("row.*")
