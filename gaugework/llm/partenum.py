"""N-gram Jaccard join by PartEnum signatures.

Sets are put into bands of sizes such that linked sets lie in one band or in neighbouring ones; a set is signed for its own band
and for the one below, where it may be the larger partner. A band's sizes and the threshold bound how many elements linked sets differ in,
k at most. The domain is dealt by hash into n1 parts of n2 cells each, with n1 more than k / 2: so some parts hold at most one
differing element, and within such a part there is a choice of n2 - 1 cells without any. Every choice of n2 - 1 cells of a part is enumerated, and what
of the set lies in it is hashed to a signature: linked sets share one.

A choice that holds nothing of a set says nothing. One part more than needed is dealt (`SPARE`), so a set may leave out empty
choices if they lie in no more parts than that; a set with more of them signs them too. No link is lost either way.

Documents with equal sets are one class. Classes that share a signature are never paired with each other: see `pivots`. Links are
decided on the full sets.

Defined results: a null, empty or blank text has no shingles and is linked with nothing. A text with fewer than `size` words has one
shingle. Repeated rows get the same result. A null doc_id counts as larger than all others; a component that has no other id gets null. An empty
table gives an empty result. Other columns play no role. A text is held whole by one task, with some 100 bytes of memory for each of its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugework.llm.frames import stored, text_runs
from gaugework.llm.pivots import SET_BYTES, full_sets, resolve
from gaugework.llm.words import distinct_by_doc, mix, shingle_hashes, word_hashes

SPARE = 1
SHORT, SHORT_CELLS, CELLS = 64, 4, 2  # bands of sets up to SHORT elements choose 3 of 4 cells, longer ones 1 of 2
LARGEST = 1 << 40
_U = np.uint64
_SEEDS = [_U(x) for x in (0x1B873593CC9E2D51, 0x85EBCA6BC2B2AE35, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


class Bands:
    """Size bands for a threshold, and how many differences, parts and cells each has."""

    def __init__(self, percent: int):
        lows, highs = [1], []
        while lows[-1] <= LARGEST:
            highs.append(100 * lows[-1] // percent)
            lows.append(highs[-1] + 1)
        self.highs = np.array(highs, np.int64)
        largest = 100 * self.highs // percent  # a partner of the band's largest set
        self.differ = (100 - percent) * (self.highs + largest) // (100 + percent)
        self.cells = np.where(self.highs <= SHORT, SHORT_CELLS, CELLS)
        self.parts = self.differ // 2 + 1 + SPARE

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.highs, sizes)


def band_signatures(shingles: np.ndarray, by_doc: np.ndarray, band: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of sets in one band each, and the sets they are of. Sets of bands without differences have none."""
    sizes = np.diff(by_doc)
    use = np.flatnonzero((band >= 0) & (sizes > 0) & (bands.differ[band.clip(0)] > 0))
    if not len(use):
        return np.zeros(0, np.uint64), use
    parts, cells = bands.parts[band[use]], bands.cells[band[use]]
    taken = np.concatenate([shingles[by_doc[d]:by_doc[d + 1]] for d in use])
    each = sizes[use]
    first = np.concatenate([[0], np.cumsum(parts * cells)])
    # Which cell: the same for both partners, as both use the band's number of cells.
    place = (mix(taken ^ _SEEDS[0]) >> _U(32)) * np.repeat(parts * cells, each).astype(np.uint64) >> _U(32)
    at = np.repeat(first[:-1], each) + place.astype(np.int64)
    value = mix(taken ^ _SEEDS[1])
    low, high = (np.bincount(at, (value >> _U(shift) & _U(0xFFFFFFFF)).astype(np.float64), first[-1]).astype(np.uint64) for shift in (0, 32))
    held = np.bincount(at, minlength=first[-1])
    inside = low + (high << _U(32))
    # A choice leaves one cell of its part out.
    part_first = np.concatenate([np.arange(f, f + p * c, c) for f, p, c in zip(first, parts, cells)])
    part = np.repeat(np.arange(len(part_first)), np.repeat(cells, parts))
    choice, kept = np.add.reduceat(inside, part_first)[part] - inside, np.add.reduceat(held, part_first)[part] - held
    owner = np.repeat(np.arange(len(use)), parts * cells)
    empty_parts = np.bincount(owner[part_first], np.minimum.reduceat(kept, part_first) == 0, len(use))
    keep = (kept > 0) | (empty_parts[owner] > SPARE)
    number = np.arange(first[-1]) - first[owner]
    tag = band[use][owner].astype(np.uint64) << _U(40) | number.astype(np.uint64)
    return mix(mix(choice ^ _SEEDS[2]) + mix(tag ^ _SEEDS[3]))[keep], use[owner[keep]]


def signatures(shingles: np.ndarray, by_doc: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of each set for its own band and the one below, and the sets they are of."""
    band = bands.of(np.diff(by_doc))
    found = [band_signatures(shingles, by_doc, band - lower, bands) for lower in (0, 1)]
    return tuple(np.concatenate(x) for x in zip(*found))


def signed(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(doc_id, text_key, n_shingles, node, signs): node names the class, text_key tells texts of one id apart."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent)
        for b in batches:
            for x, y, data, offsets in text_runs(b.column(2), SET_BYTES):
                shingles, by_doc = distinct_by_doc(*shingle_hashes(*word_hashes(data, offsets), size))
                sizes = np.diff(by_doc)
                key = np.zeros((y - x, 2), np.uint64)
                if (sizes > 0).any():
                    for k in (0, 1):
                        key[sizes > 0, k] = np.add.reduceat(mix(shingles ^ _SEEDS[2 + k]), by_doc[:-1][sizes > 0])
                signs, owner = signatures(shingles, by_doc, bands)
                order = np.argsort(owner, kind="stable")
                ends = np.searchsorted(owner[order], np.arange(y - x + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(x, y - x), b.column(1).slice(x, y - x), pa.array(sizes, pa.int64()), pa.array([k.tobytes() for k in key], pa.binary()),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(signs[order].view(np.int64)))],
                    names=["doc_id", "text_key", "n_shingles", "node", "signs"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    return rows.mapInArrow(run, "doc_id long, text_key long, n_shingles long, node binary, signs array<long>")


def joined(docs: DataFrame, size: int = 3, percent: int = 90) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of `docs` (doc_id, text).

    `size` words make a shingle; documents with 100 * intersection >= percent * union of their sets are linked. component_id is the
    least doc_id that links reach.
    """
    every = stored(signed(docs, size, percent), "signed")
    least = F.min_by(F.struct("doc_id", "text_key"), F.struct(F.col("doc_id").isNull(), "doc_id", "text_key"))
    classes = stored(every.where("n_shingles > 0").groupBy("node").agg(least.alias("source")), "classes")
    # Signatures travel with eight bytes for a class; only those that classes share take its whole name.
    each = every.select(F.explode("signs").alias("bucket"), F.xxhash64("node").alias("id"))
    shared = each.groupBy("bucket").agg(F.min("id").alias("x"), F.max("id").alias("y")).where("x <> y").select("bucket")
    held = stored(each.join(shared, "bucket", "left_semi").distinct(), "held")
    members = stored(held.join(classes.select("node", F.xxhash64("node").alias("id")), "id").select("bucket", "node"), "members")
    full = full_sets(members.select("node").distinct(), docs, classes, size)
    labels = resolve(members, full, percent)
    named = classes.select("node", F.col("source.doc_id").alias("id")).join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    ids = named.groupBy("label").agg(F.min("id").alias("component_id"))
    of_class = named.join(ids, "label").select("node", "component_id")
    out = every.select("doc_id", "n_shingles", "node").join(of_class, "node", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
