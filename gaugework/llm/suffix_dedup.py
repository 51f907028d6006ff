"""Suffix-array dedup: every byte covered by a string of `LENGTH` bytes that also starts elsewhere.

A string of `LENGTH` bytes (a *window*) has an anchor, the `GRAM` bytes in it with the least hash, leftmost on ties; equal windows
have it at the same place. So only windows at anchors that occur twice need sorting:

1. Every text passes on its anchors' hashes; those that occur once fall out.
2. At the others, the windows are cut into *slices* of `STEP` neighbouring offsets to the anchor. All windows of a slice share a
   core of `LENGTH` - `STEP` + 1 bytes; slices with equal cores form a bucket. A slice needs only its core's hash and the few bytes
   around it. Equal slices combine before the shuffle, so copies cost nothing, however many there are.
3. In a bucket each slice is the sequence: bytes before, the core as one symbol, bytes after. A suffix array over all of them,
   built by grouping (`suffix_order`), puts equal windows side by side. Buckets of more than `LARGE` different slices are not gathered:
   their windows are counted one by one, as rows.
4. Windows that occur twice are marked in their texts, and the bytes they cover removed.

Texts that are equal as a whole and long enough are repeats from end to end; one of them stands for all in the steps above.

Defined results: a null text counts as empty and keeps nothing; texts below `LENGTH` bytes lose nothing. Every row counts as a document of
its own, so repeated rows repeat each other. An empty table gives an empty result; other columns play no role.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugework.llm.frames import stored, text_runs
from gaugework.llm.suffix_order import suffix_order
from gaugework.llm.words import _VALUES, mix, powers, prefix_sums

LENGTH, GRAM, STEP = 200, 32, 32
CORE = LENGTH - STEP + 1
SPAN = LENGTH - GRAM + 1  # places an anchor can have in a window
LARGE = 2048
RUN_BYTES = 1 << 18
OUT_ROWS = 1 << 12  # marks sent on at once
_U = np.uint64


def substring_hashes(sums: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    _, down = powers(len(sums))
    return mix((sums[starts + length] - sums[starts]) * down[starts])


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window starts, place of each window's anchor, prefix sums) over the texts of a run, no window across two texts."""
    sums = prefix_sums(data, _VALUES)
    if len(data) < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), sums
    grams = substring_hashes(sums, np.arange(len(data) - GRAM + 1), GRAM)
    # The upper half of a hash and the place below it: the least is the least hash, leftmost on ties.
    least = (grams & _U(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while 2 * width <= SPAN:
        least = np.minimum(least[:len(least) - width], least[width:])
        width *= 2
    if width < SPAN:
        least = np.minimum(least[:len(least) - (SPAN - width)], least[SPAN - width:])
    inside = np.ones(len(least), bool)
    for end in offsets[1:-1]:
        inside[max(0, end - LENGTH + 1):end] = False
    starts = np.flatnonzero(inside)
    return starts, (least[starts] & _U(0xFFFFFFFF)).astype(np.int64), sums


def anchor_rows(docs: DataFrame) -> DataFrame:
    """(key, hashes, twice): hashes of a text's anchors, and which of them stand in it more than once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x, y, data, offsets in text_runs(b.column(1), RUN_BYTES):
                starts, at, sums = anchors(data, offsets)
                at = np.unique(at)
                h = substring_hashes(sums, at, GRAM)
                doc = np.searchsorted(offsets, at, "right") - 1
                order = np.lexsort((h, doc))
                h, doc = h[order], doc[order]
                first = np.ones(len(h), bool)
                first[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
                twice = ~np.append(first[1:], True)[first]
                h, doc = h[first], doc[first]
                ends = pa.array(np.searchsorted(doc, np.arange(y - x + 1)).astype(np.int32))
                rows = [pa.ListArray.from_arrays(ends, pa.array(v)) for v in (h.view(np.int64), twice)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(x, y - x), *rows], names=["key", "h", "twice"])

    return docs.select("key", "text").mapInArrow(run, "key binary, h array<long>, twice array<boolean>")


def slices(texts: DataFrame) -> DataFrame:
    """(key, anchor, core, low, left, right): the slices of `texts` (key, text, hashes) at the given anchors.

    `anchor` is the core's first byte in the text; windows start `low` to len(left) bytes before it.
    """
    schema = "key binary, at long, core long, low int, left binary, right binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x, y, data, offsets in text_runs(b.column(1), RUN_BYTES):
                starts, at, sums = anchors(data, offsets)
                places = np.unique(at)
                h = substring_hashes(sums, places, GRAM).view(np.int64)
                doc = np.searchsorted(offsets, places, "right") - 1
                wanted = np.zeros(len(places), bool)
                for d, got in enumerate(b.column(2).slice(x, y - x)):
                    p, q = np.searchsorted(doc, [d, d + 1])
                    wanted[p:q] = np.isin(h[p:q], np.asarray(got.as_py() or [], np.int64))
                use = wanted[np.searchsorted(places, at)]
                starts, at = starts[use], at[use]
                offset = at - starts
                slice_of = at * 16 + offset // STEP
                first = np.ones(len(at), bool)
                first[1:] = slice_of[1:] != slice_of[:-1]
                begin = np.flatnonzero(first)
                stop = np.append(begin[1:], len(at)) - 1
                # Offsets fall as windows move on.
                core = at[begin] - offset[begin] // STEP * STEP
                high, low = offset[begin] % STEP, offset[stop] % STEP
                raw = data.tobytes()
                d = np.searchsorted(offsets, core, "right") - 1
                yield pa.RecordBatch.from_arrays([
                    b.column(0).slice(x, y - x).take(pa.array(d)), pa.array(core - offsets[d]), pa.array(substring_hashes(sums, core, CORE).view(np.int64)), pa.array(low.astype(np.int32)),
                    pa.array([raw[c - k:c] for c, k in zip(core.tolist(), high.tolist())], pa.binary()),
                    pa.array([raw[c + CORE:c + LENGTH - k] for c, k in zip(core.tolist(), low.tolist())], pa.binary()),
                ], names=["key", "at", "core", "low", "left", "right"])

    return texts.select("key", "text", "hashes").mapInArrow(run, schema)


def marks_of(bucket: list[tuple[int, bytes, bytes, bool]]) -> list[int]:
    """For each slice (low, left, right, copied) of a bucket, a bit for every offset whose window occurs twice."""
    symbols: list[int] = []
    window: list[tuple[int, int] | None] = []
    gap = len(bucket) + 1  # separators 1 .. len(bucket), the core, then bytes
    for i, (low, left, right, _) in enumerate(bucket):
        window += [(i, len(left) - k) if k < len(left) - low + 1 else None for k in range(len(left))]
        window += [(i, 0) if low == 0 else None] + [None] * (len(right) + 1)
        symbols += [*(gap + 1 + c for c in left), gap, *(gap + 1 + c for c in right), i + 1]
    out = [sum(1 << k for k in range(low, len(left) + 1)) if copied else 0 for low, left, _, copied in bucket]
    previous = -1
    for s in suffix_order(symbols):
        if window[s] is None:
            continue
        if previous >= 0 and symbols[s:s + STEP] == symbols[previous:previous + STEP]:
            for i, k in (window[s], window[previous]):
                out[i] |= 1 << k
        previous = s
    return out


def bucket_marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(core, low, left, right, mark) of slices (core, low, left, right, copied) in order of their cores, bucket by bucket."""
    held, core, rows = [], None, []

    def done():
        marks = [sum(1 << k for k in range(low, len(left) + 1)) for low, left, _, _ in held] if len(held) == 1 else marks_of(held)
        rows.extend((core, *s[:3], m) for s, m in zip(held, marks) if m)

    def sent():
        return pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64()))], names=["core", "low", "left", "right", "mark"],
        )

    for b in batches:
        for c, *s in zip(*(col.to_pylist() for col in b.columns)):
            if c != core and held:
                done()
                held = []
                if len(rows) >= OUT_ROWS:  # most buckets are small, and a batch costs more than its rows
                    yield sent()
                    rows.clear()
            core = c
            held.append(tuple(s))
    if held:
        done()
    yield sent()


def sorted_marks(different: DataFrame) -> DataFrame:
    """Marks of the slices of small buckets: each task sorts its buckets one after the other."""
    rows = different.select("core", "low", "left", "right", "copied")
    return rows.repartition("core").sortWithinPartitions("core").mapInArrow(bucket_marks, "core long, low int, left binary, right binary, mark long")


def counted_marks(different: DataFrame) -> DataFrame:
    """Marks of the slices of large buckets, window by window."""
    each = different.withColumn("k", F.explode(F.expr("sequence(low, length(left))"))).withColumns({
        "l": F.expr("substring(left, length(left) - k + 1, k)"), "r": F.expr(f"substring(right, 1, {STEP - 1} - k)"),
    })
    twice = each.groupBy("core", "k", "l", "r").agg(F.count("*").alias("n"), F.max("copied").alias("copied")).where("n > 1 or copied").select("core", "k", "l", "r")
    return each.join(twice, ["core", "k", "l", "r"]).groupBy("core", "low", "left", "right").agg(F.expr("bit_or(shiftleft(1L, k))").alias("mark"))


def kept(texts: DataFrame) -> DataFrame:
    """(key, n_removed, n_spans, kept_sha256) of `texts` (key, text, marked), marked being (at, mark) pairs."""
    schema = "key binary, n_removed long, n_spans long, kept_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            removed, spans, shas = [], [], []
            for text, marked in zip(b.column(1), b.column(2)):
                raw = (text.as_py() or "").encode()
                edges = np.zeros(len(raw) + 1, np.int32)
                at, mark = (marked.values.field(name).to_numpy(zero_copy_only=False) for name in ("at", "mark"))
                row, k = np.nonzero(mark[:, None] >> np.arange(STEP) & 1)
                starts = at[row] - k
                np.add.at(edges, starts, 1)
                np.add.at(edges, starts + LENGTH, -1)
                gone = np.cumsum(edges)[:-1] > 0
                removed.append(int(gone.sum()))
                spans.append(int((gone & ~np.append(False, gone[:-1])).sum()))
                shas.append(hashlib.sha256(np.frombuffer(raw, np.uint8)[~gone].tobytes()).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(shas, pa.string())], names=["key", "n_removed", "n_spans", "kept_sha256"])

    return texts.select("key", "text", "marked").mapInArrow(run, schema)


def without_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every row of `docs` (doc_id, text)."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("sha"),
    ).withColumns({"key": F.expr("unhex(substr(sha, 1, 32))"), "n_bytes": F.octet_length("text").cast("long")})
    long = rows.where(F.col("n_bytes") >= LENGTH)

    found = stored(anchor_rows(long), "anchors").where("size(h) > 0")
    each = found.select("key", F.explode(F.arrays_zip("h", "twice")).alias("x")).select("key", "x.h", "x.twice")
    short = F.xxhash64("key")
    shared = each.groupBy("h").agg(F.min(short).alias("a"), F.max(short).alias("b"), F.max("twice").alias("twice")).where("twice or a <> b").select("h")
    wanted = each.select("key", "h").join(shared, "h").groupBy("key").agg(F.collect_set("h").alias("hashes"))
    texts = long.groupBy("key").agg(F.first("text").alias("text"))

    cut = stored(slices(texts.join(wanted, "key")), "slices")
    same = ["core", "low", "left", "right"]
    spot = F.struct("key", "at")
    different = cut.groupBy(*same).agg((F.min(spot) != F.max(spot)).alias("copied"))
    sizes = different.groupBy("core").agg(F.count("*").alias("n"), F.max("copied").alias("any")).where("n > 1 or any").drop("any")
    placed = stored(different.join(sizes, "core"), "different")
    marks = sorted_marks(placed.where(F.col("n") <= LARGE)).union(counted_marks(placed.where(F.col("n") > LARGE)).select(*same, "mark"))
    marked = cut.select("key", "at", *same).join(marks, same).groupBy("key").agg(F.collect_list(F.struct("at", "mark")).alias("marked"))
    results = stored(kept(texts.join(marked, "key")), "kept")

    copies = long.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select(F.col("key").alias("_copied"))
    out = rows.select("doc_id", "key", "sha", "n_bytes").join(results, "key", "left").join(copies, F.col("key") == F.col("_copied"), "left")
    whole, zero = F.col("_copied").isNotNull(), F.lit(0).cast("long")
    return out.select(
        "doc_id", "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", zero)).alias("n_removed"),
        F.when(whole, F.lit(1).cast("long")).otherwise(F.coalesce("n_spans", zero)).alias("n_spans"),
        F.when(whole, F.lit(hashlib.sha256().hexdigest())).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    )
