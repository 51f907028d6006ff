"""Source divergence audit by chunk factorization.

Which terms set a source apart within its language, and how far sources of a language lie from each other. Documents are placed
by language and source and read in runs; each document counts its white-space chunks, A-Z lower-cased, as positions in the run's dictionary.
Each chunk that is distinct corpus-wide is cut into terms once, where all runs' entries of it meet, and its terms are joined back to the runs; a chunk
of nothing but term characters is its own only term, needs no cutting and stays with its run. A run adds up occurrences and distinct
documents of its terms by source before they are shuffled.

All arithmetic is on whole numbers: a term with count n of a group with N occurrences of V kept terms has the weight
p = 1 + floor(10^9 (n + 2) / (N + 2 V)), and two weights lie floor((p - q)^2 / (p + q)) apart. Pairs of sources meet only on terms that
both hold; terms that one or none holds are summed by count. The pairs of sources are the result asked for, so the work on a term is the
square of the sources that hold it.

Defined results: null text, language and source are empty text. Repeated rows are documents of their own. A group without kept terms
has pairs with the other sources (0 where the language keeps no term) and no terms. An empty table gives an empty result. Other
columns play no role. A text is held whole by one task, with some 60 bytes of memory for each of its bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugework.llm.frames import binary_column, stored, text_runs
from gaugework.llm.runs import counted, pack, run_ids, unpack
from gaugework.llm.words import SPACE, bounds

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_DOCUMENTS, TOP = 10, 10
AUDIT_BYTES = 12 << 20  # text in a run; the longer it is, the fewer words its dictionary has for it
SCALE_STEP = 1000  # 10^9 = SCALE_STEP^3
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
IN_TERM = np.arange(256) >= 128  # bytes of folded text that belong to a term
IN_TERM[97:123] = True


def chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct white-space chunks with A-Z lower-cased, most frequent first, with the row and code of every chunk."""
    starts, ends, by_doc = bounds(data, offsets)
    edges = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(edges), pa.py_buffer(FOLD[data[~SPACE[data]]]))
    found = words.dictionary_encode()
    codes = found.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    order = np.argsort(-np.bincount(codes, minlength=len(found.dictionary)), kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return found.dictionary.take(pa.array(order)), np.repeat(np.arange(len(offsets) - 1), np.diff(by_doc)), place[codes]


RUN_SCHEMA = "run long, pos long, chunk string, lang string, source string, counts binary, terms binary"


def runs(docs: DataFrame, run_bytes: int = AUDIT_BYTES) -> DataFrame:
    """Rows of three kinds: a chunk of a run's dictionary that is to be cut (run, pos, chunk), a document (run, lang, source, counts), and
    one for the chunks of a run that are one term as they stand: their positions and lengths in `counts`, their bytes in `terms`."""
    names = [c.split()[0] for c in RUN_SCHEMA.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary(), pa.binary()]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = run_ids()

        def rows(many: int, **given) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(given[k], t) if k in given else pa.nulls(many, t) for k, t in zip(names, types)], names=names)

        for batch in batches:
            for x, y, data, offsets in text_runs(batch.column(2), run_bytes):
                words, row, code = chunks(data, offsets)
                at, n, edges = counted(row, code, y - x)
                run = next(numbers)
                whole, ends = binary_column(words)
                whole_term = np.diff(np.append(0, np.cumsum(~IN_TERM[whole]))[ends]) == 0
                cut = np.flatnonzero(~whole_term)
                yield rows(len(cut), run=np.full(len(cut), run), pos=cut, chunk=words.take(pa.array(cut)).cast(pa.string()))
                kept, lengths = np.flatnonzero(whole_term), np.diff(ends)
                yield rows(1, run=[run], counts=[pack(kept, lengths[kept])], terms=[whole[np.repeat(whole_term, lengths)].tobytes()])
                counts = [pack(at[p:q], n[p:q]) for p, q in zip(edges[:-1], edges[1:])]
                yield rows(y - x, run=np.full(y - x, run), lang=batch.column(0).slice(x, y - x), source=batch.column(1).slice(x, y - x), counts=counts)

    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    placed = docs.select(text("lang"), text("source"), text("text")).withColumn("near", F.xxhash64("text"))
    return placed.repartitionByRange("lang", "source", "near").select("lang", "source", "text").mapInArrow(work, RUN_SCHEMA)


def of_run(left: pa.Table, right: pa.Table) -> pa.Table:
    """Occurrences and documents by (lang, source, term) of a run: `left` its documents and whole terms, `right` the terms of its other chunks."""
    whole, left = left.filter(pc.is_valid(left.column("terms"))), left.filter(pc.is_null(left.column("terms")))
    row, at, n = unpack(left.column("counts").combine_chunks())
    groups = left.group_by(["lang", "source"], use_threads=False).aggregate([])
    names = {(a, b): i for i, (a, b) in enumerate(zip(groups.column("lang").to_pylist(), groups.column("source").to_pylist()))}
    group = np.array([names[k] for k in zip(left.column("lang").to_pylist(), left.column("source").to_pylist())], np.int64)
    _, own, lengths = unpack(whole.column("counts").combine_chunks())
    edges = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    own_terms = pa.LargeStringArray.from_buffers(len(own), pa.py_buffer(edges), whole.column("terms").combine_chunks()[0].as_buffer())
    cut, lists = right.column("pos").to_numpy(), right.column("terms").combine_chunks()
    found = pa.concat_arrays([own_terms, lists.flatten().cast(pa.large_string())]).dictionary_encode()
    term, many = found.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(found.dictionary)
    # Where the terms of each position begin, and how many it has; chunks without a term are not in the dictionary any more.
    sizes, first = np.zeros((2, int(max(at.max(initial=-1), own.max(initial=-1), cut.max(initial=-1))) + 1), np.int64)
    sizes[own], first[own] = 1, np.arange(len(own))
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    sizes[cut], first[cut] = lengths, len(own) + np.cumsum(lengths) - lengths
    each = sizes[at]
    entry = np.repeat(np.arange(len(at)), each)
    within = np.arange(len(entry)) - np.repeat(np.cumsum(each) - each, each)
    term = term[first[at[entry]] + within]
    key = group[row[entry]] * many + term
    order = np.argsort(key)
    distinct, starts = np.unique(key[order], return_index=True)
    total = np.add.reduceat(n[entry][order], starts) if len(starts) else starts
    pairs = np.unique(row[entry] * many + term)
    documents = np.unique(group[pairs // many] * many + pairs % many, return_counts=True)[1] if many else starts
    at_group, at_term = (distinct // many, distinct % many) if many else (distinct, distinct)
    return pa.table({
        "lang": groups.column("lang").combine_chunks().take(pa.array(at_group)), "source": groups.column("source").combine_chunks().take(pa.array(at_group)),
        "term": found.dictionary.take(pa.array(at_term)).cast(pa.string()), "n": pa.array(total, pa.int64()), "documents": pa.array(documents, pa.int64()),
    })


def cut_once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Terms of the chunks of a dictionary, in order of the chunk; chunks without a term are left out."""
    find = re.compile(TERM).findall
    last, last_terms = None, []
    for b in filter(len, batches):
        found = b.column(2).dictionary_encode()
        words = found.dictionary.to_pylist()
        terms = [last_terms if w == last else find(w) for w in words]
        last, last_terms = words[-1], terms[-1]
        out = pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(terms, pa.list_(pa.string())).take(found.indices)], names=["of_run", "pos", "terms"])
        yield out.filter(pc.greater(pc.list_value_length(out.column(2)), 0))


def term_counts(docs: DataFrame, run_bytes: int = AUDIT_BYTES) -> tuple[DataFrame, DataFrame]:
    """(lang, source, term, n, documents), dealt out by (lang, term), and the distinct (lang, source) of `docs`."""
    every = stored(runs(docs, run_bytes), "chunked")
    listed = every.where("chunk is not null").select("run", "pos", "chunk")
    # All runs' entries of a chunk lie next to each other, so each distinct chunk is cut once and the terms go back with the entries.
    near = listed.repartition("chunk").sortWithinPartitions("chunk")
    known = near.mapInArrow(cut_once, "of_run long, pos long, terms array<string>")
    of_docs = every.where("counts is not null").select("run", "lang", "source", "counts", "terms")
    schema = "lang string, source string, term string, n long, documents long"
    counted_runs = of_docs.groupBy("run").cogroup(known.groupBy("of_run")).applyInArrow(of_run, schema)
    # A run has added up its own rows; by language and term they are in place for the sums of sources and of languages alike.
    totals = counted_runs.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))
    return totals, every.where("lang is not null").select("lang", "source").distinct()


def weight(count: str, total: str, kept: str) -> str:
    """SQL for 1 + floor(10^9 (count + 2) / (total + 2 kept)) by long division, which needs no more than 1000 times the divisor."""
    m, k = f"({total} + 2 * {kept})", SCALE_STEP
    first = f"(({count} + 2) * {k})"
    second = f"({first} % {m} * {k})"
    third = f"({second} % {m} * {k})"
    return f"(1 + ({first} div {m}) * {k * k} + ({second} div {m}) * {k} + {third} div {m})"


def apart(p: str, q: str) -> str:
    return f"((({p}) - ({q})) * (({p}) - ({q})) div (({p}) + ({q})))"


def audit(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, top: int = TOP, run_bytes: int = AUDIT_BYTES) -> DataFrame:
    """(lang, source, part, item, value, rank): `pair` rows for the other sources of the language, `term` rows for its own terms.

    A language keeps the terms of at least `least_documents` of its documents; a group lists the `top` terms it has more of than
    the language.
    """
    counts, groups = term_counts(docs, run_bytes)
    of_term = Window.partitionBy("lang", "term")
    summed = counts.select(
        "lang", "source", "term", "n", F.sum("n").over(of_term).alias("of_lang"), F.sum("documents").over(of_term).alias("in_lang"),
        (F.min("source").over(of_term) == F.col("source")).alias("once"),
    )
    held = stored(summed.where(F.col("in_lang") >= least_documents).drop("in_lang"), "held")
    sizes = held.groupBy("lang").agg(F.count_if("once").alias("kept"), F.sum("n").alias("lang_total"))
    totals = held.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sources = stored(
        groups.join(sizes, "lang", "left").join(totals, ["lang", "source"], "left").select(
            "lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("kept", "lang_total", "total")],
        ).withColumn("zero", F.when(F.col("kept") > 0, F.expr(weight("0L", "total", "kept"))).otherwise(F.lit(0))),
        "sources",
    )
    weighed = stored(held.join(sources, ["lang", "source"]).select(
        "lang", "source", "term", "zero", F.expr(weight("n", "total", "kept")).alias("p"), F.expr(weight("of_lang", "lang_total", "kept")).alias("q"),
    ), "weighed")
    return pairs(weighed, sources).unionByName(own_terms(weighed, top))


def pairs(weighed: DataFrame, sources: DataFrame) -> DataFrame:
    """How far each source lies from each other of its language, all ranks."""
    one = sources.select("lang", "source", "kept", F.col("zero").alias("zero_a"))
    both = one.join(sources.select("lang", F.col("source").alias("item"), F.col("zero").alias("zero_b")), "lang").where("source <> item")
    none = F.when(F.col("kept") > 0, F.col("kept") * F.expr(apart("zero_a", "zero_b"))).otherwise(F.lit(0))
    # Terms of one source against the other's weight of nothing, summed by weight; then what is wrong with that where both hold a term.
    steps = weighed.groupBy("lang", "source", "p").agg(F.count("*").alias("n"))
    alone = both.join(steps, ["lang", "source"]).select("lang", "source", "item", (F.col("n") * F.expr(f"{apart('p', 'zero_b')} - {apart('zero_a', 'zero_b')}")).alias("value"))
    alone = alone.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    turned = lambda df: df.unionByName(df.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    side = lambda s, n, p, z: weighed.select("lang", "term", F.col("source").alias(s), F.col("p").alias(p), F.col("zero").alias(z))
    met = side("source", "n", "p", "zero_a").join(side("item", "n", "r", "zero_b"), ["lang", "term"]).where("source < item")
    shared = met.groupBy("lang", "source", "item").agg(F.sum(F.expr(
        f"{apart('p', 'r')} - {apart('p', 'zero_b')} - {apart('zero_a', 'r')} + {apart('zero_a', 'zero_b')}",
    )).alias("value"))
    parts = both.select("lang", "source", "item", none.alias("value")).unionByName(turned(alone)).unionByName(turned(shared))
    summed = parts.groupBy("lang", "source", "item").agg(F.sum("value").cast("long").alias("value"))
    return ranked(summed, "pair")


def own_terms(weighed: DataFrame, top: int) -> DataFrame:
    """The terms a group has more of than its language, by how far their weights lie apart."""
    more = weighed.where("p > q").select("lang", "source", F.col("term").alias("item"), F.expr(apart("p", "q")).alias("value"))
    return ranked(more, "term").where(F.col("rank") <= top)


def ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
