"""Components of near-copy links from buckets of candidates, without pairing the members of a bucket.

Whatever scheme makes the buckets, two classes (distinct sets) that may be linked share one. In each bucket every member is compared
with one pivot, the member that shares most; links join to components. What is left to find are links between members of one
bucket that lie in different components. For these each member is written as its difference to the pivot, the shingles it
has more or less than the pivot. For sets A and B with pivot P and differences a and b,

    |A ^ B| = |a| + |b| - 2 |a & b|,    and A and B are linked if (100 + t) |A ^ B| <= (100 - t) (|A| + |B|).

Two members that are both linked with the pivot are in one component. If one of them is not, they can be linked only if their differences have
something in common: |a| (100 + t) > (100 - t) (|A| + |P|) and |b| >= ||B| - |P|| leave no room otherwise. How much they must have in common at
least gives each member the length of a prefix of its difference, rarest first, in which it must meet every partner. Those
meetings are the buckets of the next level, with pivots of their own, or pairs where few members outside the pivot's component
meet; members of that component, among whom no link is missing, are entered only where one of those is. A group never holds the pivot of
the group it comes from, so the levels end.

The rows of all levels grow with the members and the lengths of their differences, not with the square of a bucket.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugework.llm.components import components
from gaugework.llm.frames import possible_keys, scratch, stored, text_runs
from gaugework.llm.words import distinct_by_doc, shingle_hashes, word_hashes

SET_BYTES = 1 << 18  # text worked on at once
SMALL = 128  # members of a bucket outside the pivot's component that are paired with its members instead of with a pivot
PAIR_KEYS = ["parent", "pivot"]


def full_sets(nodes: DataFrame, docs: DataFrame, classes: DataFrame, size: int) -> DataFrame:
    """(node, members): the whole shingle sets of classes, as packed sorted hashes, from one document of each."""
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x, y, data, offsets in text_runs(b.column(1), SET_BYTES):
                shingles, by_doc = distinct_by_doc(*shingle_hashes(*word_hashes(data, offsets), size))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(x, y - x), pa.array([shingles[p:q].tobytes() for p, q in zip(by_doc[:-1], by_doc[1:])], pa.binary())], names=["node", "members"],
                )

    keys = ["text_key", "no_id", "id"]
    chosen = nodes.join(classes, "node").select("node", "source.text_key", F.col("source.doc_id").isNull().alias("no_id"), F.coalesce("source.doc_id", F.lit(0).cast("long")).alias("id"))
    texts = docs.select(F.xxhash64("text").alias("text_key"), F.col("doc_id").isNull().alias("no_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")).alias("id"), "text")
    with scratch(docs.sparkSession) as keep:
        source = stored(chosen, "sources")
        likely, _ = possible_keys(texts, source, keys)
        found = likely.join(source, keys).dropDuplicates(keys).select("node", "text")  # dealt by the same keys, so texts move once
        return keep(stored(found.mapInArrow(sets, "node binary, members binary"), "sets"))


def _sets(column: pa.Array) -> Iterator[np.ndarray]:
    for cell in column:
        yield np.frombuffer(cell.as_buffer(), np.uint64)


def verified(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) with 100 * intersection >= percent * union of the full sets."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for p, q in zip(_sets(b.column(2)), _sets(b.column(3))):
                if percent * max(len(p), len(q)) > 100 * min(len(p), len(q)):
                    keep.append(False)
                    continue
                both = np.concatenate([p, q])
                both.sort()
                inter = int((both[1:] == both[:-1]).sum())
                keep.append(100 * inter >= percent * (len(both) - inter))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    side = lambda x: full.select(F.col("node").alias(x), F.col("members").alias(f"s_{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "s_a", "s_b").mapInArrow(compare, "a binary, b binary")


def differences(pairs: DataFrame, full: DataFrame) -> DataFrame:
    """(pivot, node, n, n_pivot, delta): sizes of both sets, and the hashes that only one of them holds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, deltas = [], []
            for p, q in zip(_sets(b.column(2)), _sets(b.column(3))):
                sizes.append((len(q), len(p)))
                deltas.append(np.setxor1d(p, q, assume_unique=True).view(np.int64))
            ends = np.concatenate([[0], np.cumsum([len(v) for v in deltas])]).astype(np.int32)
            n, n_pivot = zip(*sizes) if sizes else ((), ())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(n_pivot, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*deltas, np.zeros(0, np.int64)])))],
                names=["pivot", "node", "n", "n_pivot", "delta"],
            )

    side = lambda x: full.select(F.col("node").alias(x), F.col("members").alias(f"s_{x}"))
    rows = pairs.join(side("node"), "node").join(side("pivot"), "pivot").select("pivot", "node", "s_pivot", "s_node")
    return rows.mapInArrow(run, "pivot binary, node binary, n long, n_pivot long, delta array<long>")


def ordered(a: str, b: str) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def with_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    return rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def meetings(groups: DataFrame, labels: DataFrame, full: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, DataFrame] | None:
    """Links with pivots, pairs to compare, and the next level's members, of groups that hold different components."""
    t, u = 100 + percent, 100 - percent
    rows = with_labels(groups, labels)
    several = rows.groupBy(*PAIR_KEYS).agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select(*PAIR_KEYS)
    # `own` members lie in the pivot's component, so no link among them is missing: each link that is has another one at an end.
    of_pivot = labels.select(F.col("node").alias("pivot"), F.col("label").alias("pivot_label"))
    torn = rows.join(several, PAIR_KEYS, "left_semi").join(of_pivot, "pivot", "left").withColumn("own", F.expr("label = coalesce(pivot_label, pivot)")).drop("pivot_label")
    rows = stored(torn, "torn")
    if rows.isEmpty():
        return None
    delta = differences(rows.select("pivot", "node").distinct(), full)
    sized = stored(
        rows.join(delta, ["pivot", "node"]).withColumn("d", F.size("delta").cast("long")).withColumn("linked", F.expr(f"{t} * d <= {u} * (n + n_pivot)")), "differences",
    )
    # What a member must have in common with any partner B: |b| >= |a & b| gives the first bound, with |B| at most |A| / threshold;
    # a partner of a member that is linked with the pivot is not, which gives the second.
    greatest = sized.groupBy(*PAIR_KEYS).agg(F.max("n").alias("greatest"))
    first = f"({t} * d - {u} * (n + least(greatest, 100 * n div {percent})) + {t - 1}) div {t}"
    second = f"if(linked, ({t} * d - {u} * (n - n_pivot)) div {2 * t} + 1, 1)"
    needs = sized.join(greatest, PAIR_KEYS).withColumn("need", F.expr(f"greatest(1, {first}, {second})")).where("need <= d")
    each = needs.select(*PAIR_KEYS, "node", "label", "own", "need", F.explode("delta").alias("h"))
    common = each.groupBy(*PAIR_KEYS, "h").agg(F.count("*").alias("held"), F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y")
    shared = each.join(common.select(*PAIR_KEYS, "h", "held"), [*PAIR_KEYS, "h"]).groupBy(*PAIR_KEYS, "node", "own", "need").agg(F.sort_array(F.collect_list(F.struct("held", "h"))).alias("x"))
    facts = sized.select(*PAIR_KEYS, "node", "label", "own", "n", "d", "linked")
    # A prefix ends with its element number size - need + 1.
    shared = stored(shared.where("size(x) >= need").withColumn("s", F.size("x").cast("long")).withColumn("end", F.expr("x[cast(size(x) - need as int)]")), "shared")
    prefix = F.posexplode(F.expr("slice(x, 1, cast(size(x) - need + 1 as int))")).alias("at", "x")
    key = [*PAIR_KEYS, "h"]
    others = shared.where("not own").select(*PAIR_KEYS, "node", "s", prefix).select(*PAIR_KEYS, "node", (F.col("s") - F.col("at")).alias("s"), "x.h", "x.held")
    others = stored(others.join(facts, [*PAIR_KEYS, "node"]), "others")
    # At the first hash that two members meet on, what is left of either (`s`) bounds what they have in common.
    # Own members are entered only where one of the others is.
    wanted = others.groupBy(*key).agg(F.first("held").alias("held"))
    owned = each.where("own").select(*key, "node").join(wanted, key).join(shared.where("own").select(*PAIR_KEYS, "node", "s", "end"), [*PAIR_KEYS, "node"])
    owned = owned.where("struct(held, h) <= end").select(*PAIR_KEYS, "node", "s", "h", "held").join(facts, [*PAIR_KEYS, "node"])
    indexed = stored(others.unionByName(owned.select(others.columns)), "indexed")
    met = indexed.groupBy(*key).agg(F.count_if(~F.col("own")).alias("others"), F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y")
    few = indexed.join(met.where(F.col("others") <= SMALL).select(*key), key, "left_semi")
    other = few.where("not own").select(*key, *[F.col(c).alias(f"{c}2") for c in ("node", "label", "n", "d", "s", "linked")])
    possible = F.expr(
        f"(own and label <> label2 or label < label2) and not (linked and linked2) and {percent} * greatest(n, n2) <= 100 * least(n, n2) and {2 * t} * least(s, s2) >= {t} * (d + d2) - {u} * (n + n2)",
    )
    pairs = few.join(other, key).where(possible).select(*ordered("node", "node2")).distinct()
    many = indexed.join(met.where(F.col("others") > SMALL).select(*key), key, "left_semi")
    members = many.select(F.xxhash64(*PAIR_KEYS).alias("parent"), F.xxhash64(*key).alias("bucket"), "node")
    return sized.where("linked").select(*ordered("node", "pivot")), pairs, members


def relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Components after further links: only the components that these join are gone through again."""
    ends = links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node"))).distinct()
    every = stored(labels.unionByName(ends.join(labels, "node", "left_anti").select("node", F.col("node").alias("label"))), "labels")
    side = lambda x: every.select(F.col("node").alias(x), F.col("label").alias(f"l_{x}"))
    across = stored(links.join(side("a"), "a").join(side("b"), "b").where("l_a <> l_b").select(*ordered("l_a", "l_b")).distinct(), "across")
    if across.isEmpty():
        return every
    further = components(across).select(F.col("node").alias("label"), F.col("label").alias("further"))
    return stored(every.join(further, "label", "left").select("node", F.coalesce("further", "label").alias("label")), "labels")


def resolve(members: DataFrame, full: DataFrame, percent: int, likely: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(node, label) of the components of links among `members` (bucket, node); classes without a link may be left out.

    `full` holds the sets of all members. `likely` may narrow pairs (a, b) before their sets are compared; it must keep all links.
    """
    likely = likely or (lambda pairs: pairs)
    with scratch(members.sparkSession) as keep:
        level, labels = stored(members.select(F.lit(0).cast("long").alias("parent"), "bucket", "node").distinct(), "level"), None
        while level is not None:
            with scratch(members.sparkSession) as keep_on:
                level, labels, full = one_level(level, labels, full, percent, likely)
                for df in (labels, *([level, full] if level is not None else [])):
                    keep_on(df)
        return keep(labels)


def one_level(
    level: DataFrame, labels: DataFrame | None, full: DataFrame, percent: int, likely: Callable[[DataFrame], DataFrame],
) -> tuple[DataFrame | None, DataFrame, DataFrame]:
    """The next level, if there is one, the components after this one, and the sets that the next one needs."""
    weight = level.groupBy("node").agg(F.count("*").alias("weight"))
    pivots = level.join(weight, "node").groupBy("parent", "bucket").agg(F.max_by("node", F.struct("weight", "node")).alias("pivot"))
    groups = stored(level.join(pivots, ["parent", "bucket"]).where("node <> pivot").select(*PAIR_KEYS, "node").distinct(), "groups")
    links = stored(verified(likely(groups.select(*ordered("node", "pivot")).distinct()), full, percent), "links")
    labels = components(links) if labels is None else relabelled(labels, links)
    rest = meetings(groups, labels, full, percent)
    if rest is None:
        return None, labels, full
    with_pivot, pairs, following = rest
    labels = relabelled(labels, stored(with_pivot.union(verified(likely(pairs), full, percent)).distinct(), "links"))
    # Buckets that lie in one component by now need no level of their own.
    rows = with_labels(following.select("parent", "bucket", "node").distinct(), labels)
    several = rows.groupBy("parent", "bucket").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select("parent", "bucket")
    level = stored(rows.drop("label").join(several, ["parent", "bucket"], "left_semi"), "level")
    if level.isEmpty():
        return None, labels, full
    return level, labels, stored(full.join(level.select("node").distinct(), "node", "left_semi"), "sets")
