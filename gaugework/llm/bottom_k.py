"""Document fingerprints: bottom-k sketches of shingle hashes, in DataFrame functions only.

A sketch is the sorted array of the `K` least distinct hashes (48 bits) of a text's shingles. Sketches of parts merge by
`merged`, and estimate resemblance, containment and the number of distinct shingles; below `K` shingles all are exact.

The hashes of a long text are first filtered by a bound that about `2 K` of them pass; if too few distinct ones do, all are
sorted, so that the sketch never depends on the shortcut.

Defined results: a null text counts as empty and has an empty sketch; two empty sketches are alike (1), an empty and another
are not (0). A text with fewer than `SIZE` words has one shingle. A null doc_id counts as the least of all. Rows that share a
doc_id have one place in the order and the same next document, and what they lend to the one before them is the text with the
least hash. Repeated rows get equal results; a single document is its own next; an empty table gives an empty result; other
columns play no role.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugework.llm.frames import running_totals, stored

K, SIZE, BITS = 128, 5, 48
_NO_ID = -(1 << 63)


def sketched(df: DataFrame, text: str, name: str, k: int = K, size: int = SIZE) -> DataFrame:
    """`df` with the sketch of a text column as `name`."""
    w, h, low = f"_{name}_words", f"_{name}_hashes", f"_{name}_low"
    parts = ", ".join(f"{w}[i + {j}]" for j in range(size))
    out = df.withColumn(w, F.expr(rf"filter(split(lower(coalesce({text}, '')), '[\\x20\\x09-\\x0D]+'), x -> x <> '')"))
    out = out.withColumn(h, F.expr(
        f"case when size({w}) >= {size} then transform(sequence(0, size({w}) - {size}), i -> shiftrightunsigned(xxhash64({parts}), {64 - BITS}))"
        f" when size({w}) > 0 then array(shiftrightunsigned(xxhash64(concat_ws(' ', {w})), {64 - BITS})) else cast(array() as array<bigint>) end",
    )).drop(w)
    out = out.withColumn(low, F.expr(f"if(size({h}) > {4 * k}, array_distinct(filter({h}, x -> x < {(1 << BITS) * 2 * k} div size({h}))), array_distinct({h}))"))
    return out.withColumn(name, F.expr(f"slice(sort_array(if(size({low}) >= {k} or size({h}) <= {4 * k}, {low}, array_distinct({h}))), 1, {k})")).drop(h, low)


def text_of(sketch: str) -> Column:
    """A sketch as text: twelve hexadecimal digits a hash."""
    return F.expr(f"array_join(transform({sketch}, x -> lpad(lower(hex(x)), {BITS // 4}, '0')), '')")


def merge(a: str, b: str, k: int = K) -> str:
    """SQL for the sketch of the union of two texts' shingles."""
    return f"slice(sort_array(array_union({a}, {b})), 1, {k})"


def resemblance(a: str, b: str, k: int = K) -> Column:
    """Jaccard likeness of what two sketches stand for."""
    union = merge(a, b, k)
    return F.expr(f"case when size({a}) = 0 and size({b}) = 0 then 1.0D else cast(size(array_intersect({union}, array_intersect({a}, {b}))) as double) / size({union}) end")


def distinct(a: str, k: int = K) -> Column:
    """How many distinct shingles a sketch stands for."""
    return F.expr(f"case when size({a}) < {k} then cast(size({a}) as double) else {k - 1}D * {1 << BITS}D / greatest({a}[{k - 1}], 1) end")


def containment(a: str, b: str, k: int = K) -> Column:
    """Which share of the first text's shingles the second holds."""
    both = resemblance(a, b, k) / (1 + resemblance(a, b, k)) * (distinct(a, k) + distinct(b, k))
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), both / F.greatest(distinct(a, k), F.lit(1.0))))


def merged(df: DataFrame, keys: list[str], sketch: str, k: int = K) -> DataFrame:
    """One sketch per group: the k least distinct hashes over its rows; each task passes on k per group at most."""
    hashes = df.select(*keys, F.explode(sketch).alias("_hash")).distinct()
    first = hashes.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy("_hash"))).where(F.col("_n") <= k)
    return first.groupBy(*keys).agg(F.sort_array(F.collect_list("_hash")).alias(sketch))


def neighbours(base: DataFrame) -> DataFrame:
    """(_id, _to, _need): for each id the one before it, and how many code points that one's documents want at most."""
    ids = base.groupBy("_id").agg(F.max(F.expr("length(_text) div 4")).alias("_need"))
    ranked = stored(running_totals(ids, ["_id"], {"_rank": F.lit(1)}, "ranks"), "ranks")
    n = F.broadcast(ranked.agg(F.max("_rank").alias("_n")))
    before = ranked.join(n).select(F.col("_id").alias("_to"), "_need", F.expr("_rank % _n + 1").alias("_rank"))
    return stored(ranked.select("_id", "_rank").join(before, "_rank").select("_id", "_to", "_need"), "neighbours")


def fingerprints(docs: DataFrame, k: int = K, size: int = SIZE) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, sketch, edited_sketch, near_edited, near_next) for every row of `docs` (doc_id, text).

    The edited text has its last quarter replaced by as much of the next document's beginning. Texts are dealt by id once, for
    lending and borrowing alike; what is lent is as long as the borrower can use.
    """
    base = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("_id"), F.coalesce("text", F.lit("")).alias("_text"))
    lent = sketched(base.join(neighbours(base), "_id"), "_text", "_next", k, size)
    lent = lent.groupBy("_to").agg(F.min_by(F.struct(F.expr("left(_text, cast(_need as int))").alias("start"), "_next"), F.xxhash64("_text")).alias("_lent"))
    rows = base.join(lent, base["_id"] == lent["_to"]).withColumn("n_chars", F.length("_text").cast("long"))
    rows = rows.withColumn("_edited", F.expr("concat(left(_text, cast(n_chars - n_chars div 4 as int)), left(_lent.start, cast(n_chars div 4 as int)))"))
    rows = sketched(sketched(rows, "_text", "sketch", k, size), "_edited", "edited_sketch", k, size)
    return rows.select(
        F.nullif("_id", F.lit(_NO_ID)).alias("doc_id"), "n_chars", F.sha2("_edited", 256).alias("edited_sha256"), "sketch", "edited_sketch",
        resemblance("sketch", "edited_sketch", k).alias("near_edited"), resemblance("sketch", "_lent._next", k).alias("near_next"),
    )
