"""Mixing sources to target weights: packed blocks, drawn by index.

The words of a source form one stream, documents in order of a keyed hash, cut into blocks of `block` words; the last may be
short. The mix is a sequence of slots in output shards. How many slots a source has follows from its target; how many of them each
shard gets is a multinomial draw, and the slots are numbered shard by shard from these counts. Slot number j of a source reads the block number
π(j mod n) of its n blocks, where π is a pseudorandom permutation of the indices that differs by source and by pass (a
swap-or-not shuffle, which needs no table of length n). Every pass goes over all blocks once, so a block is read at most
⌈slots / n⌉ times, and no document more than twice as its target is at most twice its source.

Everything is DataFrame operations: intervals by running totals over a range partitioning, and one join by (source, block
index), which spreads a source of any size.

Defined results: a null or blank text has size 0 and is never taken. Null is a source of its own. Repeated rows and
repeated ids are documents of their own; with equal ids the hash and the text order them, and equal rows share alike by
position. An empty table gives an empty result. Other columns play no
role; `mixed_documents` passes them through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugework.llm.frames import WORD, running_totals
from gaugework.session import literal_table

WEIGHTS = (3, 1, 2)
SHARES = 1 << 30  # of a document, in which rounding is carried on
ROUNDS = 8  # of the shuffle; each moves about half of the indices


def number(*parts: str) -> str:
    """SQL for a 48-bit number drawn from the parts; the same in every engine that has md5 and hexadecimal conversion."""
    return f"cast(conv(substr(md5(concat_ws(':', {', '.join(parts)})), 1, 12), 16, 10) as bigint)"


def words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: list[tuple], weights: tuple = WEIGHTS, share: float = 1.5, least: float = 0.0, most: float = 2.0) -> list[float]:
    """Words wanted of each source: `share` of all words by weight, from `least` to `most` times the source's size.

    What a bound takes or gives is shared again among the others by weight. `sizes` holds (source, words) in order of the
    source; the weights repeat along it.
    """
    budget = share * sum(n for _, n in sizes)
    weight = {i: float(weights[i % len(weights)]) for i in range(len(sizes))}
    out, open_ = [0.0] * len(sizes), {i for i, (_, n) in enumerate(sizes) if n > 0}
    while open_:
        per = (budget - sum(out)) / sum(weight[i] for i in open_)
        over = {i for i in open_ if per * weight[i] > most * sizes[i][1]}
        under = set() if over else {i for i in open_ if per * weight[i] < least * sizes[i][1]}
        for i in over | under:
            out[i] = float((most if over else least) * sizes[i][1])
        if not over | under:
            for i in open_:
                out[i] = per * weight[i]
            break
        open_ -= over | under
    return out


def shuffled(index: str, n: str, *key: str) -> str:
    """SQL for the place of `index` in a keyed permutation of 0 .. n - 1."""
    # aggregate() carries the place; each round pairs it with its mirror image and a drawn bit, common to both, says whether to swap.
    pivot = number("'p'", *key, "cast(r as string)") + f" % {n}"
    mirror = f"pmod({pivot} - x, {n})"
    return f"aggregate(sequence(1, {ROUNDS}), cast({index} as bigint), (x, r) -> if({number(chr(39) + 's' + chr(39), *key, 'cast(r as string)', f'cast(greatest(x, {mirror}) as string)')} % 2 = 1, {mirror}, x))"


def intervals(docs: DataFrame, seed: int) -> DataFrame:
    """Documents with size and their words' place [first, last) in the stream of their source."""
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), words("text").alias("size"),
        F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary")).alias("_order"),
        F.xxhash64("text").alias("text_key"),
    )
    order = [F.col("source").asc_nulls_first(), "_order", "doc_id", "text_key"]
    return running_totals(keyed, order, {"upto": F.col("size"), "row": F.lit(1)}, "intervals").drop("_order")


def plan(placed: DataFrame, block: int, weights: tuple, share: float, least: float, most: float) -> DataFrame:
    """One row per source, gathered on the driver as the configured weights are: sizes, target, blocks and slots."""
    found = placed.groupBy("source").agg(F.sum("size").alias("n"), F.min(F.col("upto") - F.col("size")).alias("base")).collect()
    sizes = sorted(((r["source"], r["n"], r["base"]) for r in found), key=lambda r: (r[0] is None, r[0] or ""))
    rows = []
    for at, ((source, n, base), target) in enumerate(zip(sizes, targets([r[:2] for r in sizes], weights, share, least, most))):
        blocks = -(-n // block)
        rows.append((source, at, n, base, target, blocks, int(target * blocks / n + 0.5) if n else 0))
    schema = "source string, source_no long, source_size long, base long, target double, blocks long, slots long"
    return literal_table(placed.sparkSession, rows, schema)


def numbered(rows: DataFrame, by: list[str]) -> DataFrame:
    """Rows with `slots` numbers each from `first` on, as `slot`; spread over the cluster in pieces."""
    step = 1 << 12
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a given number is not coalesced
    many = rows.where("slots > 0").select(*by, "first", "slots", F.explode(F.expr(f"sequence(0L, (slots - 1) div {step})")).alias("_far"))
    return many.repartition(parts, *by, "_far").select(
        *by, F.explode(F.expr(f"sequence(first + _far * {step}, first + least(slots, (_far + 1) * {step}) - 1)")).alias("slot"),
    )


def drawn_counts(sources: DataFrame, shards: int, seed: int) -> DataFrame:
    """(source_no, blocks, shard, slots, first): how many slots of a source each output shard gets, a multinomial draw of as many
    trials as the source has slots; `first` numbers a shard's slots after those of the shards before it."""
    source, trial, key = "cast(source_no as string)", "cast(slot as string)", f"'{seed}'"
    trials = numbered(sources.withColumn("first", F.lit(0).cast("long")), ["source_no", "blocks"])
    shard = F.expr(f"{number(chr(39) + 'd' + chr(39), key, source, trial)} % {shards}").cast("int").alias("shard")
    counts = trials.groupBy("source_no", "blocks", shard).agg(F.count("*").alias("slots"))
    before = Window.partitionBy("source_no").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("first", F.coalesce(F.sum("slots").over(before), F.lit(0).cast("long")))


def slots(sources: DataFrame, shards: int, seed: int) -> DataFrame:
    """(source_no, slot, shard, place, block_no): every slot of the mix, its output shard and the block it reads.

    `place` orders the slots of a shard.
    """
    each = numbered(drawn_counts(sources, shards, seed), ["source_no", "blocks", "shard"])
    source, slot, key = "cast(source_no as string)", "cast(slot as string)", f"'{seed}'"
    turned = each.withColumn("_pass", F.expr("cast(slot div blocks as string)"))
    return turned.select(
        "source_no", "slot", "shard",
        F.expr(number("'o'", key, source, slot)).alias("place"),
        F.expr(shuffled("slot % blocks", "blocks", key, source, "_pass")).alias("block_no"),
    )


def pieces(placed: DataFrame, sources: DataFrame, block: int) -> DataFrame:
    """Documents with the source's figures, one row for each block they reach into; `words` of the document lie in it."""
    at = placed.withColumnRenamed("source", "_source").join(sources, F.col("_source").eqNullSafe(F.col("source"))).drop("_source")
    at = at.withColumns({"first": F.expr("upto - size - base"), "last": F.expr("upto - base")})
    cut = at.withColumn("block_no", F.explode_outer(F.expr(f"if(size > 0, sequence(first div {block}, (last - 1) div {block}), null)")))
    return cut.withColumn("words", F.expr(f"least(last, (block_no + 1) * {block}) - greatest(first, block_no * {block})"))


def mix(docs: DataFrame, block: int = 128, shards: int = 16, weights: tuple = WEIGHTS, share: float = 1.5, least: float = 0.0, most: float = 2.0, seed: int = 1) -> DataFrame:
    """(doc_id, text_key, source, size, source_size, target, taken) for every row of `docs` (doc_id, text, source)."""
    placed = intervals(docs, seed)
    sources = plan(placed, block, weights, share, least, most)
    reads = slots(sources, shards, seed).groupBy("source_no", "block_no").agg(F.count("*").alias("reads"))
    # The hint: Spark takes the slots for as few as the sources they grow from, and would broadcast them.
    joined = pieces(placed, sources, block).join(reads.hint("merge"), ["source_no", "block_no"], "left")
    taken = F.sum(F.coalesce(F.col("words") * F.col("reads"), F.lit(0))).cast("long").alias("taken")
    return joined.groupBy("row", "doc_id", "text_key", "source", "size", "source_size", "target").agg(taken).drop("row")


def packed(docs: DataFrame, block: int = 128, shards: int = 16, weights: tuple = WEIGHTS, share: float = 1.5, least: float = 0.0, most: float = 2.0, seed: int = 1) -> DataFrame:
    """The mix itself: one row per slot with `shard`, `place`, `source`, `block_no` and `parts`, the words in stream order.

    A part names the document and the words [from, to) of it; a block has at most `block` parts.
    """
    placed = intervals(docs, seed)
    sources = plan(placed, block, weights, share, least, most)
    part = F.struct("first", F.col("doc_id"), F.expr(f"greatest(block_no * {block} - first, 0)").alias("from"), F.expr(f"least(last, (block_no + 1) * {block}) - first").alias("to"))
    blocks = pieces(placed, sources, block).where("words > 0").groupBy("source_no", "source", "block_no").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    drawn = slots(sources, shards, seed).hint("merge").join(blocks, ["source_no", "block_no"])
    return drawn.select("shard", "place", "source", "slot", "block_no", F.expr("transform(parts, p -> struct(p.doc_id, p.from, p.to))").alias("parts"))


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The rows of `docs`, each as many times as the mix takes it, rounded up or down.

    What rounding one document gives or takes is carried on to the next of its source, in order of size. So a source's words differ
    from those the mix takes by at most those of its longest document; rows with equal id, text and source round alike and count as one.
    """
    key = ["_text_key", "_no_id", "_id", "_no_source", "_source"]
    no_source, source = F.col("source").isNull().alias("_no_source"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("_source")
    taken = mix(docs, **settings).groupBy(
        F.col("text_key").alias("_text_key"), F.col("doc_id").isNull().alias("_no_id"), F.coalesce("doc_id", F.lit(0)).alias("_id"), no_source, source,
    ).agg(F.sum("taken").alias("_taken"), F.sum("size").alias("_size")).where("_taken > 0")
    part = F.expr(f"(_taken % _size) * {SHARES} div _size")
    placed = running_totals(taken.withColumn("_part", part), ["_no_source", "_source", "_size", "_id", "_no_id", "_text_key"], {"_upto": F.col("_part")}, "rounded")
    half = SHARES // 2
    times = placed.select(*key, F.expr(f"cast(_taken div _size + (_upto + {half}) div {SHARES} - (_upto - _part + {half}) div {SHARES} as int)").alias("_times"))
    keyed = docs.select(
        F.struct("*").alias("_row"), F.xxhash64("text").alias("_text_key"), F.col("doc_id").isNull().alias("_no_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")).alias("_id"), no_source, source,
    )  # the caller's columns apart, whatever their names
    repeated = keyed.join(times.where("_times > 0"), key)
    return repeated.select("_row", F.explode(F.expr("sequence(1, _times)"))).select("_row.*")
