"""Hilbert-curve ordering: quantise several metadata dimensions, sort by the curve's index, cut runs.

Each dimension becomes a number of `BITS` bits by equal depth: the values' counts are summed in order of the value, and a value's
code says in which of 2^BITS equal parts of the rows its middle lies. Codes keep the order of the values, so a run of the
curve is a small box of each dimension, and a reader prunes files by every one of them. A value with a third of all rows has
one code, as it must.

Rows sort by (index, doc_id, text checksum). Shards are runs of the order with nearly equal bytes: a row goes to the shard in
which the middle of its bytes lies, so a shard is off by one row at each end at most. Nothing is gathered: the running sums
come from a range partitioning, and the joins carry one row per distinct value, whose size Spark knows.

Defined results: null values of a dimension form one value before all others; a null text has no bytes and counts 1; equal
rows take neighbouring places; an empty table gives an empty result; other columns play no role.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugework.functions.names import col
from gaugework.llm.frames import running_totals, stored, text_bytes

BITS = 4
LAW = "bytes"
DIMENSIONS = ("lang", "source", "size")


def bounds(df: DataFrame, name: str, bits: int) -> list[tuple]:
    """(code, least value, whether it holds null) of a column by equal depth, the largest code first; at most 2^bits rows."""
    values = df.groupBy(F.col(name).alias("value")).agg(F.count("*").alias("n"))
    upto = running_totals(values, [F.col("value").asc_nulls_first()], {"upto": F.col("n")}, "codes")
    total = upto.agg(F.max("upto").alias("total"))
    coded = upto.join(F.broadcast(total)).withColumn("code", F.expr(f"cast(((2 * upto - n) * {1 << bits}) div (2 * total) as int)"))
    found = coded.groupBy("code").agg(F.min("value").alias("least"), F.max(F.col("value").isNull()).alias("none"))
    return [tuple(r) for r in found.orderBy(F.col("code").desc()).collect()]


def code(value: Column, found: list[tuple]) -> Column:
    out = F.when(value.isNull(), F.lit(next((c for c, _, none in found if none), 0)))
    for c, least, _ in found:
        if least is not None:
            out = out.when(value >= F.lit(least), F.lit(c))
    return out.otherwise(F.lit(0))


def index(parts: list[str], bits: int) -> Column:
    """The Hilbert index of numbers of `bits` bits, by Skilling's transform: undo excess work, Gray-code, interleave."""
    n = len(parts)
    x = f"array({', '.join(f'cast({p} as int)' for p in parts)})"
    steps = ", ".join(f"struct({1 << b} as q, {i} as i)" for b in range(bits - 1, 0, -1) for i in range(n))
    swap = "((x[0] ^ x[s.i]) & (s.q - 1))"
    turned = f"aggregate(array({steps}), {x}, (x, s) -> transform(x, (v, j) -> case when (x[s.i] & s.q) <> 0 then if(j = 0, v ^ (s.q - 1), v) when j = 0 or j = s.i then v ^ {swap} else v end))" if bits > 1 else x
    gray = f"transform({turned}, (v, j) -> v)"
    gray = f"aggregate(sequence(1, {n - 1}), {gray}, (x, i) -> transform(x, (v, j) -> if(j = i, v ^ x[i - 1], v)))" if n > 1 else gray
    marks = ", ".join(str(1 << b) for b in range(bits - 1, 0, -1))
    if bits > 1:
        gray = f"aggregate(array({gray}), array(0), (none, x) -> transform(x, v -> v ^ aggregate(array({marks}), 0, (t, q) -> if((x[{n - 1}] & q) <> 0, t ^ (q - 1), t))))"
    places = ", ".join(f"struct({i} as i, {b} as b)" for b in range(bits - 1, -1, -1) for i in range(n))
    return F.expr(f"aggregate(array({gray}), 0L, (none, x) -> aggregate(array({places}), 0L, (h, p) -> h * 2 + (shiftright(x[p.i], p.b) & 1)))")


class Curve:
    """The codes of a table's dimensions and its rows in order of the curve."""

    def __init__(self, docs: DataFrame, dimensions: tuple[str, ...], bits: int):
        columns = {d: F.col(d) for d in dimensions if d != "size"}
        self.dimensions, self.bits = dimensions, bits
        rows = stored(self.keyed(docs).select("_id", "_size", "_crc", *columns), "rows")
        self.found = {d: bounds(rows, self.column(d), bits) for d in dimensions}
        self.rows = self.placed(rows).select("_id", "_size", "_crc", "_curve")

    @staticmethod
    def column(dimension: str) -> str:
        return "_size" if dimension == "size" else dimension

    @staticmethod
    def keyed(docs: DataFrame) -> DataFrame:
        return docs.withColumns({
            "_id": F.col("doc_id").cast("long"), "_size": text_bytes("text") + 1, "_crc": F.crc32(F.coalesce("text", F.lit("")).cast("binary")),
        })

    def placed(self, keyed: DataFrame) -> DataFrame:
        """Keyed rows with `_curve`."""
        names = [f"_code{i}" for i in range(len(self.dimensions))]
        coded = keyed.withColumns({n: code(F.col(self.column(d)), self.found[d]) for n, d in zip(names, self.dimensions)})
        return coded.withColumn("_curve", index(names, self.bits)).drop(*names)

    def cut(self, shards: int) -> DataFrame:
        """The narrow rows with `shard`, and `row`, the place from 1 in the whole order."""
        order = ["_curve", F.col("_id").asc_nulls_first(), "_crc"]
        at = stored(running_totals(self.rows, order, {"upto": F.col("_size"), "row": F.lit(1)}, "curve"), "placed")
        total = F.broadcast(at.agg(F.max("upto").alias("total")))
        return at.join(total).withColumn("shard", F.expr(f"cast(((2 * upto - _size) * {shards}) div (2 * total) as int)"))


def shard(docs: DataFrame, dimensions: tuple[str, ...] = DIMENSIONS, shards: int = 16, bits: int = BITS) -> DataFrame:
    """(doc_id, size, text_crc32, curve, law, shard, slot, grown_shard) for every row of `docs` (doc_id, text and the dimensions).

    `size` is the text's bytes plus 1 and may itself be a dimension; `curve` is the Hilbert index. slot counts from 0 in each
    shard. The law is that sizes are near equal, so grown_shard is null.
    """
    cut = Curve(docs, dimensions, bits).cut(shards)
    starts = F.broadcast(cut.groupBy("shard").agg(F.min("row").alias("_start")))
    return cut.join(starts, "shard").select(
        F.col("_id").alias("doc_id"), F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"), F.col("_curve").alias("curve"),
        F.lit(LAW).alias("law"), "shard", (F.col("row") - F.col("_start")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def sharded(docs: DataFrame, dimensions: tuple[str, ...] = DIMENSIONS, shards: int = 16, bits: int = BITS) -> DataFrame:
    """The rows of `docs` with `shard` and `curve`, laid out for writing: partitions are runs of the order, sorted within.

    Columns of those names, in whatever case, are replaced; all others are carried apart. Rows are compared with the least key of each shard, so whole texts move once; equal
    rows stay in one shard.
    """
    made = Curve(docs, dimensions, bits)
    key = F.struct("_curve", F.coalesce("_id", F.lit(-(1 << 63))).alias("_id"), "_crc")
    starts = made.cut(shards).groupBy("shard").agg(F.min(key).alias("least")).orderBy("shard").collect()
    at = F.lit(starts[0]["shard"] if starts else 0)
    for r in starts[1:]:
        at = F.when(key >= F.struct(*[F.lit(r["least"][c]).cast(t).alias(c) for c, t in (("_curve", "long"), ("_id", "long"), ("_crc", "long"))]), F.lit(r["shard"])).otherwise(at)
    row = F.struct(*[col(c) for c in docs.columns if c.lower() not in ("shard", "curve")]).alias("_row")
    wide = docs.select(row, *dict.fromkeys(["doc_id", "text", *[d for d in dimensions if d != "size"]]))
    order = ["_curve", "_id", "_crc"]
    placed = made.placed(made.keyed(wide)).select("_row", *order, at.alias("_shard"))
    laid = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    return laid.select("_row.*", F.col("_shard").cast("int").alias("shard"), F.col("_curve").alias("curve"))
