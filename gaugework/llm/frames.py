"""Shared pieces: tables, stored results, running totals over a sorted table, iteration over Arrow batches."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugework.session import literal_table, new_folder

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Shuffle files of a written result go with its job; otherwise they stay until the driver happens to collect its garbage.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a result once into the shared folder and read it back.

    Lineage ends here, lost executors cost nothing, and Spark knows the size of what it reads, so that it decides by itself
    whether a side is small enough to broadcast.
    """
    spark = df.sparkSession
    folder = new_folder(spark, label)
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        df.write.parquet(folder)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES_GO)
        else:
            spark.conf.set(SHUFFLES_GO, before)
    if (held := getattr(_blocks, "held", None)) is not None:
        held.append(folder)
    out = spark.read.schema(df.schema).parquet(folder)
    out._folder = folder
    return out


_blocks = threading.local()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A block at whose end the files of what was `stored` in it are deleted.

    Results that are read later go through the function it gives, as `stored` returned them; they fall to the block around it, if any.
    """
    around, held = getattr(_blocks, "held", None), []
    _blocks.held = held

    def keep(df: DataFrame) -> DataFrame:
        if df._folder in held:
            held.remove(df._folder)
            if around is not None:
                around.append(df._folder)
        return df

    try:
        yield keep
    finally:
        _blocks.held = around
    for folder in held:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


KEY_WORDS = 1 << 20  # words of 64 bits that are broadcast at most to tell keys apart


def possible_keys(rows: DataFrame, keys: DataFrame, on: Sequence[str], most: int = KEY_WORDS) -> tuple[DataFrame, DataFrame]:
    """`rows` in two parts: those whose values of `on` may be among `keys`, and those whose values surely are not.

    A key sets three bits of one word, with eight bits or more for each key up to `most` words in all; with more keys than those hold, most rows land in
    the first part. Null is a value like any other. So wide rows that match nothing need not be shuffled to find that out.
    """
    words = 1 << min(most - 1, max(1, keys.count() // 8)).bit_length()
    h, free = F.xxhash64(*on), free_name(rows, "_word")
    word = lambda: F.pmod(F.shiftrightunsigned(h, 20), F.lit(words)).cast("long")
    bits = F.lit(0).cast("long")
    for at in (0, 6, 12):
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, at).bitwiseAND(F.lit(63)).cast("int")))
    table = keys.select(word().alias(free), bits.alias("bits")).groupBy(free).agg(F.bit_or("bits").alias(f"{free}s"))
    marked = rows.withColumn(free, word()).join(F.broadcast(table), free, "left")
    held = F.coalesce(F.col(f"{free}s").bitwiseAND(bits) == bits, F.lit(False))
    return tuple(marked.where(x).select(*rows.columns) for x in (held, ~held))


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with underscores after it until no column of `df` has it in whatever case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered_columns(df: DataFrame) -> DataFrame:
    """Columns named by their place, as mapInArrow takes no names with dots."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def text_bytes(column: str | Column) -> Column:
    """UTF-8 bytes of a text, none for null."""
    return F.coalesce(F.octet_length(column), F.lit(0)).cast("long")


def id_crc(name: str) -> Column:
    """crc32 of an id written as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary"))


def running_totals(df: DataFrame, order: Sequence[str | Column], totals: dict[str, Column], label: str) -> DataFrame:
    """`df` with, for each total, the sum over all rows up to and including the row in the given order.

    Rows are range-partitioned; sums run within a partition, and one offset per partition (a table as long as there are
    partitions) is added. Column names starting with ``_rt_`` are reserved. Ties take any order.
    """
    spark = df.sparkSession
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "*", F.spark_partition_id().alias("_rt_part"), F.monotonically_increasing_id().alias("_rt_seq"),
        *[c.cast("long").alias(f"_rt_{k}") for k, c in totals.items()],
    )
    within = "PARTITION BY _rt_part ORDER BY _rt_seq ROWS UNBOUNDED PRECEDING"
    summed = stored(
        placed.select("*", *[F.expr(f"sum(_rt_{k}) OVER ({within})").alias(k) for k in totals]).drop(*[f"_rt_{k}" for k in totals], "_rt_seq"),
        label,
    )
    parts = sorted(
        (r["_rt_part"], [r[k] for k in totals]) for r in summed.groupBy("_rt_part").agg(*[F.max(k).alias(k) for k in totals]).collect()
    )
    offsets, so_far = [], [0] * len(totals)
    for part, last in parts:
        offsets.append((part, *so_far))
        so_far = [a + b for a, b in zip(so_far, last)]
    names = [f"_rt_{k}" for k in totals]
    schema = ", ".join(["_rt_part int", *[f"{n} long" for n in names]])
    shift = F.broadcast(literal_table(spark, offsets, schema))
    return summed.join(shift, "_rt_part").withColumns({k: F.col(k) + F.col(f"_rt_{k}") for k in totals}).drop("_rt_part", *names)


def binary_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text or binary column, and the rows' offsets into them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0]:at[-1]], at - at[0]


def runs(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges holding about `most` bytes each, one row at least; no row is cut."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1)
        yield row, stop
        row = stop


def text_runs(column: pa.Array, most: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of a column, in runs of about `most` bytes."""
    data, offsets = binary_column(column)
    for a, b in runs(offsets, most):
        yield a, b, data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]


def vector_sums(rows: DataFrame, parts: int = 64) -> DataFrame:
    """(k, v): the sums of float32 vectors `v` (binary) by key `k`. A task adds as it reads and holds one vector per key."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for k, v in zip(b.column(0).to_pylist(), b.column(1)):
                v = np.frombuffer(v.as_buffer(), np.float32)
                if k in total:
                    total[k] += v
                else:
                    total[k] = v.astype(np.float64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int64()), pa.array([v.astype(np.float32).tobytes() for v in total.values()], pa.binary())], names=["k", "v"],
        )

    return rows.select(F.col("k").cast("long").alias("k"), "v").repartition(parts, "k").mapInArrow(add, "k long, v binary")
