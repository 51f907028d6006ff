"""Joins of many rows with a lookup side, safe for keys that hold a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugework.session import kept

# A lookup side up to this many rows and bytes is broadcast.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20
# Beyond it, keys that are frequent in a sample of the rows are spread over SALTS tasks each.
SALTS = 64
SAMPLE_FRACTION = 0.01
SAMPLE_HITS = 1_000
HOT_KEYS = 1_000


def fits(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether a side is small enough to broadcast: at most so many rows, and at most BROADCAST_BYTES of them.

    The optimizer's size of a file scan is the compressed size, which says little about rows. So rows are counted, but never past the
    limit; only a table written in code, whose size the optimizer knows, needs no job.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    if rows == BROADCAST_ROWS and plan.nodeName() == "LocalRelation" and int(str(plan.stats().sizeInBytes())) <= BROADCAST_BYTES:
        return True
    most = min(rows, BROADCAST_BYTES // max(1, df._jdf.schema().defaultSize()))
    return df.select(F.lit(1)).limit(most + 1).count() <= most


def salt(df: DataFrame, salts: int = SALTS) -> Column:
    """A row's salt. It depends on the row and its partition only, so a retried task gives the same."""
    hashable = [F.col(f"`{f.name}`") for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return F.pmod(F.xxhash64(*hashable) + F.spark_partition_id(), F.lit(salts))


def frequent_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The most frequent keys of a sample, at most HOT_KEYS of them, stored so that every use sees the same.

    It only decides how work is spread, never what a join returns.
    """
    counts = rows.select(*[F.col(f"`{k}`") for k in keys]).sample(SAMPLE_FRACTION, seed=7).groupBy(*[f"`{k}`" for k in keys])
    hot = counts.count().where(F.col("count") >= SAMPLE_HITS).orderBy(F.desc("count")).limit(HOT_KEYS)
    return kept(hot.drop("count"))


def _equal(left: list[str], right: list[str], null_safe: bool) -> Column:
    pairs = [(F.col(f"`{a}`"), F.col(f"`{b}`")) for a, b in zip(left, right)]
    return reduce(lambda x, y: x & y, [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])


def _salted(rows: DataFrame, side: DataFrame, keys: list[str], side_keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``__salt`` / ``__side_salt``: frequent keys spread, all others in one place."""
    names = [f"__hot{i}" for i in range(len(keys))]
    hot = F.broadcast(frequent_keys(rows, keys).toDF(*names).withColumn("__is_hot", F.lit(True)))
    drop = [*names, "__is_hot"]
    left = rows.withColumn("__row_salt", salt(rows)).join(hot, _equal(keys, names, True), "left")
    left = left.withColumn("__salt", F.when(F.col("__is_hot"), F.col("__row_salt")).otherwise(F.lit(0))).drop("__row_salt", *drop)
    every = F.sequence(F.lit(0), F.lit(SALTS - 1))
    right = side.join(hot, _equal(side_keys, names, True), "left")
    spread = F.when(F.col("__is_hot"), every).otherwise(F.array(F.lit(0)))
    return left, right.withColumn("__side_salt", F.explode(spread)).drop(*drop)


def lookup(
    rows: DataFrame,
    side: DataFrame,
    on: list[str] | list[tuple[str, str]],
    how: str = "left",
    null_safe: bool = False,
    condition: Column | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join ``rows`` with a lookup side; the side's key columns are dropped.

    A side of a checked size is broadcast, so rows are not shuffled at all. With a larger one, keys that
    are frequent among the rows are joined on (key, salt), the side's row repeated per salt: a hot key is
    spread over many tasks, and a grouping on the same key afterwards combines early instead of
    inheriting the join's partitioning. ``condition`` may use columns of both sides by their names.
    """
    pairs = [(k, k) if isinstance(k, str) else k for k in on]
    keys, side_keys = [a for a, _ in pairs], [f"__side{i}" for i in range(len(pairs))]
    other = side.withColumnsRenamed({b: n for (_, b), n in zip(pairs, side_keys)})
    match, extra = _equal(keys, side_keys, null_safe), []
    if fits(side, broadcast_rows):
        other = F.broadcast(other)
    else:
        rows, other = _salted(rows, other, keys, side_keys)
        extra = ["__salt", "__side_salt"]
        match = match & (F.col("__salt") == F.col("__side_salt"))
    if condition is not None:
        match = match & condition
    return rows.join(other, match, how).drop(*side_keys, *extra)
