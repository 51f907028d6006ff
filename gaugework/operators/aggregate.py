"""Grouped aggregation by name, safe for groups that hold a large share of all rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from gaugework.functions.aggregates import algebraic, is_algebraic
from gaugework.functions.buckets import time_bucket
from gaugework.functions.names import col
from gaugework.functions.vocabulary import canonical
from gaugework.session import kept

def null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Equality over keys that may be null; still a hash or sort-merge equi-join."""
    return reduce(lambda a, b: a & b, [left[f"`{k}`"].eqNullSafe(right[f"`{k}`"]) for k in keys])


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on nullable keys, keeping one copy of them."""
    if how in ("left_semi", "left_anti"):
        return left.join(right, null_safe(left, right, keys), how)
    renamed = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [col(k).eqNullSafe(col(f"__{k}")) for k in keys])
    return left.join(renamed, on, how).drop(*[f"__{k}" for k in keys])


def exact_percentile(df: DataFrame, keys: list[str], value: str, p: float, out: str) -> DataFrame:
    """Exact interpolated percentile per group; NaN counts as the largest value, nulls are left out.

    One way for groups of every size: rows are counted per distinct value, before the shuffle; the counts are
    range-partitioned by group and value, so that a hot group lies in many partitions; ranks are sums within a
    partition plus one offset per group and partition. Nothing gathers a group.
    """
    group = [col(k) for k in keys]
    filled = F.count(F.col("__v")).alias("c")  # 0 for the null value, which only keeps the group
    counts = df.select(*group, col(value).alias("__v")).groupBy(*group, "__v").agg(filled)
    placed = kept(counts.repartitionByRange(*group, "__v").withColumn("__part", F.spark_partition_id()))
    parts = placed.groupBy(*group, "__part").agg(F.sum("c").alias("n"))
    by_group = W.partitionBy(*group)
    before = F.sum("n").over(by_group.orderBy("__part").rowsBetween(W.unboundedPreceding, -1))
    offsets = parts.select(*group, "__part", F.coalesce(before, F.lit(0)).alias("__before"), F.sum("n").over(by_group).alias("__rows"))
    within = F.sum("c").over(W.partitionBy(*group, "__part").orderBy(F.asc_nulls_first("__v")).rowsBetween(W.unboundedPreceding, -1))
    ranked = join_null_safe(placed.withColumn("__within", F.coalesce(within, F.lit(0))), offsets, [*keys, "__part"], "inner")
    first = F.col("__before") + F.col("__within")
    position = (F.col("__rows") - 1) * F.lit(p)

    def at(rank: Column) -> Column:
        return F.max(F.when((first <= rank) & (rank < first + F.col("c")), F.col("__v")))

    low, high, rest = F.col("__low"), F.col("__high"), position - F.floor(position)
    between = F.when((rest == 0) | (low == high), low).otherwise(low + rest * (high - low))
    return (
        ranked.groupBy(*group, "__rows")
        .agg(at(F.floor(position)).alias("__low"), at(F.ceil(position)).alias("__high"))
        .select(*group, between.alias(out))
    )


def deterministic_mode(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """Most frequent value, the lowest on ties; counted per value first, so no group is gathered."""
    counts = df.groupBy(*map(col, keys), col(value).alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    order = F.when(F.col("__v").isNotNull(), F.struct(-F.col("__n"), F.col("__v")))
    return counts.groupBy(*map(col, keys)).agg(F.min_by("__v", order).alias(out))


def concatenate(
    df: DataFrame, keys: list[str], value: str, axis: str, out: str, separator: str = ""
) -> DataFrame:
    """Texts of a group joined in axis order, by way of slices of the axis joined first."""
    dtype = df.schema[axis].dataType
    is_time = isinstance(dtype, (T.TimestampNTZType, T.TimestampType, T.DateType))
    part = time_bucket(col(axis), "EveryMinute") if is_time else F.floor(col(axis))
    slices = (
        df.withColumn("__s", part)
        .groupBy(*map(col, keys), "__s")
        .agg(
            F.array_sort(
                F.collect_list(F.when(col(value).isNotNull(), F.struct(col(axis).alias("a"), col(value).alias("v"))))
            ).alias("__l")
        )
        .withColumn("__t", F.when(F.size("__l") > 0, F.array_join(F.col("__l.v"), separator)))
    )
    ordered = F.array_sort(F.collect_list(F.when(F.col("__t").isNotNull(), F.struct("__s", "__t"))))
    return (
        slices.groupBy(*map(col, keys))
        .agg(ordered.alias("__l"))
        .select(
            *map(col, keys),
            F.when(F.size("__l") > 0, F.array_join(F.col("__l.__t"), separator)).alias(out),
        )
    )


def aggregate(
    df: DataFrame,
    keys: list[str],
    value: str,
    how: str,
    axis: str | None = None,
    out: str = "value",
    percentile: float = 1.0,
) -> DataFrame:
    """Aggregate ``value`` per ``keys`` by aggregation name; NoAggregation passes the rows through."""
    name = canonical("aggregation", how)
    text = isinstance(df.schema[value].dataType, T.StringType)
    if name == "NoAggregation":
        return df.select(*map(col, keys), col(value).alias(out))
    if is_algebraic(name, text):
        order = col(axis) if axis else None
        return df.groupBy(*map(col, keys)).agg(algebraic(name, col(value), order, text).alias(out))
    if name == "Mode":
        return deterministic_mode(df, keys, value, out)
    if name == "Sum" and text:
        return concatenate(df, keys, value, axis, out)
    if text:
        raise ValueError(f"aggregation {name} is not defined for text")
    p = 0.5 if name == "Median" else percentile
    return exact_percentile(df, keys, value, p, out)


def data_range(df: DataFrame, axis: str, by: list[str] | None = None) -> DataFrame:
    """First and last axis value, per group or overall; nulls are ignored."""
    ends = [F.min(axis).alias("range_start"), F.max(axis).alias("range_end")]
    return df.groupBy(*by).agg(*ends) if by else df.agg(*ends)


def merge_ranges(ranges: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Earliest start and latest end over many ranges."""
    ends = [F.min("range_start").alias("range_start"), F.max("range_end").alias("range_end")]
    return ranges.groupBy(*by).agg(*ends) if by else ranges.agg(*ends)


def first_in_order(df: DataFrame, keys: list[str], value: str, row_id: str, out: str = "value") -> DataFrame:
    """Value of the first row per group in file order, null included; order is an explicit row id."""
    return df.groupBy(*map(col, keys)).agg(F.min_by(col(value), col(row_id)).alias(out))


def distinct_names(df: DataFrame, name: str) -> DataFrame:
    """Unique non-empty names."""
    return df.select(col(name)).where(col(name).isNotNull() & (col(name) != "")).distinct()
