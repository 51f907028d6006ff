"""First and last values, interpolation, regular grids and newest-wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from gaugework.functions.buckets import TIME_STEP_INTERVALS, time_bucket
from gaugework.functions.names import col
from gaugework.functions.vocabulary import canonical
from gaugework.operators.joins import salt

# Up to this N Spark limits each group before the shuffle by itself.
_GROUP_LIMIT = 1000
_SALTS = 64


def first_values(df: DataFrame, keys: list[str], axis: str, n: int, ties: tuple[str, ...] = ()) -> DataFrame:
    """The first N rows per group along the axis, or the last N when N is negative."""
    direction = F.asc_nulls_last if n > 0 else F.desc_nulls_last
    order = [direction(c) for c in (axis, *ties)]
    rows, group = df, list(map(col, keys))
    if abs(n) > _GROUP_LIMIT:
        rows = (
            df.withColumn("__salt", salt(df, _SALTS))
            .withColumn("__n", F.row_number().over(W.partitionBy(*group, "__salt").orderBy(*order)))
            .where(F.col("__n") <= abs(n))
            .drop("__salt", "__n")
        )
    ranked = rows.withColumn("__n", F.row_number().over(W.partitionBy(*group).orderBy(*order)))
    return ranked.where(F.col("__n") <= abs(n)).drop("__n")


def interpolate_at(df: DataFrame, keys: list[str], axis: str, value: str, point: float, out: str = "value") -> DataFrame:
    """Value at a point of a numeric axis, linear between its neighbours, null outside the range."""
    a, v = col(axis), col(value)
    sample = F.struct(a.alias("a"), v.alias("v"))
    known = v.isNotNull()
    near = df.groupBy(*map(col, keys)).agg(
        F.max(F.when(known & (a <= point), sample)).alias("lo"),
        F.min(F.when(known & (a >= point), sample)).alias("hi"),
    )
    low, high = F.col("lo"), F.col("hi")
    slope = (high["v"] - low["v"]) / F.nullif(high["a"] - low["a"], F.lit(0.0))
    return near.select(
        *map(col, keys),
        F.when(low["a"] == point, low["v"])
        .when(high["a"] == point, high["v"])
        .otherwise(low["v"] + slope * (point - low["a"]))
        .alias(out),
    )


def _grid(keys: DataFrame, start: Column, end: Column, step: str, out: str) -> DataFrame:
    """Times from start to end; below a day the days are exploded first, so no array grows long."""
    interval = F.expr(TIME_STEP_INTERVALS[step])
    if step in ("Daily", "Monthly", "Quarterly", "Yearly"):
        return keys.withColumn(out, F.explode(F.sequence(start, end, interval)))
    days = keys.withColumns({"__s": start, "__e": end}).withColumn(
        "__d", F.explode(F.sequence(F.col("__s").cast("date"), F.col("__e").cast("date"), F.expr("INTERVAL 1 DAY")))
    )
    midnight = F.col("__d").cast("timestamp_ntz")
    last = midnight + F.expr("INTERVAL 1 DAY") - interval
    return (
        days.withColumn(out, F.explode(F.sequence(midnight, last, interval)))
        .where(F.col(out).between(F.col("__s"), F.col("__e")))
        .drop("__s", "__e", "__d")
    )


def fill_grid(
    resampled: DataFrame,
    keys: list[str],
    date: str,
    value: str,
    step: str,
    gap,
    start: Column | None = None,
    end: Column | None = None,
) -> DataFrame:
    """A regular time grid per group with ``gap`` where no value is known.

    ``resampled`` has one row per group and bucket. Open ends are taken from each group's own range. Each row looks at the next of its
    group and stands for the buckets up to it, the first row also for those before and the last for those after it; only the missing ones
    are made, and nothing is joined.
    """
    name, by = canonical("time increment", step), W.partitionBy(*map(col, keys)).orderBy(date)
    following, previous = F.lead(date).over(by), F.lag(date).over(by)
    placed = resampled.withColumns({"__own": col(date), "__next": following, "__is_first": previous.isNull()})
    first = time_bucket(start, name) if start is not None else F.col("__own")
    last = time_bucket(end, name) if end is not None else F.col("__own")
    # A row's buckets begin at its own, or at the grid's first; they end before the next row's, or at the grid's last.
    begins = F.greatest(F.when(F.col("__is_first"), first).otherwise(F.col("__own")), first) if start is not None else F.col("__own")
    ends = F.coalesce(F.least(F.col("__next"), last) if end is not None else F.col("__next"), last)
    spans = placed.withColumns({"__first": begins, "__last": ends}).where(F.col("__first") <= F.col("__last")).drop(date)
    grid = _grid(spans, F.col("__first"), F.col("__last"), name, date)
    mine = F.when(col(date) == F.col("__own"), col(value))
    made = grid.where(F.col("__next").isNull() | (col(date) < F.col("__next")))
    filled = made.withColumn(value, F.coalesce(mine, F.lit(gap).cast(resampled.schema[value].dataType)))
    others = [c for c in resampled.columns if c not in (*keys, date, value)]
    kept_cells = {c: F.when(col(date) == F.col("__own"), col(c)) for c in others}
    return filled.withColumns(kept_cells).select(*map(col, [*keys, date]), *map(col, [c for c in resampled.columns if c not in (*keys, date)]))


def newest(df: DataFrame, keys: list[str], batch: str) -> DataFrame:
    """One row per key, the one of the highest batch; a fixed-size buffer, so repeated keys combine early."""
    others = [c for c in df.columns if c not in keys and c != batch]
    best = F.max_by(F.struct(*map(col, others)), col(batch)).alias("__r")
    top = df.groupBy(*map(col, keys)).agg(best, F.max(col(batch)).alias("__b"))
    return top.select(*map(col, keys), *[F.col(f"__r.`{c}`") for c in others], F.col("__b").alias(batch)).select(*map(col, df.columns))
