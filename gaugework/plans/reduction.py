"""Many signals at once: one state per index and signal, turned into columns when the rows are reduced."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugework.functions.aggregates import algebraic
from gaugework.functions.names import col
from gaugework.operators.aggregate import aggregate
from gaugework.session import literal_table

# Up to this many columns one grouping with an expression per column is the shorter plan.
WIDE = 32
HEAD, VALUE = "__head", "__value"
_SPEC_SCHEMA = f"signal string, {HEAD} string, __scale double, __shift double"


def by_header(rows: DataFrame, specs: list) -> DataFrame:
    """Each sample once per wanted column of its signal, in that column's unit: ``__head`` and ``__value``.

    The factors are a table written in code, one row per wanted column, and meet the samples in the scan stage. A signal that
    is wanted in several units gives a row for each; samples of other signals fall away. All specs are of numbers or all of texts.
    """
    factors = literal_table(rows.sparkSession, [(s.name, s.header, s.scale, s.shift) for s in specs], _SPEC_SCHEMA)
    as_is = (F.col("__scale") == 1.0) & (F.col("__shift") == 0.0)
    number = F.when(as_is, F.col("value_num")).otherwise(F.col("value_num") * F.col("__scale") + F.col("__shift"))
    value = F.col("value_str") if specs[0].text else number
    return rows.join(F.broadcast(factors), "signal").withColumn(VALUE, value).drop("__scale", "__shift")


def as_columns(long: DataFrame, index: list[str], heads: list[str]) -> DataFrame:
    """Rows of (index, ``__head``, ``__value``), one each, as one column per header; the headers are known, so nothing is looked up."""
    return long.groupBy(*map(col, index)).pivot(HEAD, heads).agg(F.max(VALUE))


def reduced(rows: DataFrame, index: list[str], specs: list, axis: str) -> DataFrame:
    """Numeric signals with mergeable aggregations: combined before the shuffle, pivoted afterwards.

    A row updates one buffer of its (index, signal), which holds a fixed number of states whatever the number of signals. The second
    shuffle moves reduced rows only. A count is 0 where its signal has no sample but another one has.
    """
    by_how: dict[str, list[str]] = {}
    for s in specs:
        by_how.setdefault(s.interval_agg, []).append(s.header)
    states = [algebraic(how, F.col(VALUE), col(axis)).cast("double").alias(f"__s{i}") for i, how in enumerate(by_how)]
    long = by_header(rows, specs).groupBy(*map(col, index), HEAD).agg(*states)
    value: Column = F.col("__s0")
    for i, heads in enumerate(by_how.values()):
        if i:
            value = F.when(F.col(HEAD).isin(heads), F.col(f"__s{i}")).otherwise(value)
    table = as_columns(long.withColumn(VALUE, value), index, [s.header for s in specs])
    return table.withColumns({h: F.coalesce(col(h).cast("bigint"), F.lit(0)) for h in by_how.get("Count", [])})


def of_one_kind(rows: DataFrame, index: list[str], specs: list, how: str, axis: str) -> DataFrame:
    """Signals that share an aggregation without a fixed-size state, aggregated together in one pass over their samples."""
    done = aggregate(by_header(rows, specs), [*index, HEAD], VALUE, how, axis, out=VALUE)
    return as_columns(done, index, [s.header for s in specs])
