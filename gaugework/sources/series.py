"""Nested series records: one record per series with an array of samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugework.operators.joins import lookup
from gaugework.sources.files import TIME_TEXT


def flatten_series(records: DataFrame, keep: tuple[str, ...] = ("Entity", "Signal", "Unit")) -> DataFrame:
    """Nested records -> one row per sample; static records carry their one value already."""
    if records.schema["Data"].dataType.typeName() != "array":
        return records.select(*keep, F.col("Data").alias("Value"))
    return records.select(*keep, F.inline("Data"))


def records_from_json(lines: DataFrame, column: str = "value", axis: str = "Date", value: str = "double") -> DataFrame:
    """Nested records from JSON text, one per line; ``axis`` None stands for static records."""
    moment = "timestamp_ntz" if axis == "Date" else "double"
    data = f"array<struct<{axis}: {moment}, Value: {value}>>" if axis else value
    schema = f"Entity string, Signal string, Unit string, Data {data}"
    return lines.select(F.from_json(column, schema, TIME_TEXT).alias("r")).select("r.*")


def records_to_json(records: DataFrame, column: str = "value") -> DataFrame:
    return records.select(F.to_json(F.struct("*"), TIME_TEXT).alias(column))


def nest_series(
    samples: DataFrame, axis: str = "Date", keys: tuple[str, ...] = ("Entity", "Signal", "Unit"), part: Column | None = None,
) -> DataFrame:
    """Rows (keys, axis, Value) -> records with Data ordered along the axis: one per series.

    A record is one cell. Where series are too long for that, ``part`` names a bucket of the axis, such as
    the month; a series then has one record per bucket, which comes as a column ``Part``. How a series is
    cut never depends on its size.
    """
    data = F.array_sort(F.collect_list(F.struct(axis, "Value"))).alias("Data")
    if part is None:
        return samples.groupBy(*keys).agg(data)
    return samples.withColumn("Part", part).groupBy(*keys, "Part").agg(data)


def nest_by_type(samples: DataFrame, types: DataFrame, axis: str = "Date", part: Column | None = None) -> DataFrame:
    """As :func:`nest_series`, each record with its signal type for a save per type."""
    typed = lookup(samples, types.select("name", F.col("type").alias("SignalType")), [("Signal", "name")], "inner")
    return nest_series(typed, axis, ("Entity", "Signal", "Unit", "SignalType"), part)
