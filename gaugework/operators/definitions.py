"""Definition tables: entities, signals, items and typed parameters."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugework.functions.names import short_name
from gaugework.functions.vocabulary import canonical_column
from gaugework.operators.joins import lookup

ENTITY_SCHEMA = "name string, type string, alias string, is_opportunity boolean"
SIGNAL_SCHEMA = (
    "name string, short_name string, type string, unit string, measurement string, "
    "hierarchy_agg string, interval_agg string"
)
PARAMETER_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("value_type", T.StringType()),
        T.StructField("num", T.DoubleType()),
        T.StructField("unit", T.StringType()),
        T.StructField("str", T.StringType()),
        T.StructField("list", T.ArrayType(T.StringType())),
        T.StructField("dict", T.MapType(T.StringType(), T.StringType())),
        T.StructField("enum", T.MapType(T.StringType(), T.IntegerType())),
        T.StructField("description", T.StringType()),
    ]
)


def with_defaults(signals: DataFrame) -> DataFrame:
    """Signal definitions with the model's defaults and canonical names filled in."""
    return signals.select(
        "name",
        short_name(F.col("short_name"), F.col("name")).alias("short_name"),
        F.coalesce(canonical_column("signal type", F.nullif("type", F.lit(""))), F.lit("Static")).alias("type"),
        F.coalesce(F.nullif("unit", F.lit("")), F.lit(" ")).alias("unit"),
        F.coalesce(F.nullif("measurement", F.lit("")), F.lit("Dimensionless")).alias("measurement"),
        *[
            F.coalesce(canonical_column("aggregation", F.coalesce(F.col(c), F.lit("")), strict=False), F.lit("Sum")).alias(c)
            for c in ("hierarchy_agg", "interval_agg")
        ],
    )


def upsert_by_name(existing: DataFrame, new: DataFrame, by: list[str] | None = None) -> DataFrame:
    keys = by or ["name"]
    return existing.join(new, keys, "left_anti").unionByName(new)


def delete_by_name(existing: DataFrame, names: DataFrame, by: list[str] | None = None) -> DataFrame:
    return existing.join(names, by or ["name"], "left_anti")


def remapped(c: str, mapping: DataFrame, df: DataFrame) -> DataFrame:
    """Replace values found in a (old, new) mapping; the rest stays."""
    m = mapping.select("old", F.col("new").alias("__new"))
    return lookup(df, m, [(c, "old")]).withColumn(c, F.coalesce("__new", c)).drop("__new")


def rename_everywhere(tables: dict[str, DataFrame], old: str, new: str, columns: dict[str, str]) -> dict[str, DataFrame]:
    """Rename one entity (or type) in every table that holds it; ``columns`` names the column per table."""
    return {
        t: df.withColumn(columns[t], F.when(F.col(columns[t]) == old, new).otherwise(F.col(columns[t]))) if t in columns else df
        for t, df in tables.items()
    }


def signal_attributes(signals: DataFrame, units: DataFrame) -> DataFrame:
    """Each signal with its type, storage unit and every unit of its measurement."""
    u = units.select("measurement", F.col("name").alias("unit_name"))
    return signals.select("name", "type", "measurement", F.col("unit").alias("storage_unit")).join(u, "measurement")


def last_wins(entries: Column) -> Column:
    """An array of (key, value) entries as a map in which the last entry of a key counts."""
    def is_last(entry: Column, at: Column) -> Column:
        later = F.slice(entries, at + 2, F.size(entries))
        return ~F.exists(later, lambda other: other["key"] == entry["key"])

    return F.map_from_entries(F.filter(entries, is_last))


def enumeration(values: Column) -> Column:
    """A list of labels -> label to running id, the last place of a repeated label."""
    return last_wins(F.transform(values, lambda v, i: F.struct(v.alias("key"), i.alias("value"))))


def _running_ids(labels: tuple) -> dict[str, int]:
    """Label to id: a label's own id where it comes as (label, id), else one more than the one before."""
    ids, following = {}, 0
    for entry in labels:
        label, *own = entry if isinstance(entry, (tuple, list)) else (entry,)
        ids[str(label)] = int(own[0]) if own else following
        following = ids[str(label)] + 1
    return ids


# What each kind of Python value fills in; the first that fits counts.
_FILLED = (
    (str, lambda v, unit: {"value_type": "String", "str": v}),
    ((int, float), lambda v, unit: {"value_type": "NumericWithUnit" if unit else "Numeric", "num": float(v), "unit": unit or None}),
    (dict, lambda v, unit: {"value_type": "Dictionary", "dict": dict(zip(map(str, v), map(str, v.values())))}),
    (tuple, lambda v, unit: {"value_type": "Enumeration", "enum": _running_ids(v)}),
    (list, lambda v, unit: {"value_type": "List", "list": list(map(str, v))}),
)


def parameter(name: str, value: Any, unit: str = "", description: str = "") -> dict[str, Any]:
    """One parameter row; the type follows from the Python value."""
    filled = next((fill for kind, fill in _FILLED if isinstance(value, kind)), None)
    if filled is None:
        raise TypeError(f"no parameter type for {type(value).__name__}")
    return dict.fromkeys(PARAMETER_SCHEMA.names) | {"name": name, "description": description} | filled(value, unit)


def parameter_text(parameters: DataFrame) -> DataFrame:
    """Each parameter's value in one text column, by its type."""
    return parameters.select(
        "name",
        "value_type",
        F.when(F.col("value_type").isin("Numeric", "NumericWithUnit"), F.col("num").cast("string"))
        .when(F.col("value_type") == "String", F.col("str"))
        .when(F.col("value_type") == "List", F.to_json("list"))
        .when(F.col("value_type") == "Dictionary", F.to_json("dict"))
        .when(F.col("value_type") == "Enumeration", F.to_json("enum"))
        .alias("value"),
    )


def pairs_to_map(df: DataFrame, by: list[str], columns: list[str], row_id: str) -> DataFrame:
    """A pair list per group as one map: keyed by the first column, the last of repeated keys in order of ``row_id``
    counting, or by position when there is only one.

    The map is one cell, so the groups must be small lists (the attributes of one definition).
    """
    if len(columns) > 1:
        key, value = (F.col(c).cast("string") for c in columns[:2])
        last = df.groupBy(*by, key.alias("key")).agg(F.max_by(value, row_id).alias("value"))
        return last.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("pairs"))
    values = F.array_sort(F.collect_list(F.struct(F.col(row_id).alias("i"), F.col(columns[0]).cast("string").alias("v"))))
    positions = F.transform(F.sequence(F.lit(0), F.size("l") - 1), lambda i: i.cast("string"))
    return df.groupBy(*by).agg(values.alias("l")).select(*by, F.map_from_arrays(positions, F.col("l.v")).alias("pairs"))
