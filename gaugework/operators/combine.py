"""Unions of series and sets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugework.functions.names import split_header
from gaugework.functions.vocabulary import RESERVED_VALUE_COLUMNS


def union_series(numeric: DataFrame, text: DataFrame) -> DataFrame:
    """Numeric and text samples in one table of (value_num, value_str)."""
    n = numeric.withColumnRenamed("value", "value_num").withColumn("value_str", F.lit(None).cast("string"))
    t = text.withColumnRenamed("value", "value_str").withColumn("value_num", F.lit(None).cast("double"))
    return n.unionByName(t)


def merge_entity_sets(sets: list[DataFrame], distinct: bool = False) -> DataFrame:
    """Concatenation; duplicates stay unless asked otherwise."""
    union = reduce(DataFrame.unionByName, sets)
    return union.distinct() if distinct else union


def check_reserved(columns: list[str], index: list[str]) -> None:
    """Reserved names may not be used for key or value columns."""
    values = {split_header(c)[0] for c in columns if c not in index}
    clash = values & set(RESERVED_VALUE_COLUMNS)
    if clash:
        raise ValueError(f"reserved column names: {sorted(clash)}")
