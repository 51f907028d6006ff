"""Cleansing by named rules, each a Spark SQL expression over one sample.

A rule sees ``value``, ``entity``, ``signal`` and, for time series, ``date``; its result is the cleansed
value, null removing it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cleanse(samples: DataFrame, rules: dict[str, str], value: str = "value_num") -> DataFrame:
    """Apply the rule of each signal; signals without one stay as they are. Adds before and after."""
    before = F.col(value)
    after = before
    source = samples.withColumn("value", before) if value != "value" else samples
    for signal, rule in rules.items():
        after = F.when(F.col("signal") == signal, F.expr(rule).cast("double")).otherwise(after)
    return source.withColumns({"value_before": before, "value_after": after})


def preview(samples: DataFrame, rules: dict[str, str], value: str = "value_num") -> DataFrame:
    """Only the samples a rule would change."""
    done = cleanse(samples, rules, value)
    return done.where(~F.col("value_before").eqNullSafe(F.col("value_after")))


def apply(samples: DataFrame, rules: dict[str, str], value: str = "value_num") -> DataFrame:
    """Cleansed samples in the shape of the input."""
    done = cleanse(samples, rules, value)
    return done.withColumn(value, F.col("value_after")).select(*samples.columns)
