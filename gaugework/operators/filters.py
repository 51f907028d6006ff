"""Predicates over entities, signals, items and samples."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugework.functions.vocabulary import canonical
from gaugework.operators.joins import lookup


def entities_of_types(entities: DataFrame, types: list[str] | str) -> DataFrame:
    """Entities of one or more types, ignoring case."""
    names = [types] if isinstance(types, str) else list(types)
    return entities.where(F.lower("type").isin([t.lower() for t in names]))


def entities_by_kind(entities: DataFrame, with_entities: bool = True, with_opportunities: bool = False) -> DataFrame:
    flag = F.coalesce("is_opportunity", F.lit(False))
    return entities.where((~flag & F.lit(with_entities)) | (flag & F.lit(with_opportunities)))


def entity_names(entities: DataFrame, types: list[str] | str | None = None) -> DataFrame:
    """Names of entities and opportunities alike."""
    rows = entities_of_types(entities, types) if types else entities
    return rows.select("name")


def find_entity(entities: DataFrame, name: str) -> DataFrame:
    return entities.where((F.col("name") == name) | (F.col("alias") == name))


def signals_of_type(signals: DataFrame, signal_type: str) -> DataFrame:
    return signals.where(F.col("type") == canonical("signal type", signal_type))


def find_signal(signals: DataFrame, name: str) -> DataFrame:
    return signals.where((F.col("name") == name) | (F.col("short_name") == name))


def bound(value) -> Column:
    """A bound as a constant. Dates and times are wall-clock times: no zone, of client or session, moves them."""
    if isinstance(value, (datetime, date)):
        return F.lit(value.isoformat()).cast("timestamp_ntz")
    return F.lit(value)


def in_range(samples: DataFrame, axis: str, start=None, end=None) -> DataFrame:
    """Inclusive range, either side open; equal ends are one point."""
    if start is not None and end is not None and start == end:
        return samples.where(F.col(axis) == bound(start))
    if start is not None:
        samples = samples.where(F.col(axis) >= bound(start))
    if end is not None:
        samples = samples.where(F.col(axis) <= bound(end))
    return samples


def of_scenario(samples: DataFrame, scenario: str | None) -> DataFrame:
    return samples.where(F.col("scenario") == scenario) if scenario else samples


def existing_only(samples: DataFrame, entities: DataFrame, types: list[str] | str | None = None) -> DataFrame:
    """Rows whose entity is defined, optionally of given types."""
    names = entity_names(entities, types).withColumnRenamed("name", "entity")
    return lookup(samples, names, ["entity"], "left_semi")


def known_signals_only(samples: DataFrame, signals: DataFrame) -> DataFrame:
    return lookup(samples, signals.select("name"), [("signal", "name")], "left_semi")


def entities_with_signal(samples: DataFrame, entities: DataFrame, signal: str) -> DataFrame:
    present = samples.where(F.col("signal") == signal).select(F.col("entity").alias("name")).distinct()
    return entities.join(present, "name", "left_semi")


def signals_of_entity(samples: DataFrame, signals: DataFrame, entity: str) -> DataFrame:
    present = samples.where(F.col("entity") == entity).select(F.col("signal").alias("name")).distinct()
    return signals.join(present, "name", "left_semi")


def items_of_type(items: DataFrame, item_type: str) -> DataFrame:
    return items.where(F.col("type") == item_type)


def item_labels(items: DataFrame) -> DataFrame:
    """One row per item and label."""
    return items.select("type", "name", F.explode("labels").alias("label"))


def item_page(items: DataFrame, page: int, page_size: int) -> DataFrame:
    """Page from 1, in order of name and then type."""
    return items.orderBy("name", "type").offset((page - 1) * page_size).limit(page_size)


def parameters_of_type(parameters: DataFrame, value_type: str) -> DataFrame:
    return parameters.where(F.lower("value_type") == value_type.lower())
