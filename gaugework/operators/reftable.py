"""Keyed reference tables: rows identified by (entity, time, key), any part of which may be null."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugework.functions.casts import column_type
from gaugework.functions.names import col, header, quoted, split_header
from gaugework.operators.aggregate import null_safe
from gaugework.operators.combine import check_reserved
from gaugework.operators.joins import lookup
from gaugework.operators.units import conversion, converted

# Default index column names.
ENTITY_NAMES = ("Entity",)
TIME_NAMES = ("Timestamp", "Date", "Time")
KEY_NAMES = ("Key",)
# Spark type of each column type.
STORED = {"Numeric": "double", "String": "string", "DateTime": "timestamp_ntz", "Bool": "boolean"}
WHOLE = "long"


@dataclass(frozen=True)
class ColumnInfo:
    name: str
    unit: str
    type: str
    stored: str = "double"


@dataclass(frozen=True)
class RefTable:
    """Definition of a reference table; the stored columns carry bare names."""

    name: str
    entity: str
    time: str
    key: ColumnInfo
    values: tuple[ColumnInfo, ...]
    description: str = ""
    sources: tuple[str, ...] = field(default=(), compare=False)

    @property
    def keys(self) -> list[str]:
        return [self.entity, self.time, self.key.name]

    @property
    def columns(self) -> list[str]:
        return [*self.keys, *[v.name for v in self.values]]

    def unit_of(self, name: str) -> str:
        return next(c.unit for c in (self.key, *self.values) if c.name == name)


def _names(given, default) -> list[str]:
    if not given:
        return list(default)
    return [given] if isinstance(given, str) else list(given)


def define(
    name: str, df: DataFrame, entity=None, time=None, key=None, description: str = ""
) -> RefTable:
    """Definition from a table: index columns by name, otherwise the next one by position."""
    columns = list(df.columns)
    index: list[str] = []
    for wanted, default, with_unit in ((entity, ENTITY_NAMES, False), (time, TIME_NAMES, False), (key, KEY_NAMES, True)):
        rest = [c for c in columns if c not in index]
        bare = {split_header(c)[0]: c for c in reversed(rest)} if with_unit else {}
        found = next((bare.get(n, n) for n in _names(wanted, default) if n in rest or n in bare), None)
        if found is None:
            if not rest:
                raise ValueError("entity, time and key columns are needed")
            found = rest[0]
        index.append(found)
    check_reserved(columns, index[:2])
    values = [c for c in columns if c not in index]

    def info(c: str) -> ColumnInfo:
        n, unit = split_header(c)
        dtype = df.schema[c].dataType
        kind = column_type(dtype)
        # Whole numbers stay whole: a key beyond 2^53 has no exact double.
        whole = isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
        return ColumnInfo(n, unit or " ", kind, WHOLE if whole else STORED[kind])

    return RefTable(
        name, split_header(index[0])[0], split_header(index[1])[0], info(index[2]),
        tuple(info(c) for c in values), description, tuple([*index, *values]),
    )


def info_rows(table: RefTable) -> list[tuple[str, str, str, str, str]]:
    """(table, role, name, unit, type) of the key and value columns."""
    rows = [(table.name, "key", table.key.name, table.key.unit, table.key.type)]
    return rows + [(table.name, "value", v.name, v.unit, v.type) for v in table.values]


def to_stored(df: DataFrame, table: RefTable, units: DataFrame) -> DataFrame:
    """A table with headers -> stored columns and units.

    Columns match by position. Values change unit where the header names another unit than the stored
    one, except for stored blank and percent; the column type stays.
    """
    if len(df.columns) != len(table.columns):
        raise ValueError(f"expected {len(table.columns)} columns, got {len(df.columns)}")
    stored = [None, None, table.key.unit, *[v.unit for v in table.values]]
    given = [split_header(c)[1] for c in df.columns]
    pairs = [(g, s) for g, s in zip(given, stored) if s and g and g != s and s not in (" ", "%")]
    factors = conversion(units, pairs)
    out = []
    for c, name, pair in zip(df.columns, table.columns, zip(given, stored)):
        value = col(c)
        if pair in factors:
            value = converted(value, *factors[pair]).cast(df.schema[c].dataType)
        out.append(value.alias(name))
    return df.select(*out)


def sql_condition(text: str) -> str:
    """``[Column]`` names to quoted ones, outside of text literals."""
    pieces = re.split(r"('(?:[^']|'')*')", text)
    return "".join(
        p if i % 2 else re.sub(r"\[([^\]]+)\]", lambda m: quoted(split_header(m.group(1))[0]), p)
        for i, p in enumerate(pieces)
    )


def _time(value) -> Column:
    return F.lit(value).cast("timestamp_ntz") if not isinstance(value, datetime) else F.lit(value.isoformat()).cast("timestamp_ntz")


def time_condition(c: Column, start=None, end=None) -> Column | None:
    """Exact when both ends are equal, else inclusive with open sides."""
    if start is not None and end is not None:
        return c == _time(start) if start == end else c.between(_time(start), _time(end))
    if start is not None:
        return c >= _time(start)
    return c <= _time(end) if end is not None else None


def entity_condition(c: Column, entities: list[str | None]) -> Column:
    """Listed entities; None stands for rows without one."""
    named = [e for e in entities if e is not None]
    parts = ([c.isin(named)] if named else []) + ([c.isNull()] if None in entities else [])
    return reduce(lambda a, b: a | b, parts, F.lit(False))


def load_rows(
    df: DataFrame,
    table: RefTable,
    units: DataFrame,
    entities=None,
    start=None,
    end=None,
    columns: list | dict | None = None,
    all_columns: bool = True,
    where: str | None = None,
    top: int | None = None,
) -> DataFrame:
    """Filtered rows with headers ``name [unit]``; filters combine by AND and reach the file scan."""
    if isinstance(entities, DataFrame):
        name = entities.columns[0]
        df = lookup(df, entities.select(col(name)), [(table.entity, name)], "left_semi")
    elif entities is not None:
        df = df.where(entity_condition(col(table.entity), [entities] if isinstance(entities, str) else list(entities)))
    period = time_condition(col(table.time), start, end)
    if period is not None:
        df = df.where(period)
    if where:
        df = df.where(sql_condition(where))
    if isinstance(columns, dict):
        wanted = columns
    else:
        pairs = [(c if isinstance(c, (list, tuple)) else split_header(c)) for c in ([columns] if isinstance(columns, str) else columns or [])]
        wanted = {p[0]: p[1] if len(p) > 1 else "" for p in pairs}
    values = [v for v in table.values if not wanted or all_columns or v.name in wanted]
    target = {c.name: wanted.get(c.name) or c.unit for c in (table.key, *values)}
    factors = conversion(units, [(c.unit, target[c.name]) for c in (table.key, *values)])
    if top is not None:
        df = df.orderBy(*map(col, table.keys)).limit(top)
    return df.select(
        col(table.entity),
        col(table.time),
        *[converted(col(c.name), *factors[(c.unit, target[c.name])]).alias(header(c.name, target[c.name])) for c in (table.key, *values)],
    )


def upsert(existing: DataFrame, new: DataFrame, keys: list[str], skip_existing: bool = False) -> DataFrame:
    """New rows replace those of the same key, or are dropped when existing ones are to be kept.

    A small batch is broadcast either way, so the existing rows are not shuffled for it.
    """
    if skip_existing:
        present = lookup(existing.select(*map(col, keys)), new.select(*map(col, keys)), keys, "left_semi", null_safe=True).distinct()
        return existing.unionByName(lookup(new, present, keys, "left_anti", null_safe=True))
    return lookup(existing, new.select(*map(col, keys)), keys, "left_anti", null_safe=True).unionByName(new)


def delete_condition(
    table: RefTable,
    entities: list[str | None] | None = None,
    start=None,
    end=None,
    drop_null_times: bool = False,
    where: str | None = None,
) -> Column | None:
    """Rows to delete by entity, time and text condition, combined by AND; None when nothing is asked."""
    parts = []
    if entities is not None:
        parts.append(entity_condition(col(table.entity), entities))
    period = time_condition(col(table.time), start, end)
    if period is not None or drop_null_times:
        missing = col(table.time).isNull()
        parts.append(missing if period is None else (period | missing if drop_null_times else period))
    if where:
        parts.append(F.expr(sql_condition(where)))
    return reduce(lambda a, b: a & b, parts) if parts else None


def delete_rows(df: DataFrame, table: RefTable, keys: DataFrame | None = None, **conditions) -> DataFrame:
    """The rows that stay. ``keys`` holds key tuples, null-safe in each part; no condition deletes all."""
    condition = delete_condition(table, **conditions)
    if keys is None:
        return df.limit(0) if condition is None else df.where(~F.coalesce(condition, F.lit(False)))
    met = None if condition is None else F.coalesce(condition, F.lit(False))
    return lookup(df, keys.select(*map(col, table.keys)), table.keys, "left_anti", null_safe=True, condition=met)
