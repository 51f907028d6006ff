"""Script tables and pivot tables from their definitions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugework.functions.names import col, formula_signal, formula_unit, header, split_header
from gaugework.functions.vocabulary import DATE, DEPTH, ENTITY
from gaugework.plans.context import Context, resolve_context
from gaugework.plans.signals import SignalData, SignalSpec, load_signals, resolve_signals
from gaugework.sources.partitioned import stored_once

# Definitions are rows of (table_name, position, column_name, unit, formula).
DEFINITION_SCHEMA = "table_name string, position int, column_name string, unit string, formula string"


def table_names(definitions: DataFrame) -> DataFrame:
    return definitions.select("table_name").distinct()


def column_signals(definitions: DataFrame) -> DataFrame:
    """Signal and unit that each column's formula refers to."""
    return definitions.select(
        "table_name", "position", "column_name", "unit",
        formula_signal(F.col("formula")).alias("signal"), formula_unit(F.col("formula")).alias("signal_unit"),
    )


def pick_table(definitions: DataFrame, table: str | int) -> str:
    """A table by name, or by its place in name order (negative from the end)."""
    if isinstance(table, str):
        return table
    names = [r[0] for r in table_names(definitions).orderBy("table_name").collect()]
    return names[table]


def _parts(rows: list) -> list[tuple[str, str, str]]:
    """(signal, unit, header) of each column of a defined table, in order."""
    return [(r["signal"], r["signal_unit"].strip(), header(r["column_name"], (r["unit"] or "").strip() or r["signal_unit"].strip())) for r in rows]


def _specs(parts: list[tuple[str, str, str]], signals: DataFrame, units: DataFrame) -> dict[tuple[str, str], SignalSpec]:
    """The signal of each (signal, unit), once; signals that have no place in a table are left out."""
    wanted = list(dict.fromkeys((signal, unit) for signal, unit, _ in parts))
    found = resolve_signals(wanted, signals, units)
    if len(found) == len(wanted):
        return dict(zip(wanted, found))
    return {w: s for w in wanted for s in resolve_signals([w], signals, units)}


def load_script_table(
    definitions: DataFrame, table: str | int, data: SignalData, signals: DataFrame, units: DataFrame, context: Context,
) -> DataFrame:
    """One defined table: its signals loaded in the context, under the defined column names.

    A signal may stand in several columns, in the same unit or in others.
    """
    name = pick_table(definitions, table)
    parts = _parts(column_signals(definitions).where(F.col("table_name") == name).orderBy("position").collect())
    specs = _specs(parts, signals, units)
    found = load_signals(data, signals, units, list(specs), context)
    return _cut(found, parts, specs)


def _cut(found: DataFrame, parts: list[tuple[str, str, str]], specs: dict[tuple[str, str], SignalSpec]) -> DataFrame:
    """The index of a loaded table and the columns of one defined table."""
    index = [c for c in found.columns if c in (ENTITY, DATE) or split_header(c)[0] == DEPTH]
    return found.select(*map(col, index), *[col(specs[s, u].header).alias(n) for s, u, n in parts if (s, u) in specs])


def load_all_script_tables(
    definitions: DataFrame, data: SignalData, signals: DataFrame, units: DataFrame, context: Context
) -> dict[str, DataFrame]:
    """Every defined table, cut from one load of the signals of all tables on the same axes, computed once.

    A table has the rows that hold a value in one of its own columns.
    """
    rows = column_signals(definitions).orderBy("table_name", "position").collect()
    by_table = {t: _parts([r for r in rows if r["table_name"] == t]) for t in dict.fromkeys(r["table_name"] for r in rows)}
    specs = _specs([p for parts in by_table.values() for p in parts], signals, units) if by_table else {}
    axes = {t: frozenset(specs[s, u].axis for s, u, _ in parts if (s, u) in specs) for t, parts in by_table.items()}
    loaded = {}
    for some in set(axes.values()) - {frozenset()}:
        wanted = dict.fromkeys((s, u) for t, parts in by_table.items() if axes[t] == some for s, u, _ in parts if (s, u) in specs)
        loaded[some] = stored_once(load_signals(data, signals, units, list(wanted), context))
    tables = {}
    for name, parts in by_table.items():
        if axes[name]:
            mine = [col(specs[s, u].header).isNotNull() for s, u, _ in parts if (s, u) in specs]
            tables[name] = _cut(loaded[axes[name]].where(reduce(lambda a, b: a | b, mine)), parts, specs)
    return tables


def pivot_table(
    wanted: list, data: SignalData, signals: DataFrame, units: DataFrame, context: Context,
    entities: DataFrame | None = None, scope=None,
) -> DataFrame:
    """A pivot generated in its own context, with another entity set or scope when given."""
    chosen = resolve_context(context, scope=scope, entities=entities)
    return load_signals(data, signals, units, wanted, chosen)
