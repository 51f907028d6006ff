"""Long to wide, wide to long, and typed tables from text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugework.functions.casts import type_name
from gaugework.functions.names import col, header, split_entity_header, split_header
from gaugework.functions.vocabulary import ALIAS, DATE, DEPTH, ENTITY, OPPORTUNITY, TIME, TYPE

# Types of the headers with a fixed meaning.
KNOWN_TYPES = {DATE: "time", TIME: "time", ENTITY: "string", ALIAS: "string", TYPE: "string", OPPORTUNITY: "bool"}
TAB_TYPES = {ENTITY: "string", ALIAS: "string", DATE: "time", DEPTH: "numeric"}


def pivot_signals(
    long: DataFrame,
    index: list[str],
    columns: dict[str, tuple[str, str]],
    signal: str = "signal",
    strict: bool = True,
) -> DataFrame:
    """One column per signal in a single grouping.

    ``columns`` maps each signal to (value column, output header). Two rows of a signal for one index
    raise; without ``strict`` the largest value is kept.
    """
    cells = []
    for name, (value, head) in columns.items():
        mine = F.col(signal) == name
        cell = F.max(F.when(mine, col(value)))
        if strict:
            dtype = long.schema[value].dataType
            duplicate = F.raise_error(F.lit(f"duplicate rows for signal {name}")).cast(dtype)
            cell = F.when(F.count(F.when(mine, F.lit(1))) > 1, duplicate).otherwise(cell)
        cells.append(cell.alias(head))
    return long.where(F.col(signal).isin(list(columns))).groupBy(*map(col, index)).agg(*cells)


def has_entity_headers(df: DataFrame) -> bool:
    return any(split_entity_header(c)[0] for c in df.columns)


def wide_to_long(df: DataFrame) -> DataFrame:
    """``entity : column`` headers to an Entity column; groups with no value at all are dropped."""
    parts = {c: split_entity_header(c) for c in df.columns}
    index = [c for c, (entity, _) in parts.items() if not entity]
    by_entity: dict[str, dict[str, str]] = {}
    for c, (entity, name) in parts.items():
        if entity:
            by_entity.setdefault(entity, {})[name] = c
    if not by_entity:
        return df
    names = list(dict.fromkeys(n for cols in by_entity.values() for n in cols))
    types = {}
    for n in names:
        seen = {df.schema[cols[n]].dataType for cols in by_entity.values() if n in cols}
        numeric = all(isinstance(t, T.NumericType) for t in seen)
        types[n] = seen.pop() if len(seen) == 1 else (T.DoubleType() if numeric else T.StringType())

    def row(entity: str, cols: dict[str, str]) -> Column:
        cells = [(col(cols[n]) if n in cols else F.lit(None)).cast(types[n]).alias(n) for n in names]
        return F.struct(F.lit(entity).alias(ENTITY), *cells)

    rows = F.array(*[row(e, cols) for e, cols in by_entity.items()])
    long = df.select(*map(col, index), F.inline(rows))
    return long.na.drop("all", subset=[f"`{n}`" for n in names])


def entities_in(df: DataFrame) -> list[str]:
    """Entities for column headers: as many names as the result has columns."""
    return sorted(r[0] for r in df.select(col(ENTITY)).distinct().where(col(ENTITY).isNotNull()).collect())


def long_to_wide(
    df: DataFrame, index: list[str] | None = None, entities: list[str] | None = None, row_id: str | None = None
) -> DataFrame:
    """Entity column to ``entity : column`` headers, sorted by column, then entity.

    Rows align on the index columns (Date, Depth and Alias by default). ``row_id`` adds a row number to
    the index, which keeps every row apart.
    """
    if ENTITY not in df.columns:
        return df
    index = [c for c in (index or [DATE, DEPTH, ALIAS]) if c in df.columns and c != ENTITY]
    by = [*index, row_id] if row_id else index
    names = sorted(c for c in df.columns if c not in (*by, ENTITY))
    wanted = entities if entities is not None else entities_in(df)
    cells = [
        F.max(F.when(col(ENTITY) == e, col(n))).alias(f"{e} : {n}") for n in names for e in sorted(wanted)
    ]
    return df.groupBy(*map(col, by)).agg(*cells).select(*map(col, index), *[col(f"{e} : {n}") for n in names for e in sorted(wanted)])


def typed(text: Column, name: str) -> Column:
    """One text cell to a type name; blank cells are null except for text."""
    kind = type_name(name)
    filled = F.nullif(F.trim(text), F.lit(""))
    if kind == "numeric":
        return filled.cast("double")
    if kind == "time":
        return F.to_timestamp_ntz(F.regexp_replace(filled, "Z$", ""))
    if kind == "bool":
        return filled.cast("boolean")
    return text


def table_from_rows(df: DataFrame, rows: str, headers: list[str], schema: list[str] | None = None) -> DataFrame:
    """An array-of-text column plus headers -> typed table; fixed-meaning headers override the schema."""
    given = dict(zip(headers, schema or []))
    types = {h: KNOWN_TYPES.get(h, given.get(h, "object")) for h in headers}
    return df.select(*[typed(F.get(F.col(rows), F.lit(i)), types[h]).alias(h) for i, h in enumerate(headers)])


def tab_lines(df: DataFrame, headers: list[str], line: str = "value") -> DataFrame:
    """Tab-separated lines -> text columns; too long lines are skipped, short ones padded with nulls."""
    parts = df.select(F.split(F.col(line), "\t").alias("p")).where(F.size("p") <= len(headers))
    return parts.select(
        *[F.nullif(F.get("p", F.lit(i)), F.lit("")).alias(h) for i, h in enumerate(headers)]
    )


def tab_table(
    df: DataFrame,
    headers: list[str],
    types: dict[str, str] | None = None,
    line: str = "value",
    with_entity_column: bool = True,
) -> DataFrame:
    """Tab-separated lines -> typed table, with an Entity column or with entity headers."""
    known = {**{h: "numeric" for h in headers}, **(types or {}), **TAB_TYPES}
    texts = tab_lines(df, headers, line)
    table = texts.select(
        *[typed(col(h), known.get(split_header(split_entity_header(h)[1])[0], known[h])).alias(h) for h in headers]
    )
    if ENTITY in headers and not with_entity_column:
        return long_to_wide(table)
    if ENTITY not in headers and with_entity_column:
        return wide_to_long(table)
    return table


def stack_columns(parts: list[DataFrame]) -> DataFrame:
    """Each part's rows stay apart, holding only their own column; nothing is aligned."""
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p, allowMissingColumns=True)
    return union


def column_table(parts: dict[str, DataFrame], units: dict[str, str], drop_empty: bool = True) -> DataFrame:
    """Per-column records to one table: Date, Depth, Entity, then columns as ``name [unit]``."""
    named = [p.withColumnRenamed("Value", header(n, units.get(n))) for n, p in parts.items()]
    table = stack_columns(named)
    first = [c for c in (DATE, DEPTH, ENTITY) if c in table.columns]
    values = [header(n, units.get(n)) for n in parts]
    table = table.select(*map(col, first), *map(col, values))
    return table.na.drop("all") if drop_empty else table


def signal_columns_last(df: DataFrame, signals: list[str]) -> DataFrame:
    """Other columns first, then the signals in their existing order."""
    is_signal = {c: split_header(c)[0] in signals for c in df.columns}
    return df.select(*[col(c) for c in df.columns if not is_signal[c]], *[col(c) for c in df.columns if is_signal[c]])


def drop_empty_rows(df: DataFrame) -> DataFrame:
    return df.na.drop("all")
