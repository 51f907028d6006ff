"""Loading and saving signal tables."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugework.functions.aggregates import algebraic, is_algebraic
from gaugework.functions.buckets import depth_bucket, depth_of_bucket, time_bucket
from gaugework.functions.names import col, header, split_header
from gaugework.functions.vocabulary import ALIAS, AXIS_OF_TYPE, DATE, DEPTH, ENTITY, TEXT_TYPES, canonical
from gaugework.operators import filters
from gaugework.operators.aggregate import aggregate
from gaugework.operators.hierarchy import paths, pool, rolled
from gaugework.operators.definitions import remapped
from gaugework.operators.joins import lookup
from gaugework.operators.reshape import has_entity_headers, pivot_signals, signal_columns_last, wide_to_long
from gaugework.operators.units import conversion, converted
from gaugework.operators.window import fill_grid, first_values, interpolate_at
from gaugework.plans.reduction import WIDE, of_one_kind, reduced
from gaugework.plans.context import DEFAULT_DEPTH_STEP, DEFAULT_TIME_STEP, Context, ContextList
from gaugework.session import kept
from gaugework.sources.signal_store import SignalStore

AXIS_COLUMN = {"time": "date", "depth": "depth"}
OUT_COLUMN = {"time": DATE, "depth": DEPTH}
# Bucket column while a table is built; column names ignore case, so it may not be Date or Depth yet.
AT = "__at"


@dataclass(frozen=True)
class SignalData:
    """Samples per axis: columns entity, signal, value_num, value_str, and date or depth."""

    static: DataFrame | None = None
    time: DataFrame | None = None
    depth: DataFrame | None = None


@dataclass(frozen=True)
class SignalSpec:
    """A wanted signal with everything the plan needs to know about it."""

    name: str
    unit: str
    axis: str
    text: bool
    interval_agg: str
    hierarchy_agg: str
    scale: float = 1.0
    shift: float = 0.0

    @property
    def header(self) -> str:
        return f"{self.name} [{self.unit}]"

    @property
    def value(self) -> Column:
        return F.col("value_str") if self.text else converted(F.col("value_num"), self.scale, self.shift)


def resolve_signals(wanted: list, signals: DataFrame, units: DataFrame) -> list[SignalSpec]:
    """Definitions and conversion factors of the wanted signals; one small lookup each.

    A signal is named by name, short name, ``name [unit]`` or (name, unit); without a unit it comes in
    its storage unit. Only rows of the wanted names are fetched.
    """
    asked = [(w if isinstance(w, (tuple, list)) else split_header(w)) for w in wanted]
    names = [a[0] for a in asked]
    rows = signals.where(F.col("name").isin(names) | F.col("short_name").isin(names)).collect()
    by_name = {r["short_name"]: r for r in rows} | {r["name"]: r for r in rows}
    missing = [n for n in names if n not in by_name]
    if missing:
        raise ValueError(f"unknown signals: {missing}")
    specs = []
    for name, unit in asked:
        r = by_name[name]
        kind = canonical("signal type", r["type"])
        if kind not in AXIS_OF_TYPE:
            continue  # PVT signals have no place in a table
        axis = AXIS_OF_TYPE[kind]
        specs.append(
            SignalSpec(
                r["name"], unit or r["unit"], axis, kind == TEXT_TYPES[axis],
                canonical("aggregation", r["interval_agg"]), canonical("aggregation", r["hierarchy_agg"]),
            )
        )
    stored = {r["name"]: r["unit"] for r in rows}
    pairs = [(stored[s.name], s.unit) for s in specs if not s.text]
    factors = conversion(units, pairs)
    return [s if s.text else replace(s, **dict(zip(("scale", "shift"), factors[(stored[s.name], s.unit)]))) for s in specs]


def _restricted(
    samples: DataFrame, specs: list[SignalSpec], context: Context, axis: str, scenario: str | None, names: DataFrame | None
) -> DataFrame:
    """Wanted signals, entities, range and scenario; all but the entities reach the file scan."""
    rows = samples.where(F.col("signal").isin([s.name for s in specs]))
    if axis in AXIS_COLUMN:
        start, end = getattr(context.scope, f"{axis}_start"), getattr(context.scope, f"{axis}_end")
        rows = filters.in_range(rows, AXIS_COLUMN[axis], start, end)
    rows = filters.of_scenario(rows, scenario)
    if names is not None:
        rows = lookup(rows, names, ["entity"], "left_semi")
    return rows


def _wanted_entities(context: Context, up: DataFrame | None) -> DataFrame | None:
    """Wanted entities, and with a hierarchy also everything that rolls up into them."""
    if context.entities is None:
        return None
    names = context.entities.select(F.col("name").alias("entity"))
    if up is None:
        return names
    below = up.select("node", F.explode("path").alias("ancestor"))
    under = lookup(below, names, [("ancestor", "entity")], "left_semi").select(F.col("node").alias("entity"))
    return kept(names.unionByName(under).distinct())


def _merged(tables: list[DataFrame], index: list[str], specs: list[SignalSpec]) -> DataFrame:
    """Tables of some signals each, on the same index, as one."""
    if len(tables) == 1:
        return tables[0]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    return union.groupBy(*index).agg(*[F.max(col(s.header)).alias(s.header) for s in specs])


def _resampled(rows: DataFrame, specs: list[SignalSpec], axis: str, step: str) -> DataFrame:
    """One row per entity and bucket, one column per signal, each by its own interval aggregation.

    Signals whose aggregation combines early are resampled and pivoted by the same single grouping, or, where there are many, as rows
    that are pivoted when they are reduced. Those with median, percentile, mode or concatenation share one pass per aggregation and
    meet the table at the end, when it is down to one row per bucket. Signals without aggregation keep their own time or depth.
    """
    c, index = AXIS_COLUMN[axis], ["entity", AT]
    bucket = time_bucket(F.col(c), step) if axis == "time" else depth_bucket(F.col(c), step)
    bucketed = rows.withColumn(AT, bucket)

    def samples(part: list[SignalSpec]) -> DataFrame:
        return bucketed if len(part) == len(specs) else bucketed.where(F.col("signal").isin([s.name for s in part]))

    early = [s for s in specs if is_algebraic(s.interval_agg, s.text)]
    many = [s for s in early if not s.text] if len(early) > WIDE else []
    few = [s for s in early if s not in many]
    tables = []
    if many:
        tables.append(reduced(samples(many), index, many, c))
    if few:
        tables.append(
            samples(few).groupBy(*index).agg(
                *[
                    algebraic(s.interval_agg, F.when(F.col("signal") == s.name, s.value), F.col(c), s.text).alias(s.header)
                    for s in few
                ]
            )
        )
    passing = [s for s in specs if s.interval_agg == "NoAggregation"]
    kinds: dict[tuple[str, bool], list[SignalSpec]] = {}
    for s in specs:
        if s not in early and s not in passing:
            kinds.setdefault((s.interval_agg, s.text), []).append(s)
    for (how, _), part in kinds.items():
        if len(part) == 1:
            own = samples(part).withColumn("__value", part[0].value)
            tables.append(aggregate(own, index, "__value", how, c, out=part[0].header))
        else:
            tables.append(of_one_kind(samples(part), index, part, how, c))
    if axis == "depth":
        tables = [t.withColumn(AT, depth_of_bucket(F.col(AT), step)) for t in tables]
    if passing:
        tables += [pivot_signals(_typed(rows.withColumn(AT, F.col(c)), part), index, _cells(part)) for part in _once_each(passing)]
    return _merged(tables, index, specs)


def _rolled_up(table: DataFrame, specs: list[SignalSpec], up: DataFrame, index: list[str]) -> DataFrame:
    """Every entity from its own row and those below it, each signal by its own hierarchy aggregation."""
    pooled = pool(table, up, "entity")
    early = [s for s in specs if s.hierarchy_agg == "NoAggregation" or is_algebraic(s.hierarchy_agg, s.text)]
    tables = []
    if early:
        cells = [
            F.max(F.when(F.col("own"), col(s.header))) if s.hierarchy_agg == "NoAggregation"
            else rolled(col(s.header), lambda v, s=s: algebraic(s.hierarchy_agg, v, ~F.col("own"), s.text))
            for s in early
        ]
        tables.append(pooled.groupBy(*index).agg(*[c.alias(s.header) for c, s in zip(cells, early)]))
    for s in specs:
        if s not in early:
            order = index[1] if len(index) > 1 else "__order"
            rows = pooled.select(*index, col(s.header).alias("__value"), F.lit(0.0).alias("__order"))
            tables.append(aggregate(rows, index, "__value", s.hierarchy_agg, order, out=s.header))
    return _merged(tables, index, specs)


def _axis_table(
    samples: DataFrame, specs: list[SignalSpec], context: Context, axis: str, scenario: str | None, depth_factor: float,
    strict: bool, names: DataFrame | None, up: DataFrame | None,
) -> DataFrame:
    rows = _restricted(samples, specs, context, axis, scenario, names)
    out = OUT_COLUMN.get(axis)
    index = ["entity", AT] if out else ["entity"]
    step = getattr(context.scope, f"{axis}_step") if out else None
    if step:
        table = _resampled(rows, specs, axis, step)
    else:
        own = rows.withColumn(AT, F.col(AXIS_COLUMN[axis])) if out else rows
        table = _merged([pivot_signals(_typed(own, part), index, _cells(part), strict=strict) for part in _once_each(specs)], index, specs)
    if up is not None:
        table = _rolled_up(table, specs, up, index)
        if context.entities is not None:
            table = lookup(table, context.entities.select("name"), [("entity", "name")], "left_semi")
    if axis == "depth" and depth_factor != 1.0:
        table = table.withColumn(AT, F.col(AT) * F.lit(depth_factor))
    ordered = [F.col("entity").alias(ENTITY), *([F.col(AT).alias(out)] if out else []), *[col(s.header) for s in specs]]
    return table.select(*ordered)


def _typed(rows: DataFrame, specs: list[SignalSpec]) -> DataFrame:
    """value_num converted per signal, by factors known on the driver."""
    value = F.col("value_num")
    for s in specs:
        if not s.text and (s.scale, s.shift) != (1.0, 0.0):
            value = F.when(F.col("signal") == s.name, s.value).otherwise(value)
    return rows.withColumn("value_num", value)


def _once_each(specs: list[SignalSpec]) -> list[list[SignalSpec]]:
    """The signals in as few lists as have each name once; a signal may be wanted in several units."""
    parts: list[list[SignalSpec]] = []
    for s in specs:
        free = next((part for part in parts if all(t.name != s.name for t in part)), None)
        if free is None:
            parts.append([s])
        else:
            free.append(s)
    return parts


def _cells(specs: list[SignalSpec]) -> dict[str, tuple[str, str]]:
    return {s.name: ("value_str" if s.text else "value_num", s.header) for s in specs}


def load_signals(
    data: SignalData,
    signals: DataFrame,
    units: DataFrame,
    wanted: list,
    context: Context,
    scenario: str | None = None,
    depth_unit: str | None = None,
    strict: bool = True,
    default_step: bool = False,
) -> DataFrame:
    """Wanted signals as one table: Entity, Date, Depth, then one ``name [unit]`` column per signal.

    Time, depth and static signals become one table each and are joined on Entity: every time row meets
    every depth row of its entity. Without a step in the scope rows keep their own time or depth, or are
    resampled to the default steps where those are asked for.
    """
    if default_step:
        scope = context.scope
        scope = replace(scope, time_step=scope.time_step or DEFAULT_TIME_STEP, depth_step=scope.depth_step or DEFAULT_DEPTH_STEP)
        context = replace(context, scope=scope)
    if context.entities is not None and context.entities.isEmpty():
        raise ValueError("the entity set is empty")
    specs = resolve_signals(wanted, signals, units)
    depth_factor = conversion(units, [("m", depth_unit)])[("m", depth_unit)][0] if depth_unit else 1.0
    up = kept(paths(context.hierarchy)) if context.hierarchy is not None else None
    names = _wanted_entities(context, up)
    tables = {}
    for axis in ("time", "depth", "static"):
        mine = [s for s in specs if s.axis == axis]
        samples = getattr(data, axis)
        if mine and samples is not None:
            tables[axis] = _axis_table(samples, mine, context, axis, scenario, depth_factor, strict, names, up)
    if not tables:
        raise ValueError("no samples for the wanted signals")
    # The short tables meet first; the long time table comes last, with no grouping after it, so a hot
    # entity can be split.
    result = reduce(lambda a, b: b.join(a, ENTITY), reversed(list(tables.values())))
    first = [c for c in (ENTITY, DATE, DEPTH) if c in result.columns]
    result = result.select(*first, *[col(c) for c in result.columns if c not in first])
    result = signal_columns_last(result, [s.name for s in specs])
    return result.withColumnRenamed(DEPTH, header(DEPTH, depth_unit)) if depth_unit else result


def stored_data(store: SignalStore, wanted: list, signals: DataFrame, units: DataFrame, context: Context, scenario: str | None = None) -> SignalData:
    """Samples of the wanted signals from a store, numbers and texts of each axis together, only from files that can hold some."""
    specs, scope, axes = resolve_signals(wanted, signals, units), context.scope, {}
    for axis in ("static", "time", "depth"):
        names = sorted({s.name for s in specs if s.axis == axis})
        if names:
            ends = {} if axis == "static" else dict(zip(("start", "end") if axis == "time" else ("depth_start", "depth_end"), (getattr(scope, f"{axis}_{e}") for e in ("start", "end"))))
            kinds = [k for k, a in AXIS_OF_TYPE.items() if a == axis]
            axes[axis] = store.scan(names, signal_type=kinds, scenario=scenario, **ends)
    return SignalData(**axes)


def resample(
    samples: DataFrame, axis: str, step: str, how: str, value: str = "value_num", percentile: float = 1.0,
    keys: tuple[str, ...] = ("entity", "signal"), out: str = "value",
) -> DataFrame:
    """Long-form resampling: one row per entity, signal and bucket."""
    c = AXIS_COLUMN[axis]
    bucket = time_bucket(F.col(c), step) if axis == "time" else depth_bucket(F.col(c), step)
    name = "bucket"
    return aggregate(samples.withColumn(name, bucket), [*keys, name], value, how, c, out, percentile)


def load_data(
    samples: DataFrame,
    signal_type: str,
    pairs: DataFrame | None = None,
    start=None,
    end=None,
    step: str | None = None,
    num_values: int | None = None,
    gap_value=None,
    interpolated: bool = False,
    how: str = "Sum",
    hierarchy: DataFrame | None = None,
) -> DataFrame:
    """Samples of (entity, signal) pairs: first or last N, a point, a range, resampled, gap-filled.

    With a hierarchy, resampled time series also roll up by the same aggregation.
    """
    axis = AXIS_OF_TYPE.get(canonical("signal type", signal_type), "static")
    value = "value_str" if canonical("signal type", signal_type) in TEXT_TYPES.values() else "value_num"
    rows = samples if pairs is None else lookup(samples, pairs.select("entity", "signal"), ["entity", "signal"], "left_semi")
    if axis == "static":
        return rows
    c, keys = AXIS_COLUMN[axis], ["entity", "signal"]
    if num_values is not None:
        return first_values(rows, keys, c, num_values, (value,))
    if interpolated and axis == "depth" and start is not None and start == end:
        return interpolate_at(rows, keys, c, value, float(start), value)
    rows = filters.in_range(rows, c, start, end)
    if step is None:
        return rows
    table = resample(rows, axis, step, how, value, out=value)
    if hierarchy is not None and axis == "time":
        table = _pooled(table, kept(paths(hierarchy)), value, how)
    if gap_value is not None and axis == "time":
        ends = [filters.bound(e).cast("timestamp_ntz") if e is not None else None for e in (start, end)]
        table = fill_grid(table, keys, "bucket", value, step, gap_value, *ends)
    if axis == "depth":
        table = table.withColumn("bucket", depth_of_bucket(F.col("bucket"), step))
    return table.withColumnRenamed("bucket", c)


def _pooled(table: DataFrame, up: DataFrame, value: str, how: str) -> DataFrame:
    """Resampled series under every entity above; an entity without anything below keeps its own value."""
    name, text = canonical("aggregation", how), isinstance(table.schema[value].dataType, T.StringType)
    pooled, keys = pool(table, up, "entity"), ["entity", "signal", "bucket"]
    if name == "NoAggregation":
        return table
    if is_algebraic(name, text):
        return pooled.groupBy(*keys).agg(rolled(F.col(value), lambda v: algebraic(name, v, ~F.col("own"), text)).alias(value))
    return aggregate(pooled, keys, value, name, "bucket", out=value)


def load_pvt(samples: DataFrame, units: DataFrame, pressure_unit: str = "Pa", temperature_unit: str = "K") -> DataFrame:
    """Pressure-temperature samples, stored in Pa and K, in the wanted units."""
    wanted = {"pressure": ("Pa", pressure_unit), "temperature": ("K", temperature_unit)}
    factors = conversion(units, list(wanted.values()))
    return samples.withColumns({c: converted(F.col(c), *factors[pair]) for c, pair in wanted.items()})


def load_contexts(
    data: SignalData, signals: DataFrame, units: DataFrame, wanted: list, contexts: ContextList, **options
) -> DataFrame:
    """The same signals in each context of a list, with the context's name in a column."""
    tables = [
        load_signals(data, signals, units, wanted, c, **options).select(F.lit(c.name).alias("Context"), "*")
        for c in contexts.contexts
    ]
    return reduce(DataFrame.unionByName, tables)


def column_mapping(columns: list[str], mapping: dict | None = None) -> list[tuple[str, str, str]]:
    """(column, signal, unit) of each value column; the mapping wins over the header."""
    rows = []
    for c in columns:
        name, unit = split_header(c)
        to = (mapping or {}).get(c, (mapping or {}).get(name))
        if isinstance(to, str):
            signal, to_unit = split_header(to)
            name, unit = signal, to_unit or unit
        elif isinstance(to, (tuple, list)) and to:
            name, unit = to[0], to[1] if len(to) > 1 else unit
        elif isinstance(to, dict):
            lower = {k.lower(): v for k, v in to.items()}
            name = next((lower[k] for k in ("signal", "name", "signalname") if k in lower), name)
            unit = next((lower[k] for k in ("unit", "unitname", "signalunit") if k in lower), unit)
        rows.append((c, name, unit))
    return rows


def table_to_samples(
    df: DataFrame,
    signals: DataFrame,
    mapping: dict | None = None,
    entity_map: DataFrame | None = None,
    entities: DataFrame | None = None,
    entity_type: str | None = None,
    row_id: str | None = None,
) -> DataFrame:
    """A wide or long table -> typed samples ready for the signal store.

    Columns without a known signal and rows of unknown entities are left out. Static signals keep the
    first row's value per entity; ``row_id`` names the column that gives the row order.
    """
    long = wide_to_long(df) if ENTITY not in df.columns and has_entity_headers(df) else df
    depth = next((c for c in long.columns if split_header(c)[0] == DEPTH), None)
    fixed = {ENTITY, ALIAS, DATE, depth, row_id}
    pairs = column_mapping([c for c in long.columns if c not in fixed], mapping)
    known = {r["name"]: r for r in signals.where(F.col("name").isin([s for _, s, _ in pairs])).collect()}
    cells, axes = [], set()
    for c, signal, unit in pairs:
        if signal not in known:
            continue
        kind = canonical("signal type", known[signal]["type"])
        if kind not in AXIS_OF_TYPE:
            continue
        axes.add(AXIS_OF_TYPE[kind])
        text = kind in TEXT_TYPES.values()
        numeric = isinstance(long.schema[c].dataType, T.StringType)
        number = F.nullif(F.trim(col(c)), F.lit("")).cast("double") if numeric else col(c).cast("double")
        cells.append(
            F.struct(
                F.lit(signal).alias("signal"),
                F.lit(unit or known[signal]["unit"]).alias("unit"),
                F.lit(kind).alias("signal_type"),
                (F.lit(None).cast("double") if text else F.nullif(number, F.lit(float("nan")))).alias("value_num"),
                (F.coalesce(col(c).cast("string"), F.lit("")) if text else F.lit(None).cast("string")).alias("value_str"),
            )
        )
    if not cells:
        raise ValueError("no column names a known signal")
    rows = long.select(
        F.col(ENTITY).cast("string").alias("entity"),
        (F.col(DATE).cast("timestamp_ntz") if DATE in long.columns else F.lit(None).cast("timestamp_ntz")).alias("date"),
        (col(depth).cast("double") if depth else F.lit(None).cast("double")).alias("depth"),
        (F.col(row_id) if row_id else F.monotonically_increasing_id()).alias("row_id"),
        F.inline(F.array(*cells)),
    )
    if entity_map is not None:
        rows = remapped("entity", entity_map, rows)
    if entities is not None:
        rows = filters.existing_only(rows, entities, entity_type)
    series = rows.where(~F.col("signal_type").isin("Static", "String")).drop("row_id")
    is_time = F.col("signal_type").isin("TimeDependent", "StringTimeDependent")
    series = series.withColumns(
        {"date": F.when(is_time, F.col("date")), "depth": F.when(~is_time, F.col("depth"))}
    )
    if "static" not in axes:
        return series
    keys = ["entity", "signal", "unit", "signal_type"]
    static = (
        rows.where(F.col("signal_type").isin("Static", "String"))
        .groupBy(*keys)
        .agg(F.min_by(F.struct("value_num", "value_str"), "row_id").alias("v"))
        .select(*keys, "v.value_num", "v.value_str")
    )
    return series.unionByName(static, allowMissingColumns=True)
