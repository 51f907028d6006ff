"""Contexts: when and how often (scope), who (entities), and how they roll up (hierarchy)."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugework.functions.buckets import finest, step_order
from gaugework.functions.vocabulary import canonical
from gaugework.operators.aggregate import data_range, merge_ranges
from gaugework.operators.combine import merge_entity_sets
from gaugework.operators.filters import entities_of_types
from gaugework.operators.hierarchy import merge_hierarchies

# Depth bounds when nothing is known, and default steps.
DEPTH_LIMITS = (-1.7976931348623157e308, 1.7976931348623157e308)
DEFAULT_TIME_STEP, DEFAULT_DEPTH_STEP = "EverySecond", "Meter"
SCOPE_SCHEMA = (
    "name string, time_start timestamp_ntz, time_end timestamp_ntz, time_step string, "
    "depth_start double, depth_end double, depth_step string"
)


def _moment(value: Any) -> datetime | None:
    if value in (None, "") or isinstance(value, datetime):
        return value or None
    moment = datetime.fromisoformat(str(value).replace("Z", "+00:00"))
    return moment.replace(tzinfo=None)


@dataclass(frozen=True)
class Scope:
    name: str = "Scope"
    time_start: datetime | None = None
    time_end: datetime | None = None
    time_step: str | None = None
    depth_start: float | None = None
    depth_end: float | None = None
    depth_step: str | None = None


def resolve_scope(stored: Scope | dict | None = None, **given: Any) -> Scope:
    """Explicit arguments over stored ones; times from ISO text, steps by any accepted name.

    A zero depth is a bound like any other, and overrides apply to scopes passed as objects too.
    """
    base = stored if isinstance(stored, Scope) else Scope(**(stored or {}))
    scope = replace(base, **{k: v for k, v in given.items() if v is not None})
    return replace(
        scope,
        time_start=_moment(scope.time_start),
        time_end=_moment(scope.time_end),
        time_step=canonical("time increment", scope.time_step) if scope.time_step else None,
        depth_start=None if scope.depth_start is None else float(scope.depth_start),
        depth_end=None if scope.depth_end is None else float(scope.depth_end),
        depth_step=canonical("depth increment", scope.depth_step) if scope.depth_step else None,
    )


@dataclass(frozen=True)
class Context:
    """Entities have a ``name`` column, the hierarchy has ``child`` and ``parent``."""

    name: str = "Context"
    scope: Scope = Scope()
    entities: DataFrame | None = None
    hierarchy: DataFrame | None = None


def resolve_entities(
    entities: DataFrame, chosen: DataFrame | None = None, types: list[str] | str | None = None
) -> DataFrame:
    """A chosen set, restricted to types when both are given; else all entities of the types."""
    rows = entities_of_types(entities, types) if types else entities
    if chosen is None:
        return rows.select("name")
    names = chosen.select("name")
    return names.join(rows.select("name"), "name", "left_semi") if types else names


def resolve_context(
    context: Context | None = None,
    scope: Scope | dict | None = None,
    entities: DataFrame | None = None,
    hierarchy: DataFrame | None = None,
    name: str | None = None,
    **scope_arguments: Any,
) -> Context:
    """A context with overrides applied; an empty hierarchy is dropped."""
    base = context or Context()
    edges = hierarchy if hierarchy is not None else base.hierarchy
    return Context(
        name or base.name,
        resolve_scope(scope if scope is not None else base.scope, **scope_arguments),
        entities if entities is not None else base.entities,
        None if edges is None or edges.isEmpty() else edges,
    )


def merge_scopes(scopes: list[Scope]) -> Scope:
    """Earliest start, latest end and finest step."""
    def pick(function, field):
        known = [getattr(s, field) for s in scopes if getattr(s, field) is not None]
        return function(known) if known else None

    if len(scopes) == 1:
        return scopes[0]
    return Scope(
        "Merged Scope",
        pick(min, "time_start"), pick(max, "time_end"), finest("time", [s.time_step for s in scopes]),
        pick(min, "depth_start"), pick(max, "depth_end"), finest("depth", [s.depth_step for s in scopes]),
    )


def merge_scope_rows(scopes: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The same over a table of scopes, in one aggregate."""
    def order(kind: str):
        names = step_order(kind)
        pairs = [x for name, i in names.items() for x in (F.lit(name), F.lit(i))]
        return F.try_element_at(F.create_map(*pairs), F.col(f"{kind}_step"))

    aggregates = [
        F.min("time_start").alias("time_start"), F.max("time_end").alias("time_end"),
        F.min_by("time_step", order("time")).alias("time_step"),
        F.min("depth_start").alias("depth_start"), F.max("depth_end").alias("depth_end"),
        F.min_by("depth_step", order("depth")).alias("depth_step"),
    ]
    return scopes.groupBy(*by).agg(*aggregates) if by else scopes.agg(*aggregates)


def merge_contexts(contexts: list[Context | dict], distinct_entities: bool = False) -> Context:
    parts = [resolve_context(**c) if isinstance(c, dict) else c for c in contexts]
    sets = [c.entities for c in parts if c.entities is not None]
    edges = [c.hierarchy for c in parts if c.hierarchy is not None]
    return Context(
        "Merged Context",
        merge_scopes([c.scope for c in parts]),
        merge_entity_sets(sets, distinct_entities) if sets else None,
        merge_hierarchies(edges) if edges else None,
    )


@dataclass(frozen=True)
class ContextList:
    """Contexts with a primary one: the first, or all of them merged."""

    contexts: tuple[Context, ...]
    primary_kind: str = "first"

    @property
    def primary(self) -> Context:
        return merge_contexts(list(self.contexts)) if self.primary_kind == "merged" else self.contexts[0]

    def entity_rows(self) -> DataFrame:
        """(context, name) over all contexts."""
        rows = [c.entities.select(F.lit(c.name).alias("context"), "name") for c in self.contexts if c.entities is not None]
        return reduce(DataFrame.unionByName, rows)


def default_bounds(samples: DataFrame, scope: Scope, axis: str) -> DataFrame:
    """One row of (range_start, range_end, step): the scope's, else the range of the samples.

    Depth without any data falls back to the widest range. One aggregate serves all signals and entities.
    """
    kind = "time" if axis == "date" else "depth"
    dtype = "timestamp_ntz" if kind == "time" else "double"
    found = merge_ranges(data_range(samples, axis, ["signal"]))
    start, end = getattr(scope, f"{kind}_start"), getattr(scope, f"{kind}_end")
    fallback = DEPTH_LIMITS if kind == "depth" else (None, None)
    step = getattr(scope, f"{kind}_step") or (DEFAULT_TIME_STEP if kind == "time" else DEFAULT_DEPTH_STEP)
    return found.select(
        F.coalesce(F.lit(start).cast(dtype), "range_start", F.lit(fallback[0]).cast(dtype)).alias("range_start"),
        F.coalesce(F.lit(end).cast(dtype), "range_end", F.lit(fallback[1]).cast(dtype)).alias("range_end"),
        F.lit(step).alias("step"),
    )
