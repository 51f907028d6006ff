"""Registered queries over the given tables, each with the SQL that checks it where SQL can."""

from __future__ import annotations

import importlib

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
SECTIONS = (
    "scans", "projections", "predicates", "joins", "aggregations", "windows", "sorting", "sets",
    "reshaping", "reftables", "contexts", "signaltables", "unitqueries", "definitions", "models", "geopoints",
)


def query(name: str, sql: str | None = None):
    """Register a (spark, sf_dir) -> DataFrame function."""
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


def load() -> None:
    for section in SECTIONS:
        importlib.import_module(f"catalog.{section}")
