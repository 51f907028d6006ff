"""Aggregate expressions for the fourteen aggregation names.

The algebraic ones keep a fixed-size buffer per group, so they combine before the shuffle and a hot
group costs no more than any other. Median, percentile, mode and text concatenation do not; those live
in :mod:`gaugework.operators.aggregate`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gaugework.functions.vocabulary import canonical

ALGEBRAIC_NUMERIC = {
    "Sum", "Average", "Max", "Min", "First", "Last", "Count", "StandardDeviation", "Variance", "Range",
}
ALGEBRAIC_TEXT = {"Max", "Min", "First", "Last", "Count"}


def is_algebraic(how: str, text: bool = False) -> bool:
    return canonical("aggregation", how) in (ALGEBRAIC_TEXT if text else ALGEBRAIC_NUMERIC)


def _ordered(pick, value: Column, *order: Column) -> Column:
    """min_by/max_by that skips null values instead of returning them."""
    return pick(value, F.when(value.isNotNull(), F.struct(*order)))


def algebraic(how: str, value: Column, axis: Column | None = None, text: bool = False) -> Column:
    """One aggregate column; ``axis`` orders First and Last, ties go by value."""
    name = canonical("aggregation", how)
    if name == "First":
        return _ordered(F.min_by, value, axis, value)
    if name == "Last":
        return _ordered(F.max_by, value, axis, value)
    if name == "Count":
        return F.count(value)
    if text:
        if name == "Max":
            return _ordered(F.max_by, value, F.length(value), value)
        if name == "Min":
            return _ordered(F.min_by, value, F.length(value), value)
        raise ValueError(f"aggregation {name} is not defined for text")
    plain = {
        "Sum": F.sum,
        "Average": F.avg,
        "Max": F.max,
        "Min": F.min,
        "StandardDeviation": F.stddev_samp,
        "Variance": F.var_samp,
    }
    if name in plain:
        return plain[name](value)
    if name == "Range":
        return F.max(value) - F.min(value)
    raise ValueError(f"aggregation {name} has no fixed-size buffer")
