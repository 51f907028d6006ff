"""Unit conversion by factor and summand: base value = value * factor + summand."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugework.operators.joins import lookup

SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("measurement", T.StringType()),
        T.StructField("factor", T.DoubleType()),
        T.StructField("summand", T.DoubleType()),
    ]
)
# Spellings of the blank unit and of percent.
BLANK, PERCENT = " ", "%"
SPELLINGS = {"_": BLANK, "@": PERCENT}


def spelled(unit: str | None) -> str:
    return SPELLINGS.get(unit or "", unit or "")


def spelled_column(unit: Column) -> Column:
    return F.when(unit == "_", BLANK).when(unit == "@", PERCENT).otherwise(unit)


def blank(unit: str | None) -> bool:
    return not (unit or "").strip()


def conversion(units: DataFrame, pairs: list[tuple[str, str]]) -> dict[tuple[str, str], tuple[float, float]]:
    """(scale, shift) per (source, target) pair; looks up only the units named in the pairs."""
    wanted = {(s, t): (spelled(s), spelled(t)) for s, t in pairs}
    differing = {p for p in wanted.values() if not blank(p[0]) and not blank(p[1]) and p[0] != p[1]}
    names = sorted({n for p in differing for n in p})
    known = (
        {r["name"]: (r["factor"], r["summand"], r["measurement"]) for r in units.where(F.col("name").isin(names)).collect()}
        if names
        else {}
    )
    result = {}
    for pair, (source, target) in wanted.items():
        if (source, target) not in differing:
            result[pair] = (1.0, 0.0)
            continue
        for n in (source, target):
            if n not in known:
                raise ValueError(f"unknown unit '{n}'")
        (fs, ss, ms), (ft, st, mt) = known[source], known[target]
        if ms != mt:
            raise ValueError(f"cannot convert '{source}' ({ms}) to '{target}' ({mt})")
        result[pair] = (fs / ft, (ss - st) / ft)
    return result


def converted(value: Column, scale: float, shift: float) -> Column:
    """A conversion known on the driver is arithmetic in the scan stage, with no join."""
    if (scale, shift) == (1.0, 0.0):
        return value
    return value * F.lit(scale) + F.lit(shift)


def convert_rows(
    df: DataFrame, units: DataFrame, value: str, source: str, target: str, out: str | None = None
) -> DataFrame:
    """Convert row by row when units differ per row; null, blank and equal units pass through.

    An unknown unit, or one of another measurement, raises as :func:`conversion` does.
    """
    s = units.select(F.col("name"), F.col("factor").alias("__sf"), F.col("summand").alias("__ss"), F.col("measurement").alias("__sm"))
    t = units.select(F.col("name"), F.col("factor").alias("__tf"), F.col("summand").alias("__ts"), F.col("measurement").alias("__tm"))
    src, tgt = F.col("__src"), F.col("__tgt")
    spelled_rows = df.withColumns({"__src": spelled_column(F.col(source)), "__tgt": spelled_column(F.col(target))})
    same = src.isNull() | tgt.isNull() | (F.trim(src) == "") | (F.trim(tgt) == "") | (src == tgt)
    changed = (F.col(value) * F.col("__sf") + F.col("__ss") - F.col("__ts")) / F.col("__tf")
    known = lookup(lookup(spelled_rows, s, [("__src", "name")]), t, [("__tgt", "name")])
    wrong = F.concat(F.lit("cannot convert '"), src, F.lit("' to '"), tgt, F.lit("'"))
    checked = F.when(F.col("__sm") == F.col("__tm"), changed).otherwise(F.raise_error(wrong).cast("double"))
    return known.withColumn(out or value, F.when(same, F.col(value)).otherwise(checked)).drop(
        "__src", "__tgt", "__sf", "__ss", "__sm", "__tf", "__ts", "__tm"
    )


def units_of(units: DataFrame, measurement: str) -> DataFrame:
    return units.where(F.col("measurement") == measurement)


def measurements(units: DataFrame) -> DataFrame:
    return units.select("measurement").distinct()


def add_units(units: DataFrame, new: DataFrame) -> DataFrame:
    """Append or replace by name; an empty name or measurement is an error."""
    checked = new.select(
        *[
            F.when(F.coalesce(F.trim(c), F.lit("")) == "", F.raise_error(F.lit(f"unit {c} cannot be empty")).cast("string"))
            .otherwise(F.col(c))
            .alias(c)
            for c in ("name", "measurement")
        ],
        F.coalesce("factor", F.lit(1.0)).alias("factor"),
        F.coalesce("summand", F.lit(0.0)).alias("summand"),
    )
    return units.join(checked, "name", "left_anti").unionByName(checked)
