"""Headers such as ``rate [m3/d]`` and ``Well 1 : rate``, on the driver and as columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLANKS = " \t\r\n"
SHORT_NAME_LENGTH = 29


def split_header(text: str) -> tuple[str, str]:
    """``name [unit]`` -> (name, unit); the unit is the first bracketed group or empty."""
    unit = re.search(r"\[(.*?)\]", text)
    return text.partition("[")[0].strip(), unit.group(1) if unit else ""


def header(name: str, unit: str | None) -> str:
    return f"{name} [{unit}]" if unit else name


def split_entity_header(text: str) -> tuple[str, str]:
    """``entity : column`` -> (entity, column); a plain header has an empty entity."""
    parts = text.split(" : ")
    return (parts[0], parts[1]) if len(parts) > 1 else ("", text)


def name_part(c: Column) -> Column:
    return F.btrim(F.split_part(c, F.lit("["), F.lit(1)), F.lit(_BLANKS))


def unit_part(c: Column) -> Column:
    return F.regexp_extract(c, r"\[(.*?)\]", 1)


def short_name(short: Column, name: Column) -> Column:
    return F.substring(F.coalesce(F.nullif(short, F.lit("")), name), 1, SHORT_NAME_LENGTH)


def formula_signal(formula: Column) -> Column:
    """Second piece between double quotes, or empty text."""
    return F.coalesce(F.get(F.split(formula, '"'), F.lit(1)), F.lit(""))


def formula_unit(formula: Column) -> Column:
    """Fourth piece between double quotes, or the blank unit."""
    return F.coalesce(F.get(F.split(formula, '"'), F.lit(3)), F.lit(" "))


def quoted(name: str) -> str:
    """A column name safe inside SQL text and ``F.col``."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quoted(name))
