"""Casts by type name, date text formats and canonical missing values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugework.functions.names import col

# Type names accepted in table definitions, and date patterns.
TYPE_NAMES = {
    "numeric": "numeric",
    "float64": "numeric",
    "time": "time",
    "datetime": "time",
    "datetime64[ns]": "time",
    "string": "string",
    "str": "string",
    "bool": "bool",
    "boolean": "bool",
    "unknown": "object",
    "object": "object",
}
DATE_TEXT_INPUTS = ("yyyy-MM-dd", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
DATE_TEXT_OUTPUT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
DATE_TEXT_STRICT = "yyyy-MM-dd HH:mm:ss"
CSV_DATE_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"

_BLANKS = " \t\r\n"


def type_name(name: str) -> str:
    return TYPE_NAMES.get(name.lower(), "object")


def to_number(c: Column, strict: bool = True) -> Column:
    return c.cast("double") if strict else c.try_cast("double")


def to_time(c: Column, pattern: str | None = None, strict: bool = True) -> Column:
    if pattern is None:
        return c.cast("timestamp_ntz") if strict else c.try_cast("timestamp_ntz")
    if strict:
        return F.to_timestamp_ntz(c, F.lit(pattern))
    return F.try_to_timestamp(c, F.lit(pattern)).cast("timestamp_ntz")


def to_bool(c: Column, dtype: T.DataType) -> Column:
    """Truthiness: any non-empty text and any non-zero number is true."""
    if isinstance(dtype, T.StringType):
        return F.length(c) > 0
    if isinstance(dtype, T.NumericType):
        return c != 0
    return c.cast("boolean")


def time_to_text(c: Column, pattern: str = DATE_TEXT_OUTPUT) -> Column:
    return F.coalesce(F.date_format(c, pattern), F.lit(""))


def date_text(c: Column, pattern: str = DATE_TEXT_OUTPUT) -> Column:
    """Date text in one of three layouts -> one layout; anything else is trimmed, null is empty."""
    parsed = F.coalesce(*[F.try_to_timestamp(c, F.lit(p)) for p in DATE_TEXT_INPUTS])
    return F.coalesce(F.date_format(parsed, pattern), F.btrim(c, F.lit(_BLANKS)), F.lit(""))


def text_to_time(c: Column, pattern: str = DATE_TEXT_STRICT) -> Column:
    return F.to_timestamp_ntz(c, F.lit(pattern))


def or_missing(c: Column, name: str, dtype: T.DataType) -> Column:
    """Canonical missing value: NaN text for numbers, empty for text, null otherwise."""
    kind = type_name(name)
    if kind == "string":
        return F.coalesce(c.cast("string"), F.lit(""))
    blank = c.isNull()
    if isinstance(dtype, T.StringType):
        blank = blank | (F.btrim(c, F.lit(_BLANKS)) == "")
    if kind == "numeric":
        return F.when(blank, F.lit("NaN")).otherwise(c.cast("string"))
    if kind == "time":
        text = date_text(c) if isinstance(dtype, T.StringType) else time_to_text(c)
        return F.when(~blank, text)
    return F.when(~blank, c)


def cast_column(df: DataFrame, name: str, to: str) -> Column:
    kind, c = type_name(to), col(name)
    if kind == "numeric":
        return to_number(c)
    if kind == "time":
        return to_time(c)
    if kind == "bool":
        return to_bool(c, df.schema[name].dataType)
    return c.cast("string")


def cast_columns(df: DataFrame, types: dict[str, str], default: str | None = None) -> DataFrame:
    """Cast the named columns, and all others to ``default`` when one is given."""
    wanted = {c: types.get(c, default) for c in df.columns}
    return df.withColumns({c: cast_column(df, c, t) for c, t in wanted.items() if t})


def column_type(dtype: T.DataType) -> str:
    """Reference-table column type of a Spark type."""
    if isinstance(dtype, T.BooleanType):
        return "Bool"
    if isinstance(dtype, T.NumericType):
        return "Numeric"
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "DateTime"
    if isinstance(dtype, T.StringType):
        return "String"
    return "Numeric"
