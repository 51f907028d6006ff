"""Delimited, JSON, text and binary files, single or by folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugework.functions.casts import CSV_DATE_TEXT, type_name
from gaugework.functions.names import col
from gaugework.session import literal_table

# Microseconds are kept in text files, which Spark's default layout would cut to milliseconds.
TIME_TEXT = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]"}
_TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)
_SPARK_TYPES = {"numeric": "double", "time": "timestamp_ntz", "string": "string", "bool": "boolean", "object": "string"}


def read_delimited(spark: SparkSession, path: str, delimiter: str = "\t", schema=None) -> DataFrame:
    """A delimited file with a header; without a schema all columns are text, so nothing is read twice."""
    reader = spark.read.options(**TIME_TEXT).option("header", True).option("sep", delimiter)
    return (reader.schema(schema) if schema else reader).csv(path)


def csv_ready(df: DataFrame, date_format: bool = True) -> DataFrame:
    """Time columns as text in the one fixed layout, when a date format is asked for."""
    if not date_format:
        return df
    times = [f.name for f in df.schema if isinstance(f.dataType, _TIMES)]
    return df.withColumns({c: F.date_format(col(c), CSV_DATE_TEXT) for c in times})


def write_csv(df: DataFrame, path: str, delimiter: str = ",", date_format: bool = True) -> None:
    """CSV with a header and no row index, one file per partition."""
    csv_ready(df, date_format).write.options(**TIME_TEXT).option("header", True).option("sep", delimiter).csv(path)


def read_csv(spark: SparkSession, path: str, schema=None) -> DataFrame:
    return read_delimited(spark, path, ",", schema)


def write_json(df: DataFrame, path: str) -> None:
    df.write.options(**TIME_TEXT).json(path)


def read_json(spark: SparkSession, path: str, schema=None, multi_line: bool = False) -> DataFrame:
    """JSON lines split across tasks; ``multi_line`` is for files that hold one document."""
    reader = spark.read.options(**TIME_TEXT).option("multiLine", multi_line)
    return (reader.schema(schema) if schema else reader).json(path)


def read_bytes(spark: SparkSession, path: str) -> DataFrame:
    """(path, modificationTime, length, content) per file."""
    return spark.read.format("binaryFile").load(path)


def read_text(spark: SparkSession, path: str, whole: bool = False) -> DataFrame:
    return spark.read.text(path, wholetext=whole)


def list_files(spark: SparkSession, folder: str, prefix: str = "") -> DataFrame:
    """(name, length) of the files below a folder, names relative to it, optionally by prefix.

    The content column is not selected, so file bytes are never read.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    names = found.select(relative_name(F.col("path"), folder).alias("name"), "length")
    return names.where(F.col("name").startswith(prefix)) if prefix else names


def read_folder(spark: SparkSession, folder: str, prefix: str = "") -> DataFrame:
    """(name, line) of every text file below a folder, with the relative path kept."""
    lines = spark.read.option("recursiveFileLookup", True).text(folder)
    named = lines.select(relative_name(F.col("_metadata.file_path"), folder).alias("name"), F.col("value").alias("line"))
    return named.where(F.col("name").startswith(prefix)) if prefix else named


def write_per_entity(df: DataFrame, path: str, entity: str = "Entity") -> None:
    """One directory per entity; a hot entity is written by many tasks."""
    df.hint("rebalance", col(entity)).write.partitionBy(entity).parquet(path)


def relative_name(path, folder: str):
    base = folder.split(":", 1)[-1].strip("/")
    return F.regexp_replace(path, rf"^(?:[a-z0-9]+:)?/*\Q{base}\E/*", "")


def empty_table(spark: SparkSession, columns: dict[str, str | list]) -> DataFrame:
    """An empty table from type names; columns given as values keep their type only."""

    def spark_type(given) -> str:
        if isinstance(given, str):
            return _SPARK_TYPES[type_name(given)]
        kinds = {type(v) for v in given if v is not None}
        if kinds == {bool}:
            return "boolean"
        return "double" if kinds and kinds <= {int, float} else "string"

    schema = T.StructType()
    for name, given in columns.items():
        schema = schema.add(name, spark_type(given))
    return literal_table(spark, [], schema)
