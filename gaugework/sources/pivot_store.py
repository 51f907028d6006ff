"""Saved pivot tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gaugework.functions.names import col


def save_pivot(df: DataFrame, root: str, name: str) -> None:
    df.write.mode("overwrite").parquet(f"{root}/{name}")


def load_pivot(spark: SparkSession, root: str, name: str, rows: int = 0, order: list[str] | None = None) -> DataFrame:
    """The saved table; 0 rows means all. The first rows are those least in ``order``, by default in all columns from the left."""
    saved = spark.read.parquet(f"{root}/{name}")
    if rows <= 0:
        return saved
    sortable = [f.name for f in saved.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return saved.orderBy(*map(col, order or sortable)).limit(rows)


def delete_pivot(spark: SparkSession, root: str, name: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
    fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return fs.delete(path, True)
