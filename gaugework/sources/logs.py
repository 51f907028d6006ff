"""The log table: a fixed set of optional fields, appended to."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The log fields and the defaults.
FIELDS = {
    "Timestamp": T.TimestampNTZType(),
    "Message": T.StringType(),
    "Category": T.StringType(),
    "UserName": T.StringType(),
    "Severity": T.StringType(),
    "Workspace": T.StringType(),
    "Schedule": T.StringType(),
    "Workflow": T.StringType(),
    "StartTime": T.TimestampNTZType(),
    "EndTime": T.TimestampNTZType(),
    "Script": T.StringType(),
    "Entity": T.StringType(),
    "Signal": T.StringType(),
    "Unit": T.StringType(),
    "Tag": T.StringType(),
    "NumberOfItems": T.LongType(),
    "ValueBefore": T.StringType(),
    "ValueAfter": T.StringType(),
    "ElapsedTime": T.DoubleType(),
    "MessageDetails": T.StringType(),
    "Directory": T.StringType(),
}
SCRIPT_CATEGORY = "Python Script"
WORKFLOW_CATEGORY, WORKFLOW_USER = "Workflow Execution", "WorkflowService"
SCHEMA = T.StructType([T.StructField(n, t) for n, t in FIELDS.items()])


def log_rows(rows: DataFrame, category: str = SCRIPT_CATEGORY) -> DataFrame:
    """Rows with every log field; absent fields are null, Category has a default."""
    given = {c.lower(): c for c in rows.columns}
    cells = []
    for name, dtype in FIELDS.items():
        cell = F.col(given[name.lower()]) if name.lower() in given else F.lit(None)
        cell = cell.cast(dtype)
        if name == "Category":
            cell = F.coalesce(cell, F.lit(category))
        cells.append(cell.alias(name))
    return rows.select(*cells)


def workflow_log_rows(rows: DataFrame, workflow: str) -> DataFrame:
    named = rows.withColumns({"Workflow": F.lit(workflow), "UserName": F.lit(WORKFLOW_USER)})
    return log_rows(named, WORKFLOW_CATEGORY)


def append_logs(logs: DataFrame, path: str) -> None:
    logs.select(*FIELDS).write.mode("append").parquet(path)


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def with_logs(rows: DataFrame, message: str) -> tuple[DataFrame, DataFrame]:
    """A job's rows together with its log rows."""
    return rows, activity_log(rows, message)


def activity_log(samples: DataFrame, message: str) -> DataFrame:
    """One log row per entity and signal with the number of samples."""
    counts = samples.groupBy("entity", "signal").agg(F.count(F.lit(1)).alias("NumberOfItems"))
    return log_rows(counts.withColumn("Message", F.lit(message)))
