"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Runtime settings; none of them depends on the size of the cluster.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where a grouping on the same key follows.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def local_session(cpus: int | str = "*", app: str = "gaugework", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    settings = {
        **DEFAULTS,
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made elsewhere."""
    for key, value in DEFAULTS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


_LOCAL_FOLDER: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only where the session does not name one and runs locally (a test) is a temporary folder made. What lies in the folder is
    the cluster's to clear, as with any checkpoint directory.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not _LOCAL_FOLDER or not os.path.isdir(_LOCAL_FOLDER[-1]):
        _LOCAL_FOLDER.append(tempfile.mkdtemp(prefix="gaugework-"))
    return _LOCAL_FOLDER[-1]


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is ever reused or cleared."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def kept(df: DataFrame) -> DataFrame:
    """A result that several steps use, computed once into the shared folder and cut from its lineage.

    Meant for dimension-sized results; a lost executor costs nothing, since the files are shared.
    """
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def literal_table(spark: SparkSession, rows: list[tuple], schema: str | T.StructType) -> DataFrame:
    """Rows written in code as a local relation, whose size the optimizer knows."""
    fields = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    if not rows:
        return spark.range(1).where(F.lit(False)).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])
    arrow = pa.Table.from_pylist([dict(zip(fields.names, r)) for r in rows], to_arrow_schema(fields))
    return spark.createDataFrame(arrow, fields)
