"""Signal samples on disk, clustered by type, month and a bucket of the signal."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugework.functions.vocabulary import canonical
from gaugework.operators.filters import bound
from gaugework.operators.joins import lookup
from gaugework.sources.logs import activity_log, append_logs
from gaugework.session import literal_table
from gaugework.sources.partitioned import MONTH, PartitionedTable, months, stored_once

SCHEMA = T.StructType(
    [
        T.StructField("entity", T.StringType()),
        T.StructField("unit", T.StringType()),
        T.StructField("scenario", T.StringType()),
        T.StructField("date", T.TimestampNTZType()),
        T.StructField("depth", T.DoubleType()),
        T.StructField("pressure", T.DoubleType()),
        T.StructField("temperature", T.DoubleType()),
        T.StructField("value_num", T.DoubleType()),
        T.StructField("value_str", T.StringType()),
        T.StructField("signal_type", T.StringType()),
        T.StructField("signal", T.StringType()),
        T.StructField("month", T.StringType()),
        T.StructField("bucket", T.IntegerType()),
    ]
)
NO_MONTH = "none"
BUCKETS = 64
IDENTITY = ["signal_type", "signal", "entity", "scenario", "date", "depth", "pressure", "temperature"]


def bucket(signal: str = "signal") -> Column:
    return F.pmod(F.xxhash64(signal), F.lit(BUCKETS)).cast("int")


class SignalStore:
    """Samples of all seven signal types.

    Rows lie by type, month and bucket of the signal, in order of signal and entity, so there are as many files as the rows need
    however many signals there are. A load opens only the files whose least and greatest values reach what it asks for.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.table = PartitionedTable(spark, path, SCHEMA, ["signal_type", "month", "bucket"], ["signal", "entity", "date", "depth"])

    @staticmethod
    def shaped(samples: DataFrame, signal_type: str | None = None) -> DataFrame:
        """Samples with every stored column, absent ones null."""
        typed = samples.withColumn("signal_type", F.lit(canonical("signal type", signal_type))) if signal_type else samples
        given = set(typed.columns)
        cells = {f.name: (F.col(f.name) if f.name in given else F.lit(None)).cast(f.dataType) for f in SCHEMA}
        cells["month"] = F.coalesce(F.date_format(cells["date"], MONTH), F.lit(NO_MONTH))
        cells["bucket"] = bucket()
        return typed.select(*[c.alias(n) for n, c in cells.items()])

    def save(self, samples: DataFrame, signal_type: str | None = None) -> None:
        self.table.save(self.shaped(samples, signal_type), IDENTITY)

    def save_with_logs(self, samples: DataFrame, log_path: str, signal_type: str | None = None) -> DataFrame:
        """Save and also append one log row per entity and signal."""
        rows = stored_once(self.shaped(samples, signal_type))
        self.table.save(rows, IDENTITY)
        logs = activity_log(rows, "Saved")
        append_logs(logs, log_path)
        return logs

    def files(
        self, signals: DataFrame | None = None, types: list[str] | None = None, ranges: dict[str, tuple] | None = None, version: int | None = None,
    ) -> DataFrame:
        """The manifest's rows for files that can hold the signals (a column ``signal``) and, on one of the axes, the ranges."""
        found = self.table.files(version)
        if types is not None:
            found = found.where(F.col("signal_type").isin(types))
        if ranges:
            reached = F.lit(False)
            for axis, (start, end) in ranges.items():
                low, high = (F.col(f"{side}.{axis}") for side in ("low", "high"))
                dtype = SCHEMA[axis].dataType
                on = F.lit(True)
                if start is not None:
                    on = on & (high >= bound(start).cast(dtype))
                if end is not None:
                    on = on & (low <= bound(end).cast(dtype))
                reached = reached | (on & months(start, end) if axis == "date" else on)
            found = found.where(reached)
        if signals is not None:
            wanted = signals.select(F.col("signal").alias("__signal"), bucket("signal").alias("bucket")).distinct()
            between = (F.col("low.signal") <= F.col("__signal")) & (F.col("high.signal") >= F.col("__signal"))
            found = found.join(wanted.withColumnRenamed("bucket", "__bucket"), (F.col("bucket") == F.col("__bucket")) & between, "left_semi")
        return found

    def scan(
        self,
        signals: list[str] | None = None,
        entities: DataFrame | None = None,
        signal_type: str | list[str] | None = None,
        scenario: str | None = None,
        start=None,
        end=None,
        depth_start=None,
        depth_end=None,
        version: int | None = None,
    ) -> DataFrame:
        """Samples of the wanted signals, types and entities, of one version.

        With a time or a depth range come the samples inside it; with both, those inside either, as a sample has one axis.
        """
        types = [canonical("signal type", t) for t in ([signal_type] if isinstance(signal_type, str) else signal_type)] if signal_type else None
        given = {"date": (start, end), "depth": (depth_start, depth_end)}
        ranges = {axis: ends for axis, ends in given.items() if ends != (None, None)}
        names = literal_table(self.spark, [(s,) for s in signals], "signal string") if signals is not None else None
        rows = self.table.read(files=self.files(names, types, ranges, version))
        if types is not None:
            rows = rows.where(F.col("signal_type").isin(types))
        if signals is not None:
            rows = rows.where(F.col("signal").isin(signals))
        if scenario:
            rows = rows.where(F.col("scenario") == scenario)
        if ranges:
            inside = {axis: range_condition(rows, axis, *ends) for axis, ends in ranges.items()}
            if "date" in inside:
                inside["date"] = inside["date"] & months(start, end)  # skips row groups of other months
            rows = rows.where(reduce(lambda a, b: a | b, inside.values()))
        if entities is not None:
            rows = lookup(rows, entities.select("name"), [("entity", "name")], "left_semi")
        return rows

    def delete(self, pairs: DataFrame, axis: str | None = None, start=None, end=None) -> None:
        """Delete by (entity, signal) rows and an optional inclusive range of date or depth."""
        ranges = {axis: (start, end)} if axis and (start, end) != (None, None) else None
        inside = range_condition(self.table.read(files=self.table.files().limit(0)), axis, start, end)
        self.table.delete(inside, pairs.select("entity", "signal"), ["entity", "signal"], self.files(pairs, None, ranges))


def range_condition(df: DataFrame, axis: str | None, start=None, end=None) -> Column:
    condition = F.lit(True)
    if axis and start is not None:
        condition = condition & (F.col(axis) >= bound(start).cast(df.schema[axis].dataType))
    if axis and end is not None:
        condition = condition & (F.col(axis) <= bound(end).cast(df.schema[axis].dataType))
    return condition


def without_pairs(samples: DataFrame, pairs: DataFrame, axis: str | None = None, start=None, end=None) -> DataFrame:
    """What a delete leaves, as a plain DataFrame."""
    inside = range_condition(samples, axis, start, end)
    return lookup(samples, pairs.select("entity", "signal"), ["entity", "signal"], "left_anti", condition=inside)
