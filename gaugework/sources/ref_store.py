"""Reference tables on disk: a definition and rows by month."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugework.functions.names import col
from gaugework.operators.reftable import (
    ColumnInfo, RefTable, define, delete_condition, load_rows, to_stored,
)
from gaugework.operators.window import newest
from gaugework.session import literal_table
from gaugework.sources.partitioned import PartitionedTable, months

# Partition column; month of the time part of the key, null for rows without one.
MONTH = "__month"


class RefTableStore:
    def __init__(self, spark: SparkSession, root: str, units: DataFrame):
        self.spark, self.root, self.units = spark, root.rstrip("/"), units

    def _rows(self, table: RefTable) -> PartitionedTable:
        schema = T.StructType().add(table.entity, T.StringType()).add(table.time, T.TimestampNTZType())
        for c in (table.key, *table.values):
            schema = schema.add(c.name, c.stored)
        schema = schema.add(MONTH, T.StringType())
        return PartitionedTable(self.spark, f"{self.root}/{table.name}/rows", schema, [MONTH], table.keys)

    def _stored(self, table: RefTable, df: DataFrame) -> DataFrame:
        named = to_stored(df, table, self.units)
        cells = {table.entity: T.StringType(), table.time: T.TimestampNTZType()}
        cells.update({c.name: c.stored for c in (table.key, *table.values)})
        typed = named.select(*[col(n).cast(t).alias(n) for n, t in cells.items()])
        return typed.withColumn(MONTH, F.date_format(col(table.time), "yyyy-MM"))

    def create(self, name: str, df: DataFrame, description: str = "", save: bool = True, **columns) -> RefTable:
        """Define the table from ``df`` (unless it exists) and save its rows."""
        if name in self.names():
            table = self.info(name)
        else:
            table = define(name, df, description=description, **columns)
            df = df.select(*map(col, table.sources))
            spec = {
                "name": name, "entity": table.entity, "time": table.time, "description": description,
                "columns": [(c.name, c.unit, c.type, c.stored) for c in (table.key, *table.values)],
            }
            literal_table(self.spark, [(name, json.dumps(spec))], "name string, spec string").write.mode(
                "overwrite"
            ).json(f"{self.root}/{name}/definition")
        if save:
            self.save(name, df)
        return table

    def names(self) -> list[str]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        fs = path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def info(self, name: str) -> RefTable:
        row = self.spark.read.schema("name string, spec string").json(f"{self.root}/{name}/definition").head()
        spec = json.loads(row["spec"])
        infos = [ColumnInfo(*c) for c in spec["columns"]]
        return RefTable(name, spec["entity"], spec["time"], infos[0], tuple(infos[1:]), spec["description"])

    def save(self, name: str, df: DataFrame, skip_existing: bool = False, order: str | None = None) -> None:
        """Upsert or skip by key. ``order`` names an extra column that picks the newest of repeated keys."""
        table = self.info(name)
        if order:
            index = [c for c in df.columns if c != order][:3]
            df = newest(df, index, order).drop(order)
        self._rows(table).save(self._stored(table, df), table.keys, skip_existing)

    def version(self, name: str) -> int | None:
        return self._rows(self.info(name)).version()

    def load(self, name: str, start=None, end=None, version: int | None = None, **options) -> DataFrame:
        """Filters reach the scan; a time range also excludes files by month. ``version`` reads the table as it was."""
        table = self.info(name)
        stored = self._rows(table)
        files = stored.files(version)
        if start is not None or end is not None:
            files = files.where(months(start, end, MONTH))
        return load_rows(stored.read(files=files).drop(MONTH), table, self.units, start=start, end=end, **options)

    def delete(
        self, name: str, keys: DataFrame | None = None, start=None, end=None, drop_null_times: bool = False, **conditions
    ) -> None:
        """Delete by conditions combined by AND; a time range also excludes files by month."""
        table = self.info(name)
        condition = delete_condition(table, start=start, end=end, drop_null_times=drop_null_times, **conditions)
        rows, files = self._rows(table), None
        if start is not None or end is not None:
            reached = months(start, end, MONTH)
            files = rows.files().where(reached | F.col(MONTH).isNull() if drop_null_times else reached)
        if keys is None:
            rows.delete(condition, files=files)
            return
        tuples = keys.select(*[col(given).alias(k) for given, k in zip(keys.columns, table.keys)])
        rows.delete(condition, tuples, table.keys, files)

    def drop(self, name: str) -> None:
        """Rows first, then the definition."""
        if name not in self.names():
            return
        self._rows(self.info(name)).drop()
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
