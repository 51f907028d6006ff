"""A Parquet table in versions: files are written first, and one manifest makes them current."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugework.operators.filters import bound as wall_clock
from gaugework.operators.joins import lookup
from gaugework.operators.reftable import upsert
from gaugework.session import kept, literal_table, new_folder

MONTH = "yyyy-MM"


def months(start=None, end=None, column: str = "month") -> Column:
    """Months that an inclusive time range can reach, as a constant partition filter."""
    condition = F.lit(True)
    for bound, is_start in ((start, True), (end, False)):
        if bound is not None:
            month = F.date_format(wall_clock(bound).cast("timestamp_ntz"), MONTH)
            condition = condition & (F.col(column) >= month if is_start else F.col(column) <= month)
    return condition


def one_per_key(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows, or an error where two of them share a key; keys may be null. The counts combine before the shuffle."""
    value = F.struct(*[F.col(f"`{c}`") for c in rows.columns if c not in keys] or [F.lit(1).alias("one")])
    repeated = F.raise_error(F.lit("rows share a key; name the order that picks one")).cast(rows.select(value.alias("v")).schema["v"].dataType)
    only = F.when(F.count(F.lit(1)) > 1, repeated).otherwise(F.first(value)).alias("__row")
    reduced = rows.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(only)
    return reduced.select(*[F.col(f"`{c}`") if c in keys else F.col(f"__row.`{c}`") for c in rows.columns])


def stored_once(rows: DataFrame) -> DataFrame:
    folder = new_folder(rows.sparkSession, "batch")
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


class Conflict(RuntimeError):
    """Another writer has made the version that this change was to become."""


class PartitionedTable:
    """Rows under one path, clustered by a few columns, changed file by file.

    ``data`` holds Parquet files in a folder per change, ``manifests`` one Parquet table per version that names its files
    with partition, row count and the least and greatest values of the ``order`` columns, ``versions`` one small file per version that
    names its manifest. A change writes its files, then its manifest, then the version: whoever reads takes one version,
    and what a broken-off change has written is named by none. Files that a filter on the manifest excludes are never opened.

    Writing rebalances by partition, which splits a hot partition over many files; small partitions share a file, so there are no
    more files than the rows need.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, partitions: list[str], order: list[str]):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.partitions, self.order = partitions, order
        ends = T.StructType([schema[c] for c in order])
        self.manifest_schema = T.StructType([
            T.StructField("file", T.StringType()), T.StructField("rows", T.LongType()), *[schema[c] for c in partitions],
            T.StructField("low", ends), T.StructField("high", ends),
        ])

    def _folder(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), p

    # --- versions ------------------------------------------------------------------------------------
    def versions(self) -> list[int]:
        fs, p = self._folder(f"{self.path}/versions")
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(int(n) for n in names if n.isdigit())

    def version(self) -> int | None:
        """The current version; it is taken once for each read or change."""
        return max(self.versions(), default=None)

    def exists(self) -> bool:
        return self.version() is not None

    def files(self, version: int | None = None) -> DataFrame:
        """The manifest: one row for each file and partition in it."""
        version = self.version() if version is None else version
        if version is None:
            return literal_table(self.spark, [], self.manifest_schema)
        fs, p = self._folder(f"{self.path}/versions/{version:012d}")
        stream = fs.open(p)
        try:
            name = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        return self.spark.read.schema(self.manifest_schema).parquet(f"{self.path}/manifests/{name}")

    def _commit(self, entries: DataFrame, base: int | None) -> None:
        """Make the files of ``entries`` the version after ``base``, or raise if another writer was first."""
        name = uuid.uuid4().hex
        entries.write.parquet(f"{self.path}/manifests/{name}")
        fs, final = self._folder(f"{self.path}/versions/{0 if base is None else base + 1:012d}")
        _, staged = self._folder(f"{self.path}/versions/{name}.staged")
        stream = fs.create(staged, False)
        stream.write(bytearray(name.encode()))
        stream.close()
        if fs.exists(final) or not fs.rename(staged, final):
            fs.delete(staged, False)
            raise Conflict(f"{self.path} has changed since version {base}")

    def expire(self, keep: int = 1) -> None:
        """Forget all but the last ``keep`` versions and delete the files that only those had."""
        numbers = self.versions()
        old, recent = numbers[:-keep], numbers[-keep:]
        if not old:
            return
        named = lambda ns: reduce(DataFrame.union, [self.files(n).select("file") for n in ns]).distinct()
        gone = [r["file"] for r in lookup(named(old), named(recent), ["file"], "left_anti").collect()]
        for path in [*[f"versions/{n:012d}" for n in old], *[f"data/{f}" for f in gone]]:
            fs, p = self._folder(f"{self.path}/{path}")
            fs.delete(p, True)

    # --- rows ----------------------------------------------------------------------------------------
    def _rows_of(self, files: DataFrame) -> DataFrame:
        """Rows of the files that a manifest, whole or filtered, names."""
        names = sorted(r["file"] for r in files.select("file").distinct().collect())
        if not names:
            return literal_table(self.spark, [], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/data/{n}" for n in names])

    def read(self, version: int | None = None, files: DataFrame | None = None) -> DataFrame:
        """Rows of a version, the current one by default, or of the files named by a filtered manifest."""
        return self._rows_of(self.files(version) if files is None else files)

    def _write(self, rows: DataFrame) -> DataFrame:
        """Write rows to a new folder and return the manifest's rows for its files."""
        batch = uuid.uuid4().hex
        clustered = [F.col(f"`{c}`") for c in self.partitions]
        rows.select(*[F.col(f"`{c}`") for c in self.schema.names]).hint("rebalance", *clustered).sortWithinPartitions(
            *clustered, *[F.col(f"`{c}`") for c in self.order],
        ).write.parquet(f"{self.path}/data/{batch}")
        written = self.spark.read.schema(self.schema).parquet(f"{self.path}/data/{batch}")
        file = F.concat(F.lit(f"{batch}/"), F.col("_metadata.file_name")).alias("file")
        ends = lambda pick: F.struct(*[pick(F.col(f"`{c}`")).alias(c) for c in self.order])
        found = written.groupBy(file, *clustered).agg(F.count(F.lit(1)).alias("rows"), ends(F.min).alias("low"), ends(F.max).alias("high"))
        return found.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.manifest_schema])

    def _replace(self, current: DataFrame, touched: DataFrame, rows: DataFrame, base: int) -> None:
        """A version without the files of ``touched`` and with ``rows`` instead."""
        rest = lookup(current, touched.select("file").distinct(), ["file"], "left_anti")
        self._commit(rest.unionByName(self._write(rows)), base)

    def save(self, new: DataFrame, keys: list[str], skip_existing: bool = False) -> None:
        """Upsert, or only add the rows whose key is not stored yet. Repeated keys within ``new`` raise.

        ``new`` is computed once, into the shared folder, and used from there. Only files that hold a partition of ``new`` are read
        and replaced; which those are is a join of the manifest with the batch.
        """
        new = stored_once(one_per_key(new, keys))
        base = self.version()
        if base is None:
            self._commit(self._write(new), None)
            return
        current = self.files(base)
        reached = new.select(*[F.col(f"`{c}`") for c in self.partitions]).distinct()
        touched = kept(lookup(current, reached, self.partitions, "left_semi", null_safe=True).select("file").distinct())
        self._replace(current, touched, upsert(self._rows_of(touched), new, keys, skip_existing), base)

    def delete(self, condition: Column | None = None, keys: DataFrame | None = None, on: list[str] | None = None, files: DataFrame | None = None) -> None:
        """Delete the rows that meet the condition and, when ``keys`` is given, match one of its rows.

        ``files`` is the manifest filtered to the files that can hold such rows. Only files that do hold some are replaced.
        """
        base = self.version()
        if base is None:
            return
        current = self.files(base)
        if condition is None and keys is None:
            self._commit(current.limit(0), base)
            return
        gone = F.coalesce(condition, F.lit(False)) if condition is not None else F.lit(True)
        file = F.regexp_extract("_metadata.file_path", "data/([^/]+/[^/]+)$", 1).alias("__file")
        reached = self.read(base) if files is None else self.read(files=files)
        if not reached.inputFiles():
            return
        stored = reached.select("*", file)
        hit = stored.where(gone) if keys is None else lookup(stored.where(gone), keys, on, "left_semi", null_safe=True)
        touched = kept(hit.select(F.col("__file").alias("file")).distinct())
        if touched.isEmpty():
            return
        rows = self._rows_of(touched)
        left = rows.where(~gone) if keys is None else lookup(rows, keys, on, "left_anti", null_safe=True, condition=gone)
        self._replace(current, touched, left, base)

    def drop(self) -> None:
        fs, p = self._folder(self.path)
        fs.delete(p, True)
