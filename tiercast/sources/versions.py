"""The snapshot table in versions: an upsert rewrites the files that hold its keys, all or nothing.

A version is a list of files with their ranges of dates and customers. New files and a new list are
written aside; a numbered pointer then makes them the table. A run that ends before leaves the
version before it, for all its dates; of two runs that started from the same version the second
fails with ``Conflict`` and can be repeated. Files are sorted by date and customer, so their ranges
hardly overlap. Versions that are no longer current stay readable until ``clean``.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiercast.operators.scratch import hadoop_path
from tiercast.sources.pointer import latest, publish
from tiercast.sources.snapshot import KEYS, snapshot_schema

ROWS_PER_FILE = 1_000_000


class Version(NamedTuple):
    """``number`` is -1 before the first one; ``manifest`` names the folder of its list."""

    number: int
    manifest: str | None


class VersionedSnapshot:
    """A table below one path."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        customer_type: T.DataType = T.LongType(),
        rows_per_file: int = ROWS_PER_FILE,
    ) -> None:
        self._spark, self._path, self._rows_per_file = spark, path, rows_per_file
        self.schema = snapshot_schema(customer_type)
        customer = customer_type.simpleString()
        self._listed = (
            f"file string, first_date date, last_date date, low {customer}, high {customer}, n long"
        )

    def current(self) -> Version:
        number, content = latest(self._spark, f"{self._path}/versions")
        return Version(number, content.get("manifest"))

    def files(self, version: Version) -> DataFrame:
        """``(file, first_date, last_date, low, high, n)`` of a version."""
        if version.manifest is None:
            return self._spark.createDataFrame([], self._listed)
        return self._spark.read.schema(self._listed).parquet(f"{self._path}/{version.manifest}")

    def read_files(self, files: Sequence[str]) -> DataFrame:
        if not files:
            return self._spark.createDataFrame([], self.schema)
        return self._spark.read.schema(self.schema).parquet(*files)

    def n_rows(self, version: Version, files: Sequence[str]) -> int:
        """The rows that these files of a version hold."""
        named = self._spark.createDataFrame([(file,) for file in files], "file string")
        return self.files(version).join(named, "file", "left_semi").agg(F.sum("n")).first()[0] or 0

    def read(
        self, run_dates: Sequence[dt.date] | None = None, version: Version | None = None
    ) -> DataFrame:
        """The rows of a version, the current one if none is given; of some dates only, if these
        are. Files without them are not opened."""
        files = self.files(version or self.current())
        if run_dates is None:
            return self.read_files([row.file for row in files.select("file").collect()])
        near = (F.col("first_date") <= F.lit(max(run_dates))) & (
            F.col("last_date") >= F.lit(min(run_dates))
        )
        rows = self.read_files([row.file for row in files.where(near).select("file").collect()])
        return rows.where(F.col("run_date").isin(list(run_dates)))

    def touched(self, version: Version, batch: DataFrame) -> list[str]:
        """The files that hold a key of the batch.

        Ranges leave most files out; of the others the key columns are read and met with the batch.
        """
        # One row per date.
        spans = batch.groupBy(F.col("run_date").alias("day")).agg(
            F.min("customer_id").alias("least"), F.max("customer_id").alias("most")
        )
        one_date = F.col("first_date") == F.col("last_date")
        overlaps = (F.col("low") <= F.col("most")) & (F.col("high") >= F.col("least"))
        within = F.col("day").between(F.col("first_date"), F.col("last_date"))
        near = self.files(version).join(
            F.broadcast(spans), within & (~one_date | overlaps), "left_semi"
        )
        candidates = [row.file for row in near.select("file").collect()]
        if not candidates:
            return []
        keys = self.read_files(candidates).select(*KEYS, F.col("_metadata.file_path").alias("file"))
        hit = keys.join(batch.select(*KEYS), list(KEYS), "left_semi").select("file").distinct()
        return [row.file for row in hit.collect()]

    def write(self, rows: DataFrame, n_rows: int, version: Version, replaced: Sequence[str]) -> str:
        """Write rows aside, and the list of the files that are to be the table; returns its name.

        ``replaced`` are the files of ``version`` whose rows are among the given ones.
        """
        name = uuid.uuid4().hex
        folder = f"{self._path}/files/{name}"
        tasks = max(-(-n_rows // self._rows_per_file), 1)
        (
            rows.select(*self.schema.fieldNames())
            .repartitionByRange(tasks, *KEYS)
            .sortWithinPartitions(*KEYS)
            .write.parquet(folder)
        )
        written = (
            self._spark.read.schema(self.schema)
            .parquet(folder)
            .groupBy(F.col("_metadata.file_path").alias("file"))
            .agg(
                F.min("run_date").alias("first_date"),
                F.max("run_date").alias("last_date"),
                F.min("customer_id").alias("low"),
                F.max("customer_id").alias("high"),
                F.count("*").alias("n"),
            )
        )
        gone = self._spark.createDataFrame([(file,) for file in replaced], "file string")
        kept = self.files(version).join(gone, "file", "left_anti")
        manifest = f"manifests/{name}"
        kept.unionByName(written).coalesce(8).write.parquet(f"{self._path}/{manifest}")
        return manifest

    def publish(self, version: Version, manifest: str) -> None:
        """Make a list that was written from ``version`` the table."""
        publish(
            self._spark, f"{self._path}/versions", version.number + 1, {"manifest": manifest}
        )

    def clean(self) -> None:
        """Remove files and lists that the current version does not use. Tables of older versions
        and runs under way must not be in use."""
        version = self.current()
        used = {row.file.rsplit("/", 2)[1] for row in self.files(version).select("file").collect()}
        listed = {version.manifest.split("/")[1]} if version.manifest else set()
        for folder, kept in (("files", used), ("manifests", listed)):
            location, files = hadoop_path(self._spark, f"{self._path}/{folder}")
            for entry in files.listStatus(location) if files.exists(location) else ():
                if entry.getPath().getName() not in kept:
                    files.delete(entry.getPath(), True)
