"""Intermediate tables: staged in the folder shared by all executors, or held in the plan."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


@lru_cache(maxsize=1)
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="tiercast-")


def shared_root(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only where driver and executors are one
    process. The session is left as it is."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = _local_root()
    return root.rstrip("/")


def hadoop_path(spark: SparkSession, path: str):
    """A path in any file system Spark reaches, and that file system."""
    context = spark.sparkContext
    location = context._jvm.org.apache.hadoop.fs.Path(path)
    return location, location.getFileSystem(context._jsc.hadoopConfiguration())


class Scratch:
    """A private subfolder for staged tables.

    A staged table is written once and read back, so that every later pass sees the same rows
    without repeating the aggregation, also after executors were lost. As a context manager the
    folder is removed at the end; otherwise it stays until the application ends, for as long as a
    lazy result may need it.
    """

    def __init__(self, spark: SparkSession) -> None:
        self._spark = spark
        self.path = f"{shared_root(spark)}/tiercast-{uuid.uuid4().hex}"
        self._folder, self._files = hadoop_path(spark, self.path)
        self._files.mkdirs(self._folder)
        self._files.deleteOnExit(self._folder)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        self.remove()

    def remove(self) -> None:
        self._files.delete(self._folder, True)

    def stage(self, frame: DataFrame, name: str, row_group_bytes: int | None = None) -> DataFrame:
        """Write and read back. Smaller row groups take less memory to write."""
        target = f"{self.path}/{name}"
        writer = frame.write
        if row_group_bytes is not None:
            writer = writer.option("parquet.block.size", str(row_group_bytes))
        writer.parquet(target)
        return self._spark.read.schema(frame.schema).parquet(target)


def plan_bytes(frame: DataFrame) -> int:
    """Catalyst's size estimate, the figure Spark itself uses to choose broadcast joins."""
    stats = frame._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def plan_table(
    spark: SparkSession, rows: list[dict], schema: pa.Schema | None = None
) -> DataFrame:
    """A few driver-made rows as a local relation, whose exact size Catalyst knows."""
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema=schema))
