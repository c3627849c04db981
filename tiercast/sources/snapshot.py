"""The daily snapshot table: Parquet partitioned by run date, one row per customer and day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiercast.operators.scratch import hadoop_path

KEYS = ("run_date", "customer_id")

# The columns of the stored table.
SNAPSHOT_SCHEMA = T.StructType(
    [
        T.StructField("run_date", T.DateType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("recency_days", T.IntegerType()),
        T.StructField("frequency_orders", T.LongType()),
        T.StructField("monetary_value", T.DoubleType()),
        T.StructField("r_score", T.IntegerType()),
        T.StructField("f_score", T.IntegerType()),
        T.StructField("m_score", T.IntegerType()),
        T.StructField("rfm_score", T.IntegerType()),
        T.StructField("rfm_segment", T.StringType()),
        T.StructField("comments", T.StringType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("updated_at", T.TimestampNTZType()),
        T.StructField("logs", T.StringType()),
    ]
)


def snapshot_schema(customer_type: T.DataType) -> T.StructType:
    """The columns of a table whose customers have ids of this type."""
    return T.StructType(
        [
            T.StructField(f.name, customer_type if f.name == "customer_id" else f.dataType)
            for f in SNAPSHOT_SCHEMA
        ]
    )


def _read(
    spark: SparkSession, path: str, folders: list[str], customer_type: T.DataType
) -> DataFrame:
    schema = snapshot_schema(customer_type)
    if not folders:
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
        return spark.range(0).select(*nothing)
    # The explicit schema keeps run_date a date instead of an inferred type.
    reader = spark.read.option("basePath", path).schema(schema)
    return reader.parquet(*folders).select(*schema.fieldNames())


def read_snapshot(
    spark: SparkSession, path: str, customer_type: T.DataType = T.LongType()
) -> DataFrame:
    """The stored snapshot, empty if nothing has been written yet."""
    location, files = hadoop_path(spark, path)
    return _read(spark, path, [path] if files.exists(location) else [], customer_type)


def stored_folders(spark: SparkSession, path: str, run_dates: Sequence[dt.date]) -> list[str]:
    """The partitions of these dates that exist, from one listing of the table's folder."""
    location, files = hadoop_path(spark, path)
    if not files.exists(location):
        return []
    stored = {entry.getPath().getName() for entry in files.listStatus(location)}
    names = [f"run_date={day.isoformat()}" for day in run_dates]
    return [f"{path}/{name}" for name in names if name in stored]


def read_folders(
    spark: SparkSession, path: str, folders: list[str], customer_type: T.DataType
) -> DataFrame:
    """The stored rows of these partitions. Files of other dates are not even listed."""
    return _read(spark, path, folders, customer_type)
