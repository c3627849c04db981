"""Orders that keep arriving: a file stream whose batches go into the stored metrics and the snapshot.

The stream's checkpoint numbers the batches and repeats an unfinished one with the same number and
the same files. Both sinks take that number into account: the stored metrics replace the increment of
a repeated batch, and the snapshot is an upsert by key. So a batch that runs twice counts once.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tiercast.config import DailyConfig, OrderColumns
from tiercast.plans.job import run_incremental
from tiercast.sources.orders import as_orders


def read_order_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    columns: OrderColumns = OrderColumns(),
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Orders from files as they appear below a path."""
    reader = spark.readStream.format(fmt).schema(schema).options(**(options or {}))
    return as_orders(reader.load(path), columns)


def ingest_orders(
    orders: DataFrame,
    checkpoint: str,
    metrics_path: str,
    target: str,
    config: DailyConfig = DailyConfig(),
    detailed: bool = False,
) -> None:
    """Score everything that has arrived since the last call, batch by batch, and return."""

    def score(batch: DataFrame, number: int) -> None:
        run_incremental(batch, number, metrics_path, target, config, detailed)

    (
        orders.writeStream.foreachBatch(score)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
