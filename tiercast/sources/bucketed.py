"""The snapshot table in buckets by customer, so that an upsert does not move stored rows.

The files of a run date are split by the hash of the customer id, one sorted file per bucket, and a
catalog entry over the folder tells Spark so. A full outer join on the customer then needs an
exchange of the batch alone. The number of buckets is fixed when the table is first written, in a
pointer beside the data.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiercast.sources.pointer import latest, publish
from tiercast.sources.snapshot import snapshot_schema, stored_folders

# Enough for files of a few hundred MB at 20 million customers a bucket; give more for larger tables.
BUCKETS = 64


class BucketedSnapshot:
    """A table below one path, with its entry in the session's catalog."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        customer_type: T.DataType = T.LongType(),
        buckets: int = BUCKETS,
    ) -> None:
        self._spark, self._path = spark, path
        self.data = f"{path}/data"
        self.schema = snapshot_schema(customer_type)
        number, layout = latest(spark, f"{path}/layout")
        if number < 0:
            layout = {"buckets": buckets}
            publish(spark, f"{path}/layout", 0, layout)
        self.buckets = layout["buckets"]
        self.name = f"tiercast_{hashlib.sha256(path.encode()).hexdigest()[:16]}"
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in self.schema)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}) USING parquet"
            " PARTITIONED BY (run_date)"
            f" CLUSTERED BY (customer_id) SORTED BY (customer_id) INTO {self.buckets} BUCKETS"
            f" LOCATION '{self.data}'"
        )

    def stored(self, run_dates: Sequence[dt.date]) -> DataFrame | None:
        """The rows of these dates, in buckets, or None if nothing is stored for them."""
        days = [
            folder.rsplit("=", 1)[1] for folder in stored_folders(self._spark, self.data, run_dates)
        ]
        for day in days:
            # The entry lists only the dates that are read.
            self._spark.sql(f"ALTER TABLE {self.name} ADD IF NOT EXISTS PARTITION (run_date = '{day}')")
        if not days:
            return None
        wanted = F.col("run_date").isin([dt.date.fromisoformat(day) for day in days])
        return self._spark.table(self.name).where(wanted).select(*self.schema.fieldNames())

    def dealt(self, batch: DataFrame) -> DataFrame:
        """The batch with the rows of each bucket in one task."""
        return batch.repartition(self.buckets, "customer_id")

    def replace(self, rows: DataFrame) -> None:
        """Replace the dates that the rows hold; rows have to be dealt by bucket already."""
        columns = [name for name in self.schema.fieldNames() if name != "run_date"]
        # A writer's option does not reach an insert into a catalog table.
        conf, key = self._spark.conf, "spark.sql.sources.partitionOverwriteMode"
        before = conf.get(key)
        conf.set(key, "dynamic")
        try:
            rows.select(*columns, "run_date").write.insertInto(self.name, overwrite=True)
        finally:
            conf.set(key, before)

    def read(self) -> DataFrame:
        """All rows that are stored."""
        reader = self._spark.read.option("basePath", self.data).schema(self.schema)
        return reader.parquet(self.data).select(*self.schema.fieldNames())

    def forget(self) -> None:
        """Drop the catalog entry; the data stay."""
        self._spark.sql(f"DROP TABLE IF EXISTS {self.name}")
