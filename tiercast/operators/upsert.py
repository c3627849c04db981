"""Keyed upsert into the partitioned snapshot table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tiercast.config import LOG_SOURCE
from tiercast.functions.timestamps import wall_clock
from tiercast.operators.scratch import Scratch
from tiercast.sources.bucketed import BucketedSnapshot
from tiercast.sources.snapshot import KEYS, SNAPSHOT_SCHEMA, read_folders, stored_folders
from tiercast.sources.versions import VersionedSnapshot


class UpsertRule(NamedTuple):
    """Which columns a batch row replaces on a key that is already stored."""

    replaced: tuple[str, ...]
    stamps_inserts: bool


# The columns that a conflict replaces.
METRIC_COLUMNS = (
    "recency_days",
    "frequency_orders",
    "monetary_value",
    "r_score",
    "f_score",
    "m_score",
    "rfm_score",
    "rfm_segment",
)
CORE = UpsertRule(METRIC_COLUMNS, stamps_inserts=False)
DETAILED = UpsertRule((*METRIC_COLUMNS, "comments", "logs"), stamps_inserts=True)


def with_logs(batch: DataFrame) -> DataFrame:
    """Append the constant JSON text that names the writing job."""
    return batch.withColumn("logs", F.to_json(F.struct(F.lit(LOG_SOURCE).alias("source"))))


def _checked_keys(run_dates: Sequence[dt.date], customer_type: T.DataType) -> dict[str, Column]:
    """The key columns, failing the write on a row that has no place in the target."""
    day, customer = F.col("run_date"), F.col("customer_id")
    misplaced = F.raise_error(F.lit("run_date is not among the dates of this upsert"))
    anonymous = F.raise_error(F.lit("customer_id must not be NULL in the snapshot table"))
    return {
        "run_date": F.when(day.isin(list(run_dates)), day).otherwise(misplaced.cast("date")),
        "customer_id": F.when(customer.isNotNull(), customer).otherwise(anonymous.cast(customer_type)),
    }


def _distinct_keys(batch: DataFrame) -> DataFrame:
    """The batch, failing the write on a key that it holds twice.

    A later join on the keys finds the rows partitioned and sorted already.
    """
    count = F.count(F.lit(1)).over(Window.partitionBy(*KEYS))
    twice = F.raise_error(F.lit("a customer occurs twice for one run_date")).cast("boolean")
    once = F.when(F.col("_count") == 1, F.lit(True)).otherwise(twice)
    return batch.withColumn("_count", count).where(once).drop("_count")


def merged(
    existing: DataFrame,
    batch: DataFrame,
    rule: UpsertRule,
    stamp: Column,
    by_customer: bool = False,
) -> DataFrame:
    """All rows of the affected partitions after the upsert, and whether the batch held them.

    Presence flags decide, not the values: a NULL in the batch replaces a stored value.
    ``by_customer`` is for tables that are dealt out by customer: it joins on the customer alone,
    and the date is compared within.
    """
    old = existing.withColumn("_stored", F.lit(True)).alias("old")
    new = batch.select(*KEYS, *rule.replaced, F.lit(True).alias("_given")).alias("new")
    stored = F.col("_stored").isNotNull()
    given = F.col("_given").isNotNull()
    absent = F.lit(None).cast("timestamp_ntz")

    columns = {
        name: F.when(given, F.col(f"new.{name}")).otherwise(F.col(f"old.{name}"))
        if name in rule.replaced
        else F.col(f"old.{name}")
        for name in SNAPSHOT_SCHEMA.fieldNames()
        if name not in KEYS
    }
    columns["created_at"] = F.when(stored, F.col("old.created_at")).otherwise(stamp)
    columns["updated_at"] = (
        F.when(given & stored, stamp)
        .when(given, stamp if rule.stamps_inserts else absent)
        .otherwise(F.col("old.updated_at"))
    )
    if by_customer:
        old_day, new_day = F.col("old.run_date"), F.col("new.run_date")
        # As an equality Spark would deal both sides out by it.
        same_day = (old_day <= new_day) & (old_day >= new_day)
        joined = old.join(new, (F.col("old.customer_id") == F.col("new.customer_id")) & same_day, "full")
        keys = [F.coalesce(f"old.{key}", f"new.{key}").alias(key) for key in KEYS]
    else:
        joined, keys = old.join(new, list(KEYS), "full"), list(KEYS)
    return joined.select(
        *keys, *[column.alias(name) for name, column in columns.items()], given.alias("_given")
    )


def inserted(batch: DataFrame, rule: UpsertRule, stamp: Column) -> DataFrame:
    """The batch as new rows, for partitions that hold nothing yet."""
    given = set(rule.replaced) | set(KEYS)
    absent = F.lit(None).cast("timestamp_ntz")
    columns = {
        field.name: F.col(field.name) if field.name in given else F.lit(None).cast(field.dataType)
        for field in SNAPSHOT_SCHEMA
    }
    columns["created_at"] = stamp
    columns["updated_at"] = stamp if rule.stamps_inserts else absent
    return batch.select(
        *[column.alias(name) for name, column in columns.items()], F.lit(True).alias("_given")
    )


def upsert(
    batch: DataFrame,
    path: str,
    run_dates: Sequence[dt.date],
    rule: UpsertRule,
    run_ts: dt.datetime,
    unique_keys: bool = False,
) -> dict[dt.date, int]:
    """Insert or update the batch by (run_date, customer_id); returns its row count per date.

    Only the partitions of ``run_dates`` are read and replaced, in one write job. Rows of those
    partitions that the batch does not hold are kept. A batch that holds a key twice fails and
    leaves the table as it was; ``unique_keys`` leaves the check out for plans that group by key.
    """
    spark = batch.sparkSession
    stamp = wall_clock(run_ts)
    customer_type = batch.schema["customer_id"].dataType
    batch = batch.withColumns(_checked_keys(run_dates, customer_type))
    if not unique_keys:
        batch = _distinct_keys(batch)
    folders = stored_folders(spark, path, run_dates)
    if folders:
        rows = merged(read_folders(spark, path, folders, customer_type), batch, rule, stamp)
    else:
        rows = inserted(batch, rule, stamp)

    if len(run_dates) > 1:
        # Gather each date's rows, splitting large dates; else every task writes every date.
        rows = rows.hint("rebalance", F.col("run_date"))
    rows, written = _counting(rows, run_dates)
    (
        rows.drop("_given")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_date")
        .parquet(path)
    )
    return _counts(written, run_dates)


def _counting(rows: DataFrame, run_dates: Sequence[dt.date]) -> tuple[DataFrame, Observation]:
    """Count batch rows in the writing stage itself, where each finished task counts once."""
    written = Observation()
    # With a bin for every date the histogram is an exact count per date.
    per_date = F.histogram_numeric(
        F.when(F.col("_given"), F.unix_date("run_date")), F.lit(max(len(run_dates), 2))
    )
    return rows.observe(written, per_date.alias("records")), written


def _counts(written: Observation, run_dates: Sequence[dt.date]) -> dict[dt.date, int]:
    counted: dict[int, int] = {}
    # Tasks bring bins of their own for the same date.
    for row in written.get["records"] or ():
        counted[row["x"]] = counted.get(row["x"], 0) + int(row["y"])
    epoch = dt.date(1970, 1, 1)
    return {day: counted.get((day - epoch).days, 0) for day in run_dates}


def bucketed_rows(
    batch: DataFrame,
    table: BucketedSnapshot,
    run_dates: Sequence[dt.date],
    rule: UpsertRule,
    stamp: Column,
) -> DataFrame:
    """All rows of these dates after the upsert, dealt by bucket; stored rows are not moved."""
    customer_type = batch.schema["customer_id"].dataType
    checked = table.dealt(batch.withColumns(_checked_keys(run_dates, customer_type)))
    # Its window, too, finds the rows of a customer in one task.
    batch, stored = _distinct_keys(checked), table.stored(run_dates)
    if stored is None:
        return inserted(batch, rule, stamp)
    return merged(stored, batch, rule, stamp, by_customer=True)


def upsert_bucketed(
    batch: DataFrame,
    table: BucketedSnapshot,
    run_dates: Sequence[dt.date],
    rule: UpsertRule,
    run_ts: dt.datetime,
) -> dict[dt.date, int]:
    """``upsert`` into a table in buckets, for tables that are much larger than a batch."""
    rows = bucketed_rows(batch, table, run_dates, rule, wall_clock(run_ts))
    rows, written = _counting(rows, run_dates)
    table.replace(rows)
    return _counts(written, run_dates)


def upsert_files(
    batch: DataFrame,
    table: VersionedSnapshot,
    run_dates: Sequence[dt.date],
    rule: UpsertRule,
    run_ts: dt.datetime,
) -> dict[dt.date, int]:
    """``upsert`` into a table in versions: only files that hold a key of the batch are rewritten,
    together with the new rows, and all dates take effect at once."""
    version = table.current()
    with Scratch(batch.sparkSession) as scratch:
        customer_type = batch.schema["customer_id"].dataType
        checked = _distinct_keys(batch.withColumns(_checked_keys(run_dates, customer_type)))
        staged = scratch.stage(checked, "batch")
        # A row per date.
        counted = staged.groupBy("run_date").agg(F.count("*").alias("n")).collect()
        counts = {day: 0 for day in run_dates} | {row.run_date: row.n for row in counted}
        if not counted:
            return counts
        touched = table.touched(version, staged)
        stored = table.read_files(touched)
        rows = merged(stored, staged, rule, wall_clock(run_ts)).drop("_given")
        n_rows = sum(counts.values()) + table.n_rows(version, touched)
        table.publish(version, table.write(rows, n_rows, version, touched))
    return counts
