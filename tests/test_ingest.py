"""Orders as a stream of files, and late orders."""

import datetime as dt
import random
import uuid
from dataclasses import replace

import pytest
from compare import spark_rows
from pyspark.sql import functions as F
from test_daily import AWKWARD, ORDERS_SCHEMA

from tiercast.config import DailyConfig
from tiercast.operators.scratch import Scratch
from tiercast.plans import job
from tiercast.plans.backfill import first_affected, rfm_backfill
from tiercast.plans.daily import DAILY_COLUMNS, rfm_daily
from tiercast.plans.job import rerun_affected, run_backfill
from tiercast.sources.snapshot import read_snapshot
from tiercast.sources.stored_metrics import StoredMetrics
from tiercast.streaming import ingest
from tiercast.streaming.ingest import ingest_orders, read_order_stream

CONFIG = DailyConfig(dt.date(2024, 1, 10), dt.datetime(2024, 1, 10, 2))


@pytest.fixture
def path(spark):
    return f"{Scratch(spark).path}/{uuid.uuid4().hex}"


def arrive(spark, path, rows):
    spark.createDataFrame(rows, ORDERS_SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/in")


def ingest_all(spark, path):
    schema = spark.createDataFrame([], ORDERS_SCHEMA).schema
    stream = read_order_stream(spark, f"{path}/in", schema, options={"maxFilesPerTrigger": "1"})
    ingest_orders(stream, f"{path}/checkpoint", f"{path}/metrics", f"{path}/daily", CONFIG)


def scored(spark, path):
    return spark_rows(read_snapshot(spark, f"{path}/daily").select(*DAILY_COLUMNS))


def test_rows_equal_the_batch_run_after_a_crash_and_a_replay(spark, path, monkeypatch):
    rows = list(AWKWARD)
    random.Random(2).shuffle(rows)
    arrive(spark, path, rows[:5])
    ingest_all(spark, path)
    arrive(spark, path, rows[5:9])
    arrive(spark, path, rows[9:])

    plain, calls = job.run_incremental, []

    def crashing(batch, number, *arguments):
        calls.append(number)
        plain(batch, number, *arguments)
        if len(calls) == 2:
            # Both sinks have the batch, the stream's checkpoint does not.
            raise RuntimeError("lost")

    monkeypatch.setattr(ingest, "run_incremental", crashing)
    with pytest.raises(Exception, match="lost"):
        ingest_all(spark, path)
    ingest_all(spark, path)
    assert calls == [1, 2, 2]
    whole = spark.createDataFrame(AWKWARD, ORDERS_SCHEMA)
    assert scored(spark, path) == spark_rows(rfm_daily(whole, CONFIG))
    # Nothing new, nothing done.
    ingest_all(spark, path)
    assert calls == [1, 2, 2]


def test_first_affected_date(spark):
    first, last = dt.date(2024, 1, 5), dt.date(2024, 1, 9)

    def affected(*rows):
        return first_affected(spark.createDataFrame(rows, ORDERS_SCHEMA), CONFIG, first, last)

    by_number = {row[1]: row for row in AWKWARD}
    assert affected(by_number[60]) == dt.date(2024, 1, 8)
    assert affected(by_number[60], by_number[12]) == first
    assert affected(by_number[70]) == first  # without a date
    assert affected(by_number[30], by_number[40]) is None  # not accepted
    assert affected(by_number[80]) is None  # after the last date
    assert affected() is None


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_corrections_give_what_a_full_backfill_gives(spark, path, seed):
    rng = random.Random(seed)
    first, last = dt.date(2024, 1, 3), dt.date(2024, 1, 10)
    config = replace(CONFIG, run_date=last)
    late = rng.sample(AWKWARD, 2)
    corrected = rng.choice([row for row in AWKWARD if row not in late])
    became = (*corrected[:4], "cancelled" if corrected[4] == "delivered" else "delivered")
    before = [row for row in AWKWARD if row not in late]
    now = [row for row in AWKWARD if row != corrected] + [became]
    frames = [spark.createDataFrame(rows, ORDERS_SCHEMA) for rows in (before, now, [*late, corrected, became])]
    run_backfill(frames[0], f"{path}/daily", first, last, config)
    found = rerun_affected(frames[1], frames[2], f"{path}/daily", first, last, config)
    start = first_affected(frames[2], config, first, last)
    expected = 0 if start is None else (last - start).days + 1
    assert found.count() == expected
    # Customers whose only orders went stay in dates that were written before; none are here.
    full = rfm_backfill(frames[1], first, last, config)
    stored = read_snapshot(spark, f"{path}/daily").select(*DAILY_COLUMNS)
    keys = full.select("run_date", "customer_id")
    assert spark_rows(stored.join(keys, ["run_date", "customer_id"], "left_semi").select(*DAILY_COLUMNS)) == (
        spark_rows(full)
    )
    gone = {row.customer_id for row in stored.join(keys, ["run_date", "customer_id"], "left_anti").collect()}
    assert gone <= {corrected[0]}


def test_an_ingested_state_can_be_read_alone(spark, path):
    arrive(spark, path, AWKWARD)
    ingest_all(spark, path)
    stored = StoredMetrics(spark, f"{path}/metrics", "cancelled")
    assert stored.metrics().where(F.col("customer_id") == 1).first().frequency_orders == 2
