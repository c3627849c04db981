"""Metrics kept between runs, from orders that arrive in any order."""

import datetime as dt
import random
import uuid

import pytest
from compare import spark_rows
from pyspark.sql import functions as F
from test_daily import AWKWARD, ORDERS_SCHEMA

from tiercast.config import DailyConfig
from tiercast.operators.metrics import accepted_orders, customer_metrics, customer_metrics_as_of
from tiercast.operators.scratch import Scratch
from tiercast.plans.daily import rfm_daily
from tiercast.plans.job import run, run_incremental
from tiercast.plans.registry import ORDERS, ORDERS_DAY
from tiercast.sources.orders import read_orders
from tiercast.sources.pointer import Conflict, latest, publish
from tiercast.sources.snapshot import read_snapshot
from tiercast.sources.stored_metrics import StoredMetrics

CONFIG = DailyConfig(dt.date(2024, 1, 10), dt.datetime(2024, 1, 10, 2))


@pytest.fixture
def path(spark):
    return f"{Scratch(spark).path}/{uuid.uuid4().hex}"


def test_pointers_are_written_once(spark, path):
    assert latest(spark, path) == (-1, {})
    publish(spark, path, 0, {"a": 1})
    publish(spark, path, 1, {"a": "ü"})
    with pytest.raises(Conflict):
        publish(spark, path, 1, {"a": 3})
    assert latest(spark, path) == (1, {"a": "ü"})


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_arrival_gives_the_same_metrics(spark, path, seed):
    rng = random.Random(seed)
    orders = [(row, rng.randrange(4)) for row in AWKWARD * 2]
    rng.shuffle(orders)
    stored = StoredMetrics(spark, path, "cancelled")
    for batch in range(4):
        rows = [row for row, b in orders if b == batch]
        frame = spark.createDataFrame(rows, ORDERS_SCHEMA)
        assert stored.add(frame, batch)
        if rng.random() < 0.5:
            stored.add(frame, batch)
        if rng.random() < 0.5:
            stored.compact(dt.date(2024, 1, 3))
    whole = accepted_orders(spark.createDataFrame(AWKWARD * 2, ORDERS_SCHEMA), "cancelled")
    assert spark_rows(stored.metrics()) == spark_rows(customer_metrics(whole))
    assert stored.metrics().dtypes == customer_metrics(whole).dtypes
    days = dt.date(2024, 1, 3), dt.date(2024, 1, 11)
    assert spark_rows(stored.metrics_as_of(*days)) == spark_rows(customer_metrics_as_of(whole, *days))


def test_a_batch_that_the_base_holds_is_left_out(spark, path):
    frame = spark.createDataFrame(AWKWARD, ORDERS_SCHEMA)
    stored = StoredMetrics(spark, path, "cancelled")
    stored.add(frame, 0)
    before = spark_rows(stored.metrics())
    stored.compact()
    assert not stored.add(frame, 0)
    stored.clean()
    assert spark_rows(stored.metrics()) == before


def test_an_unfinished_batch_is_reported_and_can_be_repeated(spark, path):
    frame = spark.createDataFrame(AWKWARD, ORDERS_SCHEMA)
    stored = StoredMetrics(spark, path, "cancelled")
    stored.add(frame, 0)
    location = f"{path}/increments/batch-{1:012d}"
    frame.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(location)
    with pytest.raises(RuntimeError, match="batch 1 was not finished"):
        stored.metrics()
    stored.add(frame, 1)
    assert stored.metrics().agg(F.sum("frequency_orders")).first()[0] == 18


def test_what_cannot_be_answered_is_refused(spark, path):
    stored = StoredMetrics(spark, path, "cancelled")
    with pytest.raises(ValueError, match="no orders"):
        stored.metrics()
    stored.add(spark.createDataFrame(AWKWARD, ORDERS_SCHEMA), 0)
    stored.compact(dt.date(2024, 1, 5))
    with pytest.raises(ValueError, match="have been merged"):
        stored.metrics_as_of(dt.date(2024, 1, 4), dt.date(2024, 1, 6))
    with pytest.raises(ValueError, match="leaves out"):
        StoredMetrics(spark, path, "returned").metrics()


def test_a_run_reads_the_new_orders_alone(spark, path, check_dir):
    orders = read_orders(spark, f"{check_dir}/orders.parquet", ORDERS)
    split = F.lit("2001-01-01").cast("timestamp_ntz")
    for name, part in (("old", orders.where(F.col("created_at") < split)),
                       ("new", orders.where(F.col("created_at") >= split))):
        part.write.parquet(f"{path}/orders/{name}")
    old, new = (spark.read.parquet(f"{path}/orders/{name}") for name in ("old", "new"))
    config = DailyConfig(ORDERS_DAY.run_date, dt.datetime(2001, 8, 2, 2), excluded_status="P")
    run_incremental(old, 0, f"{path}/metrics", f"{path}/daily", config)
    found = run_incremental(new, 1, f"{path}/metrics", f"{path}/daily2", config)
    stored = StoredMetrics(spark, f"{path}/metrics", "P")
    assert not any("/orders/" in name for name in stored.metrics().inputFiles())
    assert spark_rows(found) == spark_rows(run(orders, f"{path}/whole", config))
    assert spark_rows(read_snapshot(spark, f"{path}/daily2")) == spark_rows(
        read_snapshot(spark, f"{path}/whole")
    )
    kept = read_snapshot(spark, f"{path}/daily2").drop("comments", "created_at", "updated_at", "logs")
    assert spark_rows(kept) == spark_rows(rfm_daily(orders, config))
