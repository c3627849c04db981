"""Upsert semantics of the snapshot table."""

import datetime as dt
import uuid
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiercast.config import DISTRIBUTED, WINDOW, DailyConfig
from tiercast.operators.scratch import Scratch, hadoop_path, shared_root
from tiercast.operators.upsert import (
    CORE,
    DETAILED,
    _distinct_keys,
    merged,
    upsert,
    with_logs,
)
from tiercast.plans.backfill import rfm_backfill
from tiercast.plans.daily import rfm_daily, rfm_daily_detailed
from tiercast.plans.job import run, run_backfill
from tiercast.plans.registry import ORDERS, ORDERS_DAY
from tiercast.sources.orders import read_orders
from tiercast.sources.snapshot import (
    SNAPSHOT_SCHEMA,
    read_folders,
    read_snapshot,
    stored_folders,
)

DAY, NEXT_DAY = dt.date(2024, 1, 10), dt.date(2024, 1, 11)
MORNING, NOON, EVENING = (dt.datetime(2024, 1, 10, hour) for hour in (6, 12, 18))
LOGS = '{"source":"daily_rfm_pipeline"}'


@pytest.fixture
def target(spark):
    return f"{Scratch(spark).path}/{uuid.uuid4().hex}"


def core_batch(spark, customers, money, day=DAY):
    rows = [(day, c, 3, 2, money, 1, 2, 3, 6, "At Risk") for c in customers]
    return spark.createDataFrame(rows, T.StructType(SNAPSHOT_SCHEMA.fields[:10]))


def detailed_batch(spark, customers, money, comment):
    return with_logs(core_batch(spark, customers, money).withColumn("comments", F.lit(comment)))


def stored(spark, target, *columns):
    return {
        (row.run_date, row.customer_id): tuple(row[c] for c in columns)
        for row in read_snapshot(spark, target).collect()
    }


def test_nothing_written_yet(spark, target):
    table = read_snapshot(spark, target)
    assert table.schema.names == SNAPSHOT_SCHEMA.names
    assert table.isEmpty()


def test_core_keeps_updates_and_inserts(spark, target):
    assert upsert(core_batch(spark, [1, 2], 10.0), target, [DAY], CORE, MORNING) == {DAY: 2}
    assert upsert(core_batch(spark, [2, 3], None), target, [DAY], CORE, NOON) == {DAY: 2}
    assert stored(spark, target, "monetary_value", "created_at", "updated_at", "logs") == {
        (DAY, 1): (10.0, MORNING, None, None),
        # A missing value in the batch replaces the stored one.
        (DAY, 2): (None, MORNING, NOON, None),
        (DAY, 3): (None, NOON, None, None),
    }


def test_detailed_stamps_inserts_and_keeps_creation(spark, target):
    upsert(detailed_batch(spark, [1, 2], 10.0, "a"), target, [DAY], DETAILED, MORNING)
    upsert(detailed_batch(spark, [2, 3], 20.0, "b"), target, [DAY], DETAILED, NOON)
    assert stored(spark, target, "comments", "created_at", "updated_at", "logs") == {
        (DAY, 1): ("a", MORNING, MORNING, LOGS),
        (DAY, 2): ("b", MORNING, NOON, LOGS),
        (DAY, 3): ("b", NOON, NOON, LOGS),
    }


def test_core_leaves_detailed_columns_alone(spark, target):
    upsert(detailed_batch(spark, [1], 10.0, "a"), target, [DAY], DETAILED, MORNING)
    upsert(core_batch(spark, [1], 30.0), target, [DAY], CORE, NOON)
    assert stored(spark, target, "monetary_value", "comments", "updated_at", "logs") == {
        (DAY, 1): (30.0, "a", NOON, LOGS)
    }


def test_other_dates_are_not_touched(spark, target):
    upsert(core_batch(spark, [1], 10.0), target, [DAY], CORE, MORNING)
    before = sorted(
        row[0]
        for row in read_snapshot(spark, target).select(F.input_file_name()).distinct().collect()
    )
    upsert(core_batch(spark, [1], 20.0, NEXT_DAY), target, [NEXT_DAY], CORE, NOON)
    kept = read_snapshot(spark, target).where(F.col("run_date") == F.lit(DAY))
    after = sorted(row[0] for row in kept.select(F.input_file_name()).distinct().collect())
    assert before == after
    assert len(stored(spark, target)) == 2


def test_only_the_dates_asked_for_are_listed(spark, target):
    for day in (DAY, NEXT_DAY):
        upsert(core_batch(spark, [1, 2], 10.0, day), target, [day], CORE, MORNING)
    folders = stored_folders(spark, target, [DAY, DAY + dt.timedelta(days=9)])
    one = read_folders(spark, target, folders, T.LongType())
    assert {row.run_date for row in one.collect()} == {DAY}
    assert all("run_date=2024-01-10" in name for name in one.inputFiles())
    assert stored_folders(spark, target, [DAY + dt.timedelta(days=9)]) == []
    assert read_folders(spark, target, [], T.LongType()).isEmpty()


def test_same_batch_twice_changes_only_the_stamp(spark, target, check_dir):
    orders = read_orders(spark, f"{check_dir}/orders.parquet", ORDERS)
    batch = rfm_daily(orders, ORDERS_DAY)
    upsert(batch, target, [ORDERS_DAY.run_date], CORE, MORNING)
    first = read_snapshot(spark, target).drop("updated_at").collect()
    upsert(batch, target, [ORDERS_DAY.run_date], CORE, NOON)
    second = read_snapshot(spark, target)
    assert sorted(map(repr, second.drop("updated_at").collect())) == sorted(map(repr, first))
    assert [row[0] for row in second.select("updated_at").distinct().collect()] == [NOON]


def test_windows_of_orders(spark, target, check_dir):
    orders = read_orders(spark, f"{check_dir}/orders.parquet", ORDERS)
    for years, run_ts in (((1996, 1998), MORNING), ((1999, 2001), NOON)):
        first, end = (F.lit(f"{year}-01-01").cast("timestamp_ntz") for year in years)
        part = orders.where((F.col("created_at") >= first) & (F.col("created_at") < end))
        upsert(rfm_daily(part, ORDERS_DAY), target, [ORDERS_DAY.run_date], CORE, run_ts)
    states = stored(spark, target, "created_at", "updated_at").values()
    assert sum(state == (MORNING, None) for state in states) == 165
    assert sum(state == (MORNING, NOON) for state in states) == 1129
    assert sum(state == (NOON, None) for state in states) == 173


def test_many_dates_at_once(spark, target, check_dir):
    orders = read_orders(spark, f"{check_dir}/orders.parquet", ORDERS)
    days = [dt.date(2001, 7, 30) + dt.timedelta(days=i) for i in range(4)]
    batch = rfm_backfill(orders, days[0], days[-1], ORDERS_DAY)
    for run_ts in (MORNING, NOON):
        records = upsert(batch, target, days, CORE, run_ts)
        assert list(records) == days
        assert sum(records.values()) == batch.count()
    written = read_snapshot(spark, target).select(batch.columns)
    assert written.exceptAll(batch).isEmpty()
    assert written.count() == batch.count()


def test_backfill_counts_what_it_wrote(spark, target, check_dir):
    orders = read_orders(spark, f"{check_dir}/orders.parquet", ORDERS)
    early = orders.where("customer_id < 100")
    days = (dt.date(2001, 7, 30), dt.date(2001, 8, 2))
    for source, run_ts in ((orders, MORNING), (early, NOON)):
        config = DailyConfig(run_ts=run_ts, excluded_status="P")
        expected = rfm_backfill(source, *days, config).groupBy("run_date").count()
        summary = run_backfill(source, target, *days, config)
        assert sorted(map(tuple, summary.collect())) == sorted(map(tuple, expected.collect()))
    kept = read_snapshot(spark, target).where(F.col("updated_at").isNull())
    assert kept.where("customer_id >= 100").count() == kept.count() > 0


def test_backfill_describes_each_date(spark, target, check_dir):
    orders = read_orders(spark, f"{check_dir}/orders.parquet", ORDERS)
    first, last = dt.date(2001, 7, 31), ORDERS_DAY.run_date
    run_backfill(orders, f"{target}/t", first, last, ORDERS_DAY, statistics_path=f"{target}/s")
    run(orders, f"{target}/t", ORDERS_DAY, statistics_path=f"{target}/one")
    for name in ("metric_regression", "metric_histogram", "metric_density", "metric_significance"):
        every = spark.read.parquet(f"{target}/s/{name}")
        days = {row.run_date for row in every.select("run_date").distinct().collect()}
        assert days == {first, dt.date(2001, 8, 1), last}
        one = spark.read.parquet(f"{target}/one/{name}")
        same = every.where(F.col("run_date") == F.lit(last)).drop("run_date")
        assert same.columns == one.columns and same.count() == one.count()


def test_records_of_several_writing_tasks_add_up(spark, target):
    batch = core_batch(spark, range(300), 1.0).repartition(7)
    days = [DAY, NEXT_DAY]
    assert upsert(batch, target, [DAY], CORE, MORNING, unique_keys=True) == {DAY: 300}
    both = batch.unionAll(core_batch(spark, range(50), 1.0, NEXT_DAY)).repartition(5)
    assert upsert(both, f"{target}-2", days, CORE, NOON, unique_keys=True) == {DAY: 300, NEXT_DAY: 50}


def test_summaries_stay_readable_and_name_every_date(spark, target, check_dir):
    orders = read_orders(spark, f"{check_dir}/orders.parquet", ORDERS)
    days = (dt.date(1994, 12, 30), dt.date(1995, 1, 2))
    config = DailyConfig(run_ts=MORNING, excluded_status="P")
    summaries = [run_backfill(orders, target, *days, config, detailed=True) for _ in range(2)]
    first, second = (sorted(map(tuple, summary.collect())) for summary in summaries)
    assert first == second
    assert [n for _, n in first][:2] == [0, 0] and first[3][1] > 0
    assert read_snapshot(spark, target).where("logs is null or comments is null").isEmpty()


def test_text_customers(spark, target):
    schema = T.StructType(
        [T.StructField("run_date", T.DateType()), T.StructField("customer_id", T.StringType())]
        + SNAPSHOT_SCHEMA.fields[2:10]
    )
    for ids, run_ts in ((["a", "b"], MORNING), (["b", "c"], NOON)):
        rows = [(DAY, i, 3, 2, 1.0, 1, 2, 3, 6, "At Risk") for i in ids]
        upsert(spark.createDataFrame(rows, schema), target, [DAY], CORE, run_ts)
    table = read_snapshot(spark, target, T.StringType())
    assert {(row.customer_id, row.updated_at) for row in table.collect()} == {
        ("a", None), ("b", NOON), ("c", None),
    }


def test_a_key_given_twice_is_refused(spark, target):
    twice = core_batch(spark, [1, 2], 1.0).unionAll(core_batch(spark, [2], 2.0))
    with pytest.raises(PySparkException, match="occurs twice"):
        upsert(twice, target, [DAY], CORE, MORNING)
    assert read_snapshot(spark, target).isEmpty()
    upsert(core_batch(spark, [1, 2], 10.0), target, [DAY], CORE, MORNING)
    with pytest.raises(PySparkException, match="occurs twice"):
        upsert(twice, target, [DAY], CORE, NOON)
    assert stored(spark, target, "monetary_value") == {(DAY, 1): (10.0,), (DAY, 2): (10.0,)}


def test_the_check_of_keys_adds_no_exchange(spark, target):
    upsert(core_batch(spark, [1, 2], 10.0), target, [DAY], CORE, MORNING)
    batch = core_batch(spark, [2, 3], 10.0)
    existing = read_snapshot(spark, target)
    stamp = F.lit(None).cast("timestamp_ntz")

    def exchanges(rows):
        plan = merged(existing, rows, CORE, stamp)._jdf.queryExecution().executedPlan().toString()
        return plan.count("Exchange hashpartitioning")

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert exchanges(_distinct_keys(batch)) == exchanges(batch) == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_missing_customer_is_refused(spark, target):
    with pytest.raises(PySparkException, match="customer_id must not be NULL"):
        upsert(core_batch(spark, [None], 1.0), target, [DAY], CORE, MORNING)


def test_foreign_date_is_refused(spark, target):
    with pytest.raises(PySparkException, match="not among the dates"):
        upsert(core_batch(spark, [1], 1.0, NEXT_DAY), target, [DAY], CORE, MORNING)


def test_failed_upsert_leaves_the_table_as_it_was(spark, target):
    upsert(core_batch(spark, [1, 2], 10.0), target, [DAY], CORE, MORNING)
    with pytest.raises(PySparkException):
        upsert(core_batch(spark, [3, None], 1.0), target, [DAY], CORE, NOON)
    assert set(stored(spark, target)) == {(DAY, 1), (DAY, 2)}


@pytest.mark.parametrize("detailed", [False, True])
def test_run_reports_and_describes(spark, target, small_dir, detailed):
    orders = read_orders(spark, f"{small_dir}/orders.parquet", ORDERS)
    config = DailyConfig(ORDERS_DAY.run_date, EVENING, "P", strategy=DISTRIBUTED)
    folder = f"{target}-statistics"
    summary = run(orders, target, config, detailed, folder).collect()
    assert [tuple(row) for row in summary] == [(ORDERS_DAY.run_date, 150)]
    daily = rfm_daily_detailed if detailed else rfm_daily
    batch = daily(orders, ORDERS_DAY)
    assert read_snapshot(spark, target).select(batch.columns).exceptAll(batch).isEmpty()
    assert spark.read.parquet(f"{folder}/metric_correlation").count() == 3
    assert spark.read.parquet(f"{folder}/metric_density").count() == 300


def folders_in(spark):
    root, files = hadoop_path(spark, shared_root(spark))
    return {entry.getPath().getName() for entry in files.listStatus(root)}


def test_runs_leave_no_staged_tables(spark, target, small_dir):
    orders = read_orders(spark, f"{small_dir}/orders.parquet", ORDERS)
    config = DailyConfig(ORDERS_DAY.run_date, EVENING, "P", strategy=DISTRIBUTED)
    before = folders_in(spark)
    run(orders, target, config, statistics_path=f"{target}-statistics")
    run_backfill(orders, target, dt.date(2001, 8, 1), ORDERS_DAY.run_date, config)
    assert folders_in(spark) == before


def test_one_order_per_customer_does_not_stop_the_run(spark, target):
    rows = [(i, i, dt.datetime(2024, 1, i), Decimal(i), "done") for i in range(1, 10)]
    orders = spark.createDataFrame(
        rows, "customer_id long, order_id long, created_at timestamp_ntz, total decimal(18,2), status string"
    )
    folder = f"{target}-statistics"
    run(orders, target, DailyConfig(DAY, EVENING), statistics_path=folder)
    assert read_snapshot(spark, target).count() == 9
    correlation = spark.read.parquet(f"{folder}/metric_correlation").collect()
    assert len(correlation) == 3
    for row in correlation:
        constant = "frequency_orders" in (row.x, row.y)
        assert (row.r is None, row.label is None) == (constant, constant)
    for name in ("significance", "regression", "histogram", "density"):
        assert spark.read.parquet(f"{folder}/metric_{name}").count() > 0


@pytest.mark.parametrize("strategy", [WINDOW, DISTRIBUTED])
def test_run_without_orders(spark, target, small_dir, strategy):
    orders = read_orders(spark, f"{small_dir}/orders.parquet", ORDERS)
    nothing = orders.where("customer_id < 0")
    config = DailyConfig(ORDERS_DAY.run_date, EVENING, "P", strategy=strategy)
    found = [run(source, target, config).first().records for source in (nothing, orders, nothing)]
    assert found == [0, 150, 0]
    # Stored rows stay when a later run of the day finds nothing.
    assert read_snapshot(spark, target).count() == 150
