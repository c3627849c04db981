"""Upserts into the table in buckets and into the table in versions."""

import datetime as dt
import uuid

import pytest
from compare import spark_rows
from pyspark.sql import functions as F
from test_upsert import DAY, MORNING, NEXT_DAY, NOON, core_batch, detailed_batch

from tiercast.functions.timestamps import wall_clock
from tiercast.operators.scratch import Scratch, hadoop_path
from tiercast.operators.upsert import (
    CORE,
    DETAILED,
    bucketed_rows,
    upsert,
    upsert_bucketed,
    upsert_files,
)
from tiercast.sources.bucketed import BucketedSnapshot
from tiercast.sources.pointer import Conflict
from tiercast.sources.snapshot import read_snapshot
from tiercast.sources.versions import VersionedSnapshot


@pytest.fixture
def path(spark):
    return f"{Scratch(spark).path}/{uuid.uuid4().hex}"


def batches(spark):
    yield core_batch(spark, range(0, 200), 1.0), [DAY], CORE, MORNING
    two = core_batch(spark, range(100, 300), None).unionAll(core_batch(spark, [5, 6], 2.0, NEXT_DAY))
    yield two, [DAY, NEXT_DAY], CORE, NOON
    yield detailed_batch(spark, range(250, 260), 9.0, "x"), [DAY], DETAILED, NOON


@pytest.mark.parametrize("layout", ["buckets", "versions"])
def test_same_rows_as_the_plain_table(spark, path, layout):
    if layout == "buckets":
        table, write = BucketedSnapshot(spark, f"{path}/t", buckets=4), upsert_bucketed
    else:
        table, write = VersionedSnapshot(spark, f"{path}/t", rows_per_file=40), upsert_files
    for batch, *options in batches(spark):
        assert write(batch, table, *options) == upsert(batch, f"{path}/plain", *options)
        assert spark_rows(table.read()) == spark_rows(read_snapshot(spark, f"{path}/plain"))


@pytest.mark.parametrize("layout", ["buckets", "versions"])
def test_a_key_given_twice_leaves_the_table_as_it_was(spark, path, layout):
    if layout == "buckets":
        table, write = BucketedSnapshot(spark, path, buckets=4), upsert_bucketed
    else:
        table, write = VersionedSnapshot(spark, path), upsert_files
    write(core_batch(spark, [1, 2], 1.0), table, [DAY], CORE, MORNING)
    before = spark_rows(table.read())
    with pytest.raises(Exception, match="occurs twice"):
        write(core_batch(spark, [1, 3, 3], 5.0), table, [DAY], CORE, NOON)
    assert spark_rows(table.read()) == before


def exchanges_above_scan(plan):
    """Exchange nodes on the way from the root to the stored scan, by the plan's indentation."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "FileScan parquet" in line and "Bucketed: true" in line)

    def depth(line):
        return len(line) - len(line.lstrip(" :+-|"))

    level, found = depth(lines[at]), []
    for line in reversed(lines[:at]):
        if line.strip() and depth(line) < level:
            level = depth(line)
            found.append(line)
    return [line for line in found if "Exchange" in line]


@pytest.mark.parametrize("days", [[DAY], [DAY, NEXT_DAY]])
def test_stored_rows_are_not_moved(spark, path, days):
    table = BucketedSnapshot(spark, path, buckets=4)
    for day in days:
        upsert_bucketed(core_batch(spark, range(50), 1.0, day), table, [day], CORE, MORNING)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = bucketed_rows(core_batch(spark, range(9), 2.0), table, days, CORE, wall_clock(NOON))
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan
    assert exchanges_above_scan(plan) == []
    assert plan.count("Exchange hashpartitioning(customer_id") == 1


def test_one_sorted_file_per_bucket(spark, path):
    table = BucketedSnapshot(spark, path, buckets=4)
    for batch, *options in batches(spark):
        upsert_bucketed(batch, table, *options)
    _, files = hadoop_path(spark, table.data)
    folder, _ = hadoop_path(spark, f"{table.data}/run_date={DAY}")
    names = [e.getPath().getName() for e in files.listStatus(folder) if "part-" in e.getPath().getName()]
    assert len([n for n in names if n.endswith(".parquet")]) == 4
    # A later session finds the number of buckets stored.
    assert BucketedSnapshot(spark, path, buckets=99).buckets == 4


def listed(table):
    return {row.file: row for row in table.files(table.current()).collect()}


def test_only_files_that_hold_the_keys_are_rewritten(spark, path):
    table = VersionedSnapshot(spark, path, rows_per_file=100)
    upsert_files(core_batch(spark, range(0, 4000, 2), 1.0), table, [DAY], CORE, MORNING)
    upsert_files(core_batch(spark, range(0, 400, 2), 1.0, NEXT_DAY), table, [NEXT_DAY], CORE, MORNING)
    before = listed(table)
    assert len(before) > 15
    batch = core_batch(spark, range(1000, 1020, 2), 7.0)
    holders = {
        f for f, row in before.items() if row.first_date == DAY and row.low <= 1018 and row.high >= 1000
    }
    assert set(table.touched(table.current(), batch)) == holders
    upsert_files(batch, table, [DAY], CORE, NOON)
    after = listed(table)
    assert set(before) - set(after) == holders and len(holders) <= 2
    assert {f: after[f] for f in set(before) & set(after)} == {
        f: row for f, row in before.items() if f not in holders
    }
    assert table.read([DAY]).where("monetary_value = 7.0").count() == 10
    assert table.read([DAY]).count() == 2000 and table.read([NEXT_DAY]).count() == 200
    # Keys between those of a file, which no file holds, go to a file of their own.
    kept = set(listed(table))
    upsert_files(core_batch(spark, [2001, 2003], 8.0), table, [DAY], CORE, NOON)
    assert kept < set(listed(table)) and table.read([DAY]).count() == 2002


def test_a_run_that_ends_before_publishing_leaves_the_version_before(spark, path, monkeypatch):
    table = VersionedSnapshot(spark, path, rows_per_file=20)
    first = core_batch(spark, range(60), 1.0).unionAll(core_batch(spark, range(60), 1.0, NEXT_DAY))
    upsert_files(first, table, [DAY, NEXT_DAY], CORE, MORNING)
    before, number = spark_rows(table.read()), table.current().number
    monkeypatch.setattr(table, "publish", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt()))
    second = core_batch(spark, range(90), 2.0).unionAll(core_batch(spark, range(90), 2.0, NEXT_DAY))
    with pytest.raises(KeyboardInterrupt):
        upsert_files(second, table, [DAY, NEXT_DAY], CORE, NOON)
    fresh = VersionedSnapshot(spark, path, rows_per_file=20)
    assert fresh.current().number == number and spark_rows(fresh.read()) == before
    # A repeat succeeds, and what was left behind can be removed.
    upsert_files(second, fresh, [DAY, NEXT_DAY], CORE, NOON)
    after = spark_rows(fresh.read())
    fresh.clean()
    assert spark_rows(fresh.read()) == after and len(after) == 180


def test_of_two_writers_the_second_fails(spark, path, monkeypatch):
    table = VersionedSnapshot(spark, path)
    upsert_files(core_batch(spark, [1], 1.0), table, [DAY], CORE, MORNING)
    late, plain = VersionedSnapshot(spark, path), VersionedSnapshot.write

    def overtaken(self, *arguments):
        manifest = plain(self, *arguments)
        monkeypatch.setattr(VersionedSnapshot, "write", plain)
        upsert_files(core_batch(spark, [2], 2.0), table, [DAY], CORE, NOON)
        return manifest

    monkeypatch.setattr(VersionedSnapshot, "write", overtaken)
    with pytest.raises(Conflict):
        upsert_files(core_batch(spark, [3], 3.0), late, [DAY], CORE, NOON)
    rows = table.read().select("customer_id").collect()
    assert sorted(row.customer_id for row in rows) == [1, 2]


def test_an_empty_batch_and_an_empty_table(spark, path):
    table = VersionedSnapshot(spark, path)
    assert table.read().isEmpty() and table.read([DAY]).isEmpty()
    nothing = core_batch(spark, [1], 1.0).where(F.lit(False))
    assert upsert_files(nothing, table, [DAY], CORE, MORNING) == {DAY: 0}
    assert table.current().number == -1
    assert upsert_files(core_batch(spark, [1], 1.0), table, [DAY, DAY + dt.timedelta(1)], CORE, MORNING) == {
        DAY: 1, NEXT_DAY: 0
    }
