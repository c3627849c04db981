"""Rank selection against sorting, on orders built to be hard to narrow."""

import datetime as dt
import random
import time
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tiercast.operators import quintiles
from tiercast.operators.quintiles import BUCKETS, bucket_ends
from tiercast.operators.ranked_keys import keys_at_ranks

LEVELS = ("nulls", "major", "minor", "known", "id")
DAY = dt.date(2024, 1, 1)
ENTRIES = f"day int, metric int, {', '.join(f'{level} bigint' for level in LEVELS)}"
BASE = (
    "run_date date, customer_id bigint, recency_days int, frequency_orders bigint, "
    "monetary_value decimal(28,2)"
)


def check(spark, groups, sort_rows):
    """``groups`` maps (day, metric) to its keys."""
    rows = [(*group, *key) for group, keys in groups.items() for key in keys]
    random.Random(1).shuffle(rows)
    entries = spark.createDataFrame(rows, ENTRIES)
    found, totals = keys_at_ranks(entries, bucket_ends, sort_rows, LEVELS)
    assert totals == {group: len(keys) for group, keys in groups.items()}
    at = {((k.day, k.metric), k.rank): k.key for k in found}
    for group, keys in groups.items():
        ordered = sorted(keys)
        for end in bucket_ends(len(keys)):
            assert at[group, end] == ordered[end - 1]


def one_value(n):
    return [(0, 0, 7, 1, i) for i in range(n)]


def one_huge_value(n):
    return [(0, 0, i % 5, 1, i) for i in range(n)] + [(0, 0, 10**18, 1, n)]


def missing_values(n):
    return [(i % 2, 0, 0 if i % 2 else i * i, 1, i) for i in range(n)]


def extreme_ids(n):
    ids = [-(2**63), 2**63 - 1, 0, -1, 1, *range(2**62, 2**62 + n)]
    return [(0, 0, 3, 1, i) for i in ids] + [(0, 0, 3, 0, 0)]


def both_parts(n):
    return [(0, i % 3 - 1, (i * 7919) % 10**12 * (i % 3 - 1), 1, i) for i in range(n)]


@pytest.mark.parametrize("sort_rows", [0, 10, 10**6])
@pytest.mark.parametrize(
    "shape", [one_value, one_huge_value, missing_values, extreme_ids, both_parts]
)
def test_hard_orders(spark, shape, sort_rows):
    check(spark, {(0, 0): shape(3000)}, sort_rows)


@pytest.mark.parametrize("n", range(1, 12))
def test_few_rows(spark, n):
    check(spark, {(0, 0): one_value(n), (0, 1): missing_values(n)}, 0)


def test_many_groups(spark):
    groups = {
        (day, metric): one_huge_value(20 + day) for day in range(30) for metric in (0, 1)
    }
    check(spark, groups, 0)


amounts = st.one_of(
    st.none(),
    st.integers(-3, 3),
    st.integers(-(10**26) + 1, 10**26 - 1),
    st.integers(-(10**11), 10**11),
).map(lambda units: None if units is None else Decimal(units) + Decimal("0.37"))
customers = st.lists(
    st.tuples(
        st.one_of(st.none(), st.integers(-(2**63), 2**63 - 1)),
        st.one_of(st.none(), st.integers(-5, 5), st.integers(-(2**31) + 1, 2**31 - 1)),
        st.one_of(st.integers(0, 3), st.integers(0, 2**63 - 1)),
        amounts,
    ),
    max_size=60,
    unique_by=lambda row: row[0],
)


@settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(customers, st.sampled_from([0, 5, 10**6]))
def test_scores_equal_ntile(spark, rows, sort_rows):
    base = spark.createDataFrame([(DAY, *row) for row in rows], BASE)
    by_window = quintiles.add_scores(base, "window").collect()
    by_cuts = quintiles.add_scores(base, "distributed", sort_rows=sort_rows).collect()
    assert sorted(map(repr, by_window)) == sorted(map(repr, by_cuts))


names = st.text(alphabet="ab\0é", max_size=9)


@settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(st.tuples(st.one_of(st.none(), names), st.integers(0, 1)), max_size=40, unique_by=lambda r: r[0]),
    st.sampled_from([3, 10**6]),
)
def test_scores_of_text_customers_equal_ntile(spark, rows, sort_rows):
    schema = BASE.replace("customer_id bigint", "customer_id string")
    base = spark.createDataFrame([(DAY, who, 1, n, Decimal(n)) for who, n in rows], schema)
    by_window = quintiles.add_scores(base, "window").collect()
    by_cuts = quintiles.add_scores(base, "distributed", sort_rows=sort_rows).collect()
    assert sorted(map(repr, by_window)) == sorted(map(repr, by_cuts))


@pytest.mark.parametrize("sort_rows", [2, 10**6])
def test_long_text_ids_among_short_ones(spark, sort_rows):
    """One id of 100 KB, ids that agree for long, and ids that end within what others share."""
    ids = [f"c{i}" for i in range(40)] + ["c1" * 50_000, "c1" * 50_000 + "x"]
    ids += ["z" * 63 + tail for tail in ("", "\0", "a", "b", "ba", "é", "a\0")] + ["z" * n for n in range(15, 70)]
    schema = BASE.replace("customer_id bigint", "customer_id string")
    rows = [(DAY, who, 1, i % 2, Decimal(1)) for i, who in enumerate(dict.fromkeys(ids))]
    base = spark.createDataFrame(rows, schema)
    started = time.monotonic()
    by_cuts = quintiles.add_scores(base, "distributed", sort_rows=sort_rows).collect()
    assert time.monotonic() - started < 60
    by_window = quintiles.add_scores(base, "window").collect()
    assert sorted(map(repr, by_window)) == sorted(map(repr, by_cuts))


def test_a_third_of_all_customers_tied(spark):
    n = 200_000
    base = spark.range(n).select(
        F.lit(DAY).alias("run_date"),
        F.col("id").alias("customer_id"),
        (F.col("id") % 900).cast("int").alias("recency_days"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50).alias("frequency_orders"),
        F.when(F.col("id") == 5, Decimal(10**20))
        .otherwise(F.pmod(F.xxhash64("id"), F.lit(10**6)) / 100)
        .cast("decimal(28,2)")
        .alias("monetary_value"),
    )
    by_window = quintiles.add_scores(base, "window")
    by_cuts = quintiles.add_scores(base, "distributed", sort_rows=100)
    assert by_window.exceptAll(by_cuts).isEmpty()
    assert by_cuts.count() == n


def test_bucket_ends():
    assert BUCKETS == 5
    assert bucket_ends(11) == [3, 5, 7, 9]
    assert bucket_ends(3) == [1, 2, 3, 3]
