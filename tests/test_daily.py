"""The daily plan on a hand-made table with every awkward order, and on the test tables."""

import datetime as dt
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tiercast.config import CALENDAR, DISTRIBUTED, ELAPSED, WINDOW, DailyConfig
from tiercast.operators.quintiles import add_scores
from tiercast.plans.backfill import rfm_backfill
from tiercast.plans.daily import rfm_base, rfm_daily, rfm_daily_detailed
from tiercast.plans.registry import ORDERS, ORDERS_DAY
from tiercast.sources.orders import as_orders, read_orders

RUN_DATE = dt.date(2024, 1, 10)
ORDERS_SCHEMA = (
    "customer_id bigint, order_id bigint, created_at timestamp_ntz, total decimal(18,2), status string"
)


def order(customer, number, status, moment, total):
    when = dt.datetime.fromisoformat(moment) if moment else None
    return (customer, number, when, Decimal(total) if total else None, status)


AWKWARD = [
    order(1, 10, "delivered", "2024-01-09 23:30:00", "100.10"),
    order(1, 11, "cancelled", "2024-01-10 08:00:00", "999.00"),
    order(1, 12, "shipped", "2024-01-02 00:00:00", "50.05"),
    order(2, 20, "delivered", "2024-01-10 06:00:00", "20.00"),
    order(3, 30, "cancelled", "2024-01-05 00:00:00", "75.00"),
    order(4, 40, None, "2024-01-05 00:00:00", "75.00"),
    order(5, 50, "delivered", "2023-12-01 12:00:00", None),
    order(6, 60, "Cancelled", "2024-01-08 00:00:00", "20.00"),
    order(7, 70, "delivered", None, "500.00"),
    order(7, None, "delivered", "2023-11-01 01:00:00", "1.00"),
    order(8, 80, "delivered", "2024-01-12 10:00:00", "300.00"),
    order(8, 81, "delivered", "2024-01-01 00:00:00", "0.01"),
    order(9, 90, "delivered", None, "5.00"),
]

# customer: recency calendar, recency elapsed, frequency, money, r, f, m
EXPECTED = {
    1: (1, 0, 2, 150.15, 3, 4, 2),
    2: (0, 0, 1, 20.0, 4, 1, 1),
    5: (40, 39, 1, None, 2, 1, 5),
    6: (2, 2, 1, 20.0, 2, 2, 2),
    7: (70, 69, 1, 501.0, 1, 2, 4),
    8: (-2, -2, 2, 300.01, 5, 5, 3),
    9: (None, None, 1, 5.0, 1, 3, 1),
}


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, ORDERS_SCHEMA)


@pytest.fixture(scope="module")
def check_orders(spark, check_dir):
    return read_orders(spark, f"{check_dir}/orders.parquet", ORDERS)


@pytest.mark.parametrize("strategy", [WINDOW, DISTRIBUTED])
def test_awkward_orders(awkward, strategy):
    result = rfm_daily(awkward, DailyConfig(RUN_DATE, strategy=strategy)).collect()
    found = {
        row.customer_id: (
            row.recency_days,
            row.frequency_orders,
            row.monetary_value,
            row.r_score,
            row.f_score,
            row.m_score,
        )
        for row in result
    }
    assert found == {key: (row[0], *row[2:]) for key, row in EXPECTED.items()}


def test_elapsed_days(awkward):
    base = rfm_base(awkward, DailyConfig(RUN_DATE, recency_mode=ELAPSED)).collect()
    assert {row.customer_id: row.recency_days for row in base} == {
        key: row[1] for key, row in EXPECTED.items()
    }


@pytest.mark.parametrize(
    ("setting", "value"),
    [
        ("spark.sql.session.timeZone", "America/New_York"),
        ("spark.sql.session.timeZone", "Asia/Tokyo"),
        ("spark.sql.ansi.enabled", "false"),
    ],
)
def test_session_settings_do_not_matter(spark, awkward, setting, value):
    config = DailyConfig(RUN_DATE, strategy=DISTRIBUTED)
    days = (dt.date(2024, 1, 8), dt.date(2024, 1, 12))

    def results():
        frames = (
            rfm_daily(awkward, config),
            rfm_daily_detailed(awkward, config),
            rfm_backfill(awkward, *days, config),
        )
        return [sorted(map(repr, frame.collect())) for frame in frames]

    expected, before = results(), spark.conf.get(setting)
    spark.conf.set(setting, value)
    try:
        assert results() == expected
    finally:
        spark.conf.set(setting, before)


def test_each_variant_has_its_recency(awkward):
    config = DailyConfig(RUN_DATE)
    core = {row.customer_id: row.recency_days for row in rfm_daily(awkward, config).collect()}
    rows = rfm_daily_detailed(awkward, config).collect()
    assert (core[1], {row.customer_id: row.recency_days for row in rows}[1]) == (1, 0)
    forced = rfm_daily_detailed(awkward, replace(config, recency_mode=CALENDAR)).collect()
    assert {row.customer_id: row.recency_days for row in forced}[1] == 1


def test_detailed_rows_come_in_customer_order(check_orders):
    ids = [row.customer_id for row in rfm_daily_detailed(check_orders, ORDERS_DAY).collect()]
    assert ids == sorted(ids)


def test_missing_customer_forms_one_group(spark):
    rows = [order(None, n, "done", "2024-01-01 00:00:00", "1.00") for n in (1, 2)]
    rows += [order(5, 3, "done", "2024-01-01 00:00:00", "1.00")]
    orders = spark.createDataFrame(rows, ORDERS_SCHEMA)
    for strategy in (WINDOW, DISTRIBUTED):
        result = rfm_daily(orders, DailyConfig(RUN_DATE, strategy=strategy)).collect()
        assert {(r.customer_id, r.frequency_orders, r.r_score, r.f_score) for r in result} == {
            (None, 2, 1, 2),
            (5, 1, 2, 1),
        }


@pytest.mark.parametrize("strategy", [WINDOW, DISTRIBUTED])
def test_no_orders(spark, strategy):
    nothing = spark.createDataFrame([], ORDERS_SCHEMA)
    assert rfm_daily(nothing, DailyConfig(RUN_DATE, strategy=strategy)).collect() == []


GOLDEN = {
    "sf0.001": (
        150,
        1,
        1803,
        "251933678.38",
        {
            "Champions": 27,
            "Loyal High Spenders": 20,
            "Loyal Budget Spenders": 13,
            "At Risk": 46,
            "Others": 44,
        },
    ),
    "sf0.01": (
        1497,
        2,
        2281,
        "2485039865.74",
        {
            "Champions": 245,
            "Loyal High Spenders": 228,
            "Loyal Budget Spenders": 125,
            "At Risk": 438,
            "Others": 461,
        },
    ),
}


@pytest.mark.parametrize("scale", sorted(GOLDEN))
def test_golden_counts(spark, scale):
    orders = read_orders(spark, f"/root/testdata/{scale}/orders.parquet", ORDERS)
    customers, nearest, farthest, money, labels = GOLDEN[scale]
    base = rfm_base(orders, ORDERS_DAY).agg(
        F.count("*"), F.min("recency_days"), F.max("recency_days"), F.sum("monetary_value")
    )
    assert tuple(base.first()) == (customers, nearest, farthest, Decimal(money))
    counted = rfm_daily(orders, ORDERS_DAY).groupBy("rfm_segment").count().collect()
    assert {row.rfm_segment: row["count"] for row in counted} == labels


def test_score_properties(check_orders):
    rows = add_scores(rfm_base(check_orders, ORDERS_DAY)).collect()
    for score, metric, sign in (
        ("r_score", "recency_days", -1),
        ("f_score", "frequency_orders", 1),
        ("m_score", "monetary_value", 1),
    ):
        sizes = [sum(row[score] == bucket for row in rows) for bucket in range(1, 6)]
        assert max(sizes) - min(sizes) <= 1
        assert sizes == sorted(sizes, reverse=True)
        ranked = [(sign * row[metric], row.customer_id, row[score]) for row in rows]
        scores = [score for *_, score in sorted(ranked)]
        assert scores == sorted(scores)


def test_no_order_is_lost(check_orders):
    total = rfm_base(check_orders, ORDERS_DAY).agg(F.sum("frequency_orders")).first()[0]
    assert total == check_orders.where("status <> 'P'").count()


@pytest.mark.parametrize("strategy", [WINDOW, DISTRIBUTED])
def test_backfill_equals_single_days(awkward, strategy):
    first, last = dt.date(2024, 1, 1), dt.date(2024, 1, 13)
    config = DailyConfig(strategy=strategy)
    found = rfm_backfill(awkward, first, last, config).collect()
    expected = []
    for offset in range((last - first).days + 1):
        day = first + dt.timedelta(days=offset)
        known = awkward.where((F.to_date("created_at") <= F.lit(day)) | F.isnull("created_at"))
        expected += rfm_daily(known, DailyConfig(day, strategy=WINDOW)).collect()
    assert sorted(map(repr, found)) == sorted(map(repr, expected))
    # A customer without any dated order is there every day.
    assert sum(row.customer_id == 9 for row in found) == (last - first).days + 1


def test_detailed_backfill_equals_single_days(awkward):
    first, last = dt.date(2024, 1, 8), dt.date(2024, 1, 11)
    found = rfm_backfill(awkward, first, last, DailyConfig(), detailed=True).collect()
    expected = []
    for offset in range((last - first).days + 1):
        day = first + dt.timedelta(days=offset)
        known = awkward.where((F.to_date("created_at") <= F.lit(day)) | F.isnull("created_at"))
        expected += rfm_daily_detailed(known, DailyConfig(day)).collect()
    assert sorted(map(repr, found)) == sorted(map(repr, expected))


@pytest.mark.parametrize("kind", ["decimal(18,4)", "double", "decimal(30,12)"])
def test_small_amounts_are_not_lost(spark, kind):
    table = spark.range(1000).selectExpr(
        "1 customer_id", "id order_id", "timestamp_ntz'2024-01-01' created_at",
        f"cast(0.0040 as {kind}) total", "'done' status",
    )
    base = rfm_base(as_orders(table), DailyConfig(RUN_DATE)).collect()
    assert [row.monetary_value for row in base] == [Decimal(4)]
    for strategy in (WINDOW, DISTRIBUTED):
        rows = rfm_daily(as_orders(table), DailyConfig(RUN_DATE, strategy=strategy)).collect()
        assert [row.monetary_value for row in rows] == [4.0]


TEXT_IDS = ["c-12", "c-1", "C-1", "", "é", "customer-number-1", "customer-number-10", "x" * 300]


def test_text_customers_are_ordered_by_their_bytes(spark):
    ids = [*TEXT_IDS, "x" * 299, "x" * 300 + "\0", "x" * 300 + "\0\0", None]
    rows = [(i, n, dt.datetime(2024, 1, 1), Decimal(5), "done") for n, i in enumerate(ids)]
    schema = ORDERS_SCHEMA.replace("customer_id bigint", "customer_id string")
    orders = as_orders(spark.createDataFrame(rows, schema))
    for day in (RUN_DATE, dt.date(2024, 1, 5)):
        found = [
            sorted(map(repr, rfm_daily(orders, DailyConfig(day, strategy=strategy)).collect()))
            for strategy in (WINDOW, DISTRIBUTED)
        ]
        assert found[0] == found[1]
    scores = add_scores(rfm_base(orders, DailyConfig(RUN_DATE)), DISTRIBUTED).collect()
    ranked = sorted(((r.customer_id or "").encode(), r.f_score) for r in scores if r.customer_id is not None)
    assert [score for _, score in ranked] == sorted(score for _, score in ranked)


def test_backfill_of_a_long_range_by_cuts(check_orders):
    # Early dates hold a handful of customers, late ones all of them.
    first, last = dt.date(1995, 1, 1), dt.date(1995, 2, 9)
    by_window, by_cuts = (
        rfm_backfill(check_orders, first, last, replace(ORDERS_DAY, strategy=strategy))
        for strategy in (WINDOW, DISTRIBUTED)
    )
    assert by_window.select("run_date").distinct().count() == 40
    assert by_window.exceptAll(by_cuts).isEmpty()
    assert by_cuts.exceptAll(by_window).isEmpty()


def test_backfill_needs_a_range(awkward):
    with pytest.raises(ValueError):
        rfm_backfill(awkward, dt.date(2024, 1, 2), dt.date(2024, 1, 1), DailyConfig())


def test_unknown_settings_are_refused():
    with pytest.raises(ValueError):
        DailyConfig(recency_mode="lunar")
    with pytest.raises(ValueError):
        DailyConfig(strategy="guess")
