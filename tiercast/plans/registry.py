"""Every operator as a query over the test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiercast.config import DISTRIBUTED, ELAPSED, DailyConfig, OrderColumns
from tiercast.functions.labels import core_behaviour, detailed_behaviour, score_tier
from tiercast.operators import statistics
from tiercast.operators.metrics import accepted_orders, customer_metrics
from tiercast.operators.scratch import Scratch
from tiercast.operators.upsert import (
    CORE,
    DETAILED,
    upsert,
    upsert_bucketed,
    upsert_files,
    with_logs,
)
from tiercast.plans.backfill import backfill_base, rfm_backfill
from tiercast.plans.daily import (
    DAILY_COLUMNS,
    labelled,
    rfm_base,
    rfm_daily,
    rfm_daily_detailed,
    scored,
    with_core_labels,
    with_detailed_labels,
    with_recency,
)
from tiercast.plans.job import incremental_base, rerun_affected, run, run_backfill
from tiercast.sources.bucketed import BucketedSnapshot
from tiercast.sources.orders import read_orders
from tiercast.sources.snapshot import read_snapshot
from tiercast.sources.stored_metrics import StoredMetrics
from tiercast.sources.versions import VersionedSnapshot
from tiercast.streaming.ingest import ingest_orders, read_order_stream

Query = Callable[[SparkSession, str], DataFrame]

ORDERS = OrderColumns("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice", "o_orderstatus")
EVENTS = OrderColumns("user_id", "event_id", "ts", "value", "event_type")
# Four keys that hold all accepted rows between them: fewer customers than score buckets.
EVENT_TYPES = replace(EVENTS, customer_id="ascii(event_type)")
# Text keys that differ only after many bytes.
TEXT_KEYS = replace(ORDERS, customer_id="concat('customer-of-the-shop-', o_custkey)")
# One order per customer, so that the frequency is constant.
SINGLE_ORDERS = replace(ORDERS, customer_id="o_orderkey")

ORDERS_DAY = DailyConfig(dt.date(2001, 8, 2), excluded_status="P")
EVENTS_DAY = DailyConfig(dt.date(2024, 1, 31), excluded_status="error")
EVENTS_ELAPSED = replace(EVENTS_DAY, recency_mode=ELAPSED)
EVENTS_MID_MONTH = replace(EVENTS_ELAPSED, run_date=dt.date(2024, 1, 15))

BACKFILL = (dt.date(2001, 7, 30), dt.date(2001, 8, 2))
# The upsert queries score the orders before and from this moment as two batches of one day.
BATCH_SPLIT = dt.datetime(1998, 7, 1)
LATE_DAY = dt.date(2001, 7, 31)
# The incremental queries get the orders of these years in this order: late ones last.
ARRIVALS = ((1999, 2100), (1997, 1999), (0, 1997))
FIRST_RUN = dt.datetime(2001, 8, 2, 2, 0)
SECOND_RUN = dt.datetime(2001, 8, 2, 14, 30)

SCORE_COLUMNS = ("run_date", "customer_id", "r_score", "f_score", "m_score", "rfm_score")


def _orders(spark: SparkSession, sf_dir: str, columns: OrderColumns = ORDERS) -> DataFrame:
    return read_orders(spark, f"{sf_dir}/orders.parquet", columns)


def _events(spark: SparkSession, sf_dir: str, columns: OrderColumns = EVENTS) -> DataFrame:
    return read_orders(spark, f"{sf_dir}/events.parquet", columns)


def _with_money(frame: DataFrame, column: str = "monetary_value") -> DataFrame:
    return frame.withColumn(column, F.col(column).cast("double"))


def _comparable(frame: DataFrame) -> DataFrame:
    """Doubles with nine significant digits, which sums in any order agree on."""
    return frame.withColumns(
        {
            name: F.when(F.col(name).isNotNull(), F.format_string("%.8e", name).cast("double"))
            for name, kind in frame.dtypes
            if kind == "double"
        }
    )


def filter_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted = accepted_orders(_orders(spark, sf_dir), ORDERS_DAY.excluded_status)
    return _with_money(accepted, "total")


def base_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted = accepted_orders(_orders(spark, sf_dir), ORDERS_DAY.excluded_status)
    return _with_money(customer_metrics(accepted))


def _recency(config: DailyConfig) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        base = rfm_base(_events(spark, sf_dir), config)
        return base.select("run_date", "customer_id", "recency_days")

    return query


def _scores(config: DailyConfig, columns: OrderColumns = ORDERS) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        base = rfm_base(_orders(spark, sf_dir, columns), config)
        return scored(base, config).select(*SCORE_COLUMNS)

    return query


def scores_small(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _events(spark, sf_dir, EVENT_TYPES)
    return scored(rfm_base(orders, EVENTS_DAY), EVENTS_DAY).select(*SCORE_COLUMNS)


def _label(name: str, column: Callable) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        scores = scored(rfm_base(_orders(spark, sf_dir), ORDERS_DAY), ORDERS_DAY)
        return labelled(scores, {name: column()}, (*SCORE_COLUMNS, name))

    return query


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rfm_daily(_orders(spark, sf_dir), ORDERS_DAY)


def _daily_detailed(config: DailyConfig) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rfm_daily_detailed(_events(spark, sf_dir), config)

    return query


def _two_batches(spark: SparkSession, sf_dir: str, detailed: bool, write: Callable) -> None:
    """Give both batches to ``write(batch, run_dates, rule, run_ts)``."""
    orders = _orders(spark, sf_dir)
    split = F.lit(str(BATCH_SPLIT)).cast("timestamp_ntz")
    for part, run_ts in (
        (orders.where(F.col("created_at") < split), FIRST_RUN),
        (orders.where(F.col("created_at") >= split), SECOND_RUN),
    ):
        scores = scored(rfm_base(part, ORDERS_DAY), ORDERS_DAY)
        if detailed:
            batch, rule = with_logs(with_detailed_labels(scores)), DETAILED
        else:
            batch, rule = with_core_labels(scores), CORE
        write(batch, [ORDERS_DAY.run_date], rule, run_ts)


def _upserted(detailed: bool) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        target = f"{Scratch(spark).path}/customer_daily"

        def write(batch: DataFrame, *options) -> None:
            upsert(batch, target, *options)

        _two_batches(spark, sf_dir, detailed, write)
        return read_snapshot(spark, target)

    return query


def upsert_core_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = BucketedSnapshot(spark, f"{Scratch(spark).path}/customer_daily", buckets=8)

    def write(batch: DataFrame, *options) -> None:
        upsert_bucketed(batch, table, *options)

    _two_batches(spark, sf_dir, False, write)
    table.forget()
    return table.read()


def upsert_detailed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = VersionedSnapshot(spark, f"{Scratch(spark).path}/customer_daily", rows_per_file=5000)

    def write(batch: DataFrame, *options) -> None:
        upsert_files(batch, table, *options)

    _two_batches(spark, sf_dir, True, write)
    return table.read()


def _arrived(spark: SparkSession, sf_dir: str) -> StoredMetrics:
    """All orders, added in batches of years with late ones last, one batch twice."""
    orders = _orders(spark, sf_dir)
    stored = StoredMetrics(spark, f"{Scratch(spark).path}/metrics", ORDERS_DAY.excluded_status)
    year = F.coalesce(F.year("created_at"), F.lit(0))
    for batch, (first, end) in enumerate(ARRIVALS):
        arriving = orders.where((year >= first) & (year < end))
        stored.add(arriving, batch)
        if batch == 1:
            stored.add(arriving, batch)
            stored.compact()
    return stored


def daily_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = incremental_base(_arrived(spark, sf_dir), ORDERS_DAY)
    return with_core_labels(scored(base, ORDERS_DAY))


def backfill_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = _arrived(spark, sf_dir).metrics_as_of(*BACKFILL)
    base = with_recency(metrics, F.col("run_date"), ORDERS_DAY.resolved().recency_mode)
    return with_core_labels(scored(base, ORDERS_DAY))


def daily_ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order table as a file stream, into the stored metrics and the snapshot."""
    root = Scratch(spark).path
    schema = spark.read.parquet(f"{sf_dir}/orders.parquet").schema
    # The stream lists a folder, or what a pattern matches.
    stream = read_order_stream(spark, f"{sf_dir}/orders.parque[t]", schema, ORDERS)
    ingest_orders(stream, f"{root}/checkpoint", f"{root}/metrics", f"{root}/daily", ORDERS_DAY)
    return read_snapshot(spark, f"{root}/daily").select(*DAILY_COLUMNS)


def rerun_after_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A backfill of the orders before a late one's day, then the dates which the late orders change."""
    orders = _orders(spark, sf_dir)
    target = f"{Scratch(spark).path}/customer_daily"
    late = F.coalesce(F.to_date("created_at") == F.lit(LATE_DAY), F.lit(False))
    run_backfill(orders.where(~late), target, *BACKFILL, ORDERS_DAY)
    rerun_affected(orders, orders.where(late), target, *BACKFILL, ORDERS_DAY)
    return read_snapshot(spark, target).select(*DAILY_COLUMNS)


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = f"{Scratch(spark).path}/customer_daily"
    return run(_orders(spark, sf_dir), target, ORDERS_DAY)


def backfill_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = f"{Scratch(spark).path}/customer_daily"
    return run_backfill(_orders(spark, sf_dir), target, *BACKFILL, ORDERS_DAY)


def _statistic(
    measure: Callable[..., DataFrame], columns: OrderColumns = ORDERS, **options
) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        base = rfm_base(_orders(spark, sf_dir, columns), ORDERS_DAY)
        return _comparable(measure(base, **options))

    return query


def _by_date(measure: Callable[..., DataFrame], **options) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        base = backfill_base(_orders(spark, sf_dir), *BACKFILL, ORDERS_DAY.resolved())
        return _comparable(measure(base, by=("run_date",), **options))

    return query


def significance_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Unlike those of the orders, these p-values are not all tiny.
    base = rfm_base(_events(spark, sf_dir), EVENTS_DAY)
    return _comparable(statistics.metric_significance(base))


def _backfill(config: DailyConfig, detailed: bool = False) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rfm_backfill(_orders(spark, sf_dir), *BACKFILL, config, detailed=detailed)

    return query


def queries() -> dict[str, Query]:
    distributed = replace(ORDERS_DAY, strategy=DISTRIBUTED)
    return {
        "filter_status": filter_status,
        "rfm_base": base_metrics,
        "recency_calendar": _recency(EVENTS_DAY),
        "recency_elapsed": _recency(EVENTS_ELAPSED),
        "recency_elapsed_negative": _recency(EVENTS_MID_MONTH),
        "scores": _scores(ORDERS_DAY),
        "scores_distributed": _scores(distributed),
        "scores_small": scores_small,
        "scores_text_keys": _scores(ORDERS_DAY, TEXT_KEYS),
        "scores_text_keys_distributed": _scores(distributed, TEXT_KEYS),
        "segment_core": _label("rfm_segment", core_behaviour),
        "segment_detailed": _label("comments", detailed_behaviour),
        "score_tier": _label("rfm_segment", score_tier),
        "rfm_daily": daily,
        "rfm_daily_incremental": daily_incremental,
        "rfm_daily_ingested": daily_ingested,
        "rfm_daily_detailed": _daily_detailed(EVENTS_ELAPSED),
        "rfm_daily_detailed_distributed": _daily_detailed(
            replace(EVENTS_ELAPSED, strategy=DISTRIBUTED)
        ),
        "upsert_core": _upserted(detailed=False),
        "upsert_core_bucketed": upsert_core_bucketed,
        "upsert_detailed": _upserted(detailed=True),
        "upsert_detailed_files": upsert_detailed_files,
        "run_summary": run_summary,
        "metric_correlation": _statistic(statistics.metric_correlation),
        "metric_significance": _statistic(statistics.metric_significance),
        "metric_significance_events": significance_events,
        "metric_correlation_constant": _statistic(statistics.metric_correlation, SINGLE_ORDERS),
        "metric_significance_constant": _statistic(statistics.metric_significance, SINGLE_ORDERS),
        "metric_regression": _statistic(statistics.metric_regression),
        "metric_histogram": _statistic(statistics.metric_histogram),
        "metric_histogram_distributed": _statistic(
            statistics.metric_histogram, strategy=DISTRIBUTED
        ),
        "metric_density": _statistic(statistics.metric_density),
        "metric_correlation_by_date": _by_date(statistics.metric_correlation),
        "metric_significance_by_date": _by_date(statistics.metric_significance),
        "metric_regression_by_date": _by_date(statistics.metric_regression),
        "metric_histogram_by_date": _by_date(statistics.metric_histogram, strategy=DISTRIBUTED),
        "metric_density_by_date": _by_date(statistics.metric_density),
        "rfm_backfill": _backfill(ORDERS_DAY),
        "rfm_backfill_distributed": _backfill(distributed),
        "rfm_backfill_detailed": _backfill(ORDERS_DAY, detailed=True),
        "rfm_backfill_incremental": backfill_incremental,
        "rfm_backfill_corrected": rerun_after_corrections,
        "backfill_summary": backfill_summary,
    }
