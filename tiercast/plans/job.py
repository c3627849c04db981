"""Jobs that write the snapshot table: one scheduled run, or many dates at once."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiercast.config import CALENDAR, ELAPSED, DailyConfig
from tiercast.operators import statistics
from tiercast.operators.quintiles import stage_with_keys
from tiercast.operators.scratch import Scratch, plan_table
from tiercast.operators.upsert import CORE, DETAILED, upsert, with_logs
from tiercast.plans.backfill import backfill_base, first_affected
from tiercast.plans.daily import (
    rfm_base,
    scored,
    with_core_labels,
    with_detailed_labels,
    with_recency,
)
from tiercast.sources.stored_metrics import StoredMetrics

STATISTICS = (
    statistics.metric_correlation,
    statistics.metric_significance,
    statistics.metric_regression,
    statistics.metric_histogram,
    statistics.metric_density,
)


# These read the measures of all pairs, which come from one aggregation.
OF_PAIRS = STATISTICS[:3]


def _batch(rows: DataFrame, detailed: bool):
    return (with_logs(rows), DETAILED) if detailed else (rows, CORE)


def _write_statistics(
    base: DataFrame, path: str, scratch: Scratch, by: statistics.By
) -> None:
    pairs = scratch.stage(statistics.pair_measures(base, by), "pairs")
    for measure in STATISTICS:
        table = measure(pairs if measure in OF_PAIRS else base, by=by)
        table.write.mode("overwrite").parquet(f"{path}/{measure.__name__}")


def _summary(spark: SparkSession, records: dict[dt.date, int]) -> DataFrame:
    return plan_table(spark, [{"run_date": day, "records": n} for day, n in records.items()])


def run(
    orders: DataFrame,
    target: str,
    config: DailyConfig = DailyConfig(),
    detailed: bool = False,
    statistics_path: str | None = None,
) -> DataFrame:
    """Write the run date's snapshot and return one row: the date and the records processed.

    With ``statistics_path`` the statistics tables are written there too, one folder each, after the
    snapshot. The orders are then aggregated once, into a staged table that everything else reads.
    """
    spark = orders.sparkSession
    config = config.resolved(ELAPSED if detailed else CALENDAR)
    with Scratch(spark) as scratch:
        base = rfm_base(orders, config)
        if statistics_path is not None:
            base = stage_with_keys(base, scratch)
        scores = scored(base, config, scratch)
        labels = with_detailed_labels if detailed else with_core_labels
        batch, rule = _batch(labels(scores), detailed)
        records = upsert(batch, target, [config.run_date], rule, config.run_ts, unique_keys=True)
        if statistics_path is not None:
            _write_statistics(base, statistics_path, scratch, ())
    return _summary(spark, records)


def incremental_base(stored: StoredMetrics, config: DailyConfig) -> DataFrame:
    """What ``rfm_base`` gives for all orders that were added."""
    config = config.resolved()
    return with_recency(stored.metrics(), F.lit(config.run_date), config.recency_mode)


def run_incremental(
    new_orders: DataFrame,
    batch: int,
    metrics_path: str,
    target: str,
    config: DailyConfig = DailyConfig(),
    detailed: bool = False,
) -> DataFrame:
    """Like ``run``, from the stored metrics and the orders that are new since the last batch.

    The order history is not read. ``batch`` numbers the arrivals; repeating a run with the number
    it had gives the same snapshot.
    """
    spark = new_orders.sparkSession
    config = config.resolved(ELAPSED if detailed else CALENDAR)
    stored = StoredMetrics(spark, metrics_path, config.excluded_status)
    stored.add(new_orders, batch)
    with Scratch(spark) as scratch:
        scores = scored(incremental_base(stored, config), config, scratch)
        labels = with_detailed_labels if detailed else with_core_labels
        rows, rule = _batch(labels(scores), detailed)
        records = upsert(rows, target, [config.run_date], rule, config.run_ts, unique_keys=True)
    return _summary(spark, records)


def run_backfill(
    orders: DataFrame,
    target: str,
    first: dt.date,
    last: dt.date,
    config: DailyConfig = DailyConfig(),
    detailed: bool = False,
    statistics_path: str | None = None,
) -> DataFrame:
    """Write the snapshots of every date in [first, last] in one job and return one row per date:
    the date and the records processed, counted while they were written.

    With ``statistics_path`` the statistics tables of all dates are written there too, with a column
    for the date."""
    spark = orders.sparkSession
    config = config.resolved(ELAPSED if detailed else CALENDAR)
    run_dates = [first + dt.timedelta(days=day) for day in range((last - first).days + 1)]
    with Scratch(spark) as scratch:
        base = backfill_base(orders, first, last, config)
        if statistics_path is not None:
            base = stage_with_keys(base, scratch)
        labels = with_detailed_labels if detailed else with_core_labels
        batch, rule = _batch(labels(scored(base, config, scratch)), detailed)
        records = upsert(batch, target, run_dates, rule, config.run_ts, unique_keys=True)
        if statistics_path is not None:
            _write_statistics(base, statistics_path, scratch, ("run_date",))
    return _summary(spark, records)


def rerun_affected(
    orders: DataFrame,
    changed: DataFrame,
    target: str,
    first: dt.date,
    last: dt.date,
    config: DailyConfig = DailyConfig(),
    detailed: bool = False,
) -> DataFrame:
    """``run_backfill`` of the dates in [first, last] that late or corrected orders change.

    ``orders`` are all orders as they are now; ``changed`` the late ones, and the corrected ones as
    they were and as they are. Snapshots of dates before the first change are left alone. As with any
    upsert, a customer all of whose orders were withdrawn keeps the rows that are stored.
    """
    start = first_affected(changed, config, first, last)
    if start is None:
        schema = "run_date date, records long"
        return orders.sparkSession.createDataFrame([], schema)
    return run_backfill(orders, target, start, last, config, detailed)
