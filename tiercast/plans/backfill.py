"""Snapshots of many run dates in one job."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import functions as F

from tiercast.config import CALENDAR, ELAPSED, DailyConfig
from tiercast.operators.metrics import accepted_orders, customer_metrics_as_of
from tiercast.operators.quintiles import add_scores
from tiercast.operators.scratch import Scratch
from tiercast.plans.daily import with_core_labels, with_detailed_labels, with_recency


def backfill_base(
    orders: DataFrame, first: dt.date, last: dt.date, config: DailyConfig
) -> DataFrame:
    """What ``rfm_base`` gives for every date in [first, last], each from the orders up to that date
    and those without a date. The recency mode of the config has to be set."""
    if first > last:
        raise ValueError("first must not be after last")
    accepted = accepted_orders(orders, config.excluded_status)
    metrics = customer_metrics_as_of(accepted, first, last)
    return with_recency(metrics, F.col("run_date"), config.recency_mode)


def rfm_backfill(
    orders: DataFrame,
    first: dt.date,
    last: dt.date,
    config: DailyConfig,
    scratch: Scratch | None = None,
    detailed: bool = False,
) -> DataFrame:
    """The daily plan for every date in [first, last], each from the orders up to that date and
    those without a date."""
    config = config.resolved(ELAPSED if detailed else CALENDAR)
    base = backfill_base(orders, first, last, config)
    scores = add_scores(base, config.strategy, scratch=scratch)
    return with_detailed_labels(scores) if detailed else with_core_labels(scores)


def first_affected(orders: DataFrame, config: DailyConfig, first: dt.date, last: dt.date) -> dt.date | None:
    """The earliest date in [first, last] whose scores these late or corrected orders change, or
    None if there is none.

    A date is scored from all orders up to it and those without a date, so an accepted order changes
    its own day and every later one, and one without a date changes them all. Give a corrected order
    as it was and as it is.
    """
    accepted = accepted_orders(orders, config.excluded_status)
    earliest = accepted.agg(
        F.min(F.greatest(F.coalesce(F.to_date("created_at"), F.lit(first)), F.lit(first)))
    ).first()[0]
    return earliest if earliest is not None and earliest <= last else None
