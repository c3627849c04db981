"""Day distance between a run date and the latest order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tiercast.config import CALENDAR


def recency_days(run_date: Column, last_order: Column, mode: str) -> Column:
    """Calendar mode counts date changes; elapsed mode counts whole 24-hour days, towards zero."""
    if mode == CALENDAR:
        return F.datediff(run_date, F.to_date(last_order))
    midnight = run_date.cast("timestamp_ntz")
    return F.date_part(F.lit("day"), midnight - last_order).cast("int")
