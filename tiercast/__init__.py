"""Daily customer value snapshots (recency, frequency, monetary) on Spark."""

from tiercast.config import DailyConfig, OrderColumns
from tiercast.plans.backfill import rfm_backfill
from tiercast.plans.daily import rfm_base, rfm_daily, rfm_daily_detailed
from tiercast.plans.job import run, run_backfill
from tiercast.sources.orders import read_orders, read_orders_jdbc

__all__ = [
    "DailyConfig",
    "OrderColumns",
    "read_orders",
    "read_orders_jdbc",
    "rfm_backfill",
    "rfm_base",
    "rfm_daily",
    "rfm_daily_detailed",
    "run",
    "run_backfill",
]
