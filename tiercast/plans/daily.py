"""The daily scoring plans: metrics, scores and labels of every customer for one run date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiercast.config import ELAPSED, DailyConfig
from tiercast.functions.labels import core_behaviour, detailed_behaviour, score_tier
from tiercast.functions.recency import recency_days
from tiercast.operators.metrics import accepted_orders, customer_metrics
from tiercast.operators.quintiles import add_scores
from tiercast.operators.scratch import Scratch

DAILY_COLUMNS = (
    "run_date",
    "customer_id",
    "recency_days",
    "frequency_orders",
    "monetary_value",
    "r_score",
    "f_score",
    "m_score",
    "rfm_score",
    "rfm_segment",
)
DETAILED_COLUMNS = (*DAILY_COLUMNS, "comments")


def with_recency(metrics: DataFrame, run_date: Column, mode: str) -> DataFrame:
    return metrics.select(
        run_date.alias("run_date"),
        "customer_id",
        recency_days(run_date, F.col("last_order_date"), mode).alias("recency_days"),
        "frequency_orders",
        "monetary_value",
    )


def rfm_base(orders: DataFrame, config: DailyConfig) -> DataFrame:
    """Run date, customer and the three metrics; the money is still an exact decimal."""
    config = config.resolved()
    accepted = accepted_orders(orders, config.excluded_status)
    return with_recency(
        customer_metrics(accepted), F.lit(config.run_date), config.recency_mode
    )


def scored(base: DataFrame, config: DailyConfig, scratch: Scratch | None = None) -> DataFrame:
    return add_scores(base, config.strategy, scratch=scratch)


def labelled(scores: DataFrame, labels: dict[str, Column], columns: tuple[str, ...]) -> DataFrame:
    money = F.col("monetary_value").cast("double")
    return scores.withColumns({**labels, "monetary_value": money}).select(*columns)


def with_core_labels(scores: DataFrame) -> DataFrame:
    return labelled(scores, {"rfm_segment": core_behaviour()}, DAILY_COLUMNS)


def with_detailed_labels(scores: DataFrame) -> DataFrame:
    labels = {"rfm_segment": score_tier(), "comments": detailed_behaviour()}
    return labelled(scores, labels, DETAILED_COLUMNS)


def rfm_daily(
    orders: DataFrame, config: DailyConfig, scratch: Scratch | None = None
) -> DataFrame:
    """Ten columns; ``rfm_segment`` holds one of six behaviour labels."""
    return with_core_labels(scored(rfm_base(orders, config), config, scratch))


def rfm_daily_detailed(
    orders: DataFrame, config: DailyConfig, scratch: Scratch | None = None
) -> DataFrame:
    """Eleven columns in customer order; ``rfm_segment`` holds one of six score tiers,
    ``comments`` one of sixteen behaviour labels."""
    base = rfm_base(orders, config.resolved(ELAPSED))
    result = with_detailed_labels(scored(base, config, scratch))
    return result.orderBy(F.col("customer_id").asc_nulls_last())
