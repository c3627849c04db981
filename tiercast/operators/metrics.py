"""Per-customer metrics: latest order, order count, money spent."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tiercast.functions.timestamps import wall_clock


def accepted_orders(orders: DataFrame, excluded_status: str) -> DataFrame:
    """Orders in any other status. A missing status is not accepted either."""
    return orders.where(F.col("status") != F.lit(excluded_status))


def customer_metrics(orders: DataFrame) -> DataFrame:
    """One row per customer. All three aggregates combine before the shuffle, so a customer that
    owns a large share of the orders sends one row per map task."""
    return orders.groupBy("customer_id").agg(
        F.max("created_at").alias("last_order_date"),
        F.count("order_id").alias("frequency_orders"),
        F.sum("total").alias("monetary_value"),
    )


def customer_metrics_as_of(orders: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """One row per customer and run date in [first, last], from the orders up to that date.

    Orders without a date belong to every date, as they do to a single daily run.

    Orders are reduced to one row per customer and effective day (everything before ``first``
    counts for ``first``), running totals follow within the customer, and each total is repeated
    for the days it stays valid. An order is thus read once, however many days are asked for, and
    a customer's window never exceeds the number of days.
    """
    start = F.lit(first)
    after_last = wall_clock(dt.datetime.combine(last + dt.timedelta(days=1), dt.time()))
    daily = (
        # On the timestamp itself, so that the bound reaches the scan.
        orders.where((F.col("created_at") < after_last) | F.col("created_at").isNull())
        .groupBy(
            "customer_id",
            # Without a date, the first day.
            F.greatest(F.to_date("created_at"), start).alias("valid_from"),
        )
        .agg(
            F.max("created_at").alias("latest"),
            F.count("order_id").alias("orders"),
            F.sum("total").alias("spent"),
        )
    )
    return running_metrics(daily, last)


def running_metrics(daily: DataFrame, last: dt.date) -> DataFrame:
    """One row per customer and run date up to ``last``, from ``(customer_id, valid_from, latest,
    orders, spent)`` with unique keys."""
    by_day = Window.partitionBy("customer_id").orderBy("valid_from")
    so_far = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    next_change = F.lead("valid_from").over(by_day)
    return daily.select(
        "customer_id",
        F.max("latest").over(so_far).alias("last_order_date"),
        F.sum("orders").over(so_far).alias("frequency_orders"),
        F.sum("spent").over(so_far).cast(daily.schema["spent"].dataType).alias("monetary_value"),
        F.sequence("valid_from", F.coalesce(F.date_sub(next_change, 1), F.lit(last))).alias("days"),
    ).select(
        F.explode("days").alias("run_date"),
        "customer_id",
        "last_order_date",
        "frequency_orders",
        "monetary_value",
    )
