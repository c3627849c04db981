"""Stored metrics that grow with new orders: a daily run reads these instead of the order history.

The state holds, per customer and day of order, the latest moment, the count and the sum. All three
merge, so orders may arrive in any order and any day's orders in several batches. Each batch of new
orders becomes an increment, a folder of its own: adding a batch again replaces its folder, so a
repeated batch changes nothing. ``compact`` merges all increments into a new base, which takes effect
with one pointer; days before its horizon become one row per customer.

Orders are facts here: an order that is changed or withdrawn later needs a new state.
"""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiercast.operators.metrics import accepted_orders, running_metrics
from tiercast.operators.scratch import hadoop_path
from tiercast.sources.pointer import latest, publish


def daily_metrics(orders: DataFrame) -> DataFrame:
    """``(customer_id, day, latest, orders, spent)``; orders without a date have no day."""
    return orders.groupBy("customer_id", F.to_date("created_at").alias("day")).agg(
        F.max("created_at").alias("latest"),
        F.count("order_id").alias("orders"),
        F.sum("total").alias("spent"),
    )


def _merged(rows: DataFrame, *keys) -> DataFrame:
    """The same measures by other keys, in the same types."""
    return rows.groupBy(*keys).agg(
        F.max("latest").alias("latest"),
        F.sum("orders").alias("orders"),
        F.sum("spent").cast(rows.schema["spent"].dataType).alias("spent"),
    )


class StoredMetrics:
    """The state below one path, for one excluded status."""

    def __init__(self, spark: SparkSession, path: str, excluded_status: str) -> None:
        self._spark, self._path, self._status = spark, path, excluded_status

    def _state(self) -> tuple[int, dict]:
        number, state = latest(self._spark, f"{self._path}/state")
        if state and state["excluded_status"] != self._status:
            raise ValueError(f"the state leaves out {state['excluded_status']!r} orders")
        return number, state or {
            "excluded_status": self._status, "base": None, "through": -1, "horizon": None
        }

    def _increments(self, after: int) -> dict[int, str]:
        """The folders of the batches beyond that one."""
        location, files = hadoop_path(self._spark, f"{self._path}/increments")
        if not files.exists(location):
            return {}
        found = {}
        for entry in files.listStatus(location):
            number = int(entry.getPath().getName().removeprefix("batch-"))
            if number > after:
                found[number] = f"{self._path}/increments/{entry.getPath().getName()}"
        for number, folder in found.items():
            if not files.exists(hadoop_path(self._spark, f"{folder}/_SUCCESS")[0]):
                raise RuntimeError(f"batch {number} was not finished: add it again")
        return found

    def add(self, orders: DataFrame, batch: int) -> bool:
        """Store a batch of new orders; nothing else is read. A batch that the base holds already is
        left out."""
        number, state = self._state()
        if number < 0:
            publish(self._spark, f"{self._path}/state", 0, state)
        if batch <= state["through"]:
            return False
        rows = daily_metrics(accepted_orders(orders, self._status))
        rows.write.mode("overwrite").parquet(f"{self._path}/increments/batch-{batch:012d}")
        return True

    def rows(self) -> DataFrame:
        """The stored rows; a customer's day may have several."""
        _, state = self._state()
        parts = list(self._increments(state["through"]).values())
        if state["base"]:
            parts.append(f"{self._path}/{state['base']}")
        if not parts:
            raise ValueError("no orders have been added yet")
        return reduce(DataFrame.unionAll, [self._spark.read.parquet(part) for part in parts])

    def compact(self, horizon: dt.date | None = None) -> None:
        """Merge all increments into the base. Dates before the horizon can no longer be asked for,
        and their days become one row per customer."""
        number, state = self._state()
        increments = self._increments(state["through"])
        before = state["horizon"] and dt.date.fromisoformat(state["horizon"])
        horizon = max((day for day in (before, horizon) if day), default=None)
        # A missing day stays so.
        day = F.col("day") if horizon is None else F.when(
            F.col("day").isNotNull(), F.greatest("day", F.lit(horizon))
        )
        base = f"base/{uuid.uuid4().hex}"
        rows = _merged(self.rows(), "customer_id", day.alias("day"))
        rows.write.parquet(f"{self._path}/{base}")
        state = state | {
            "base": base,
            "through": max(increments, default=state["through"]),
            "horizon": horizon and horizon.isoformat(),
        }
        publish(self._spark, f"{self._path}/state", number + 1, state)

    def clean(self) -> None:
        """Remove what the base has replaced. Tables that were read before must not be in use."""
        _, state = self._state()
        for folder, kept in (
            ("increments", lambda name: int(name.removeprefix("batch-")) > state["through"]),
            ("base", lambda name: f"base/{name}" == state["base"]),
        ):
            location, files = hadoop_path(self._spark, f"{self._path}/{folder}")
            for entry in files.listStatus(location) if files.exists(location) else ():
                if not kept(entry.getPath().getName()):
                    files.delete(entry.getPath(), True)

    def metrics(self) -> DataFrame:
        """The metrics per customer of all orders added, as ``customer_metrics`` gives them."""
        return _merged(self.rows(), "customer_id").select(
            "customer_id",
            F.col("latest").alias("last_order_date"),
            F.col("orders").alias("frequency_orders"),
            F.col("spent").alias("monetary_value"),
        )

    def metrics_as_of(self, first: dt.date, last: dt.date) -> DataFrame:
        """The metrics per customer and run date, as ``customer_metrics_as_of`` gives them."""
        _, state = self._state()
        if state["horizon"] and first < dt.date.fromisoformat(state["horizon"]):
            raise ValueError(f"days before {state['horizon']} have been merged")
        rows = self.rows().where((F.col("day") <= F.lit(last)) | F.col("day").isNull())
        daily = _merged(rows, "customer_id", F.greatest("day", F.lit(first)).alias("valid_from"))
        return running_metrics(daily, last)
