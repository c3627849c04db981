"""Order sources. Every reader returns the same five typed columns, lazily."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiercast.config import OrderColumns

# Binary floating-point amounts are taken as decimals of this type: their sum is then the same in
# any order, and noise beyond a millionth is rounded off each amount.
FLOATING_MONEY = T.DecimalType(28, 6)
# More digits after the point than a rank key can hold are rounded off.
MOST_SCALE = 18


def _id_type(given: T.DataType) -> T.DataType:
    """Whole numbers are bigints; every other id is text."""
    whole = isinstance(given, T.IntegralType) or (
        isinstance(given, T.DecimalType) and given.scale == 0 and given.precision <= 18
    )
    return T.LongType() if whole else T.StringType()


def _money_type(given: T.DataType) -> T.DataType:
    """A decimal as the source stores it, so that sums are exact."""
    if isinstance(given, T.DecimalType) and given.scale <= MOST_SCALE:
        return given
    if isinstance(given, T.IntegralType):
        return T.DecimalType(20, 0)
    return FLOATING_MONEY


def as_orders(table: DataFrame, columns: OrderColumns = OrderColumns()) -> DataFrame:
    """Project any table onto the five order columns.

    Customer ids are bigint or text, order ids stay as they are, amounts keep the source's decimal
    type. A cast to the type a column already has is dropped by Catalyst, so filters on the result
    still reach the scan and unused source columns are never read.
    """
    roles = ("customer_id", "order_id", "created_at", "total", "status")
    given = table.select(*[F.expr(getattr(columns, role)).alias(role) for role in roles])
    kinds = {
        "customer_id": _id_type(given.schema["customer_id"].dataType),
        "created_at": T.TimestampNTZType(),
        "total": _money_type(given.schema["total"].dataType),
        "status": T.StringType(),
    }
    return given.select(
        *[F.col(r).cast(kinds[r]).alias(r) if r in kinds else F.col(r) for r in roles]
    )


def read_orders(
    spark: SparkSession,
    path: str,
    columns: OrderColumns = OrderColumns(),
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Orders from files in any format Spark reads."""
    return as_orders(spark.read.format(fmt).options(**(options or {})).load(path), columns)


def jdbc_options(
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options for a database table, split into range reads where bounds are given."""
    options = {
        "url": url,
        "dbtable": table,
        "fetchsize": str(fetch_size),
        # Wall-clock times stay as stored, whatever the session's time zone.
        "preferTimestampNTZ": "true",
    }
    if user is not None:
        options["user"] = user
    if password is not None:
        options["password"] = password
    split = (partition_column, bounds, num_partitions)
    if any(part is not None for part in split):
        if any(part is None for part in split):
            raise ValueError("partition_column, bounds and num_partitions go together")
        options["partitionColumn"] = partition_column
        options["lowerBound"], options["upperBound"] = (str(bound) for bound in bounds)
        options["numPartitions"] = str(num_partitions)
    return options


def read_orders_jdbc(
    spark: SparkSession,
    options: Mapping[str, str],
    columns: OrderColumns = OrderColumns(),
    unsplit: bool = False,
) -> DataFrame:
    """Orders from a database; the status filter and the column list are pushed into its query.

    Without a partition column and bounds one task would read the whole table, which has to be
    asked for by ``unsplit``.
    """
    split = {"partitionColumn", "lowerBound", "upperBound", "numPartitions"}
    missing = sorted(split - set(options))
    if missing and not unsplit:
        raise ValueError(f"a split database read needs {', '.join(missing)}; or ask for unsplit")
    return as_orders(spark.read.format("jdbc").options(**options).load(), columns)
