"""Command line for a scheduled run or a backfill, for use with spark-submit."""

from __future__ import annotations

import argparse
import datetime as dt
from dataclasses import fields

from pyspark.sql import SparkSession

from tiercast.config import (
    AUTO,
    CALENDAR,
    ELAPSED,
    RECENCY_MODES,
    STRATEGIES,
    DailyConfig,
    OrderColumns,
)
from tiercast.plans.job import run, run_backfill
from tiercast.session import SETTINGS
from tiercast.sources.orders import read_orders, read_orders_jdbc


def _pair(text: str) -> tuple[str, str]:
    key, separator, value = text.partition("=")
    if not separator:
        raise argparse.ArgumentTypeError(f"{text} is not KEY=VALUE")
    return key, value


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tiercast", description=__doc__)
    parser.add_argument("--orders", help="path of the order files")
    parser.add_argument("--format", default="parquet", help="their Spark source format, or jdbc")
    parser.add_argument(
        "--option",
        action="append",
        default=[],
        type=_pair,
        metavar="KEY=VALUE",
        help="option of the source, such as header=true or url=...; may be repeated",
    )
    parser.add_argument(
        "--unsplit", action="store_true", help="read a database table in a single task"
    )
    parser.add_argument("--target", required=True, help="path of the snapshot table")
    parser.add_argument("--statistics", help="path for the statistics tables")
    parser.add_argument("--detailed", action="store_true", help="store tiers and long labels")
    parser.add_argument("--run-date", type=dt.date.fromisoformat, help="default: today")
    parser.add_argument(
        "--backfill-from", type=dt.date.fromisoformat, help="write all dates up to the run date"
    )
    parser.add_argument("--excluded-status", default="cancelled")
    parser.add_argument("--recency-mode", choices=RECENCY_MODES)
    parser.add_argument("--strategy", choices=STRATEGIES, default=AUTO)
    for field in fields(OrderColumns):
        name = field.name.replace("_", "-")
        parser.add_argument(f"--{name}", default=field.default, help=f"expression for {field.name}")
    options = parser.parse_args(arguments)
    if options.backfill_from and options.statistics:
        parser.error("a backfill writes no statistics")
    if (options.orders is None) != (options.format == "jdbc"):
        parser.error("--orders is the path of files; a jdbc source takes --option url=... instead")
    return options


def main(arguments: list[str] | None = None) -> None:
    options = parse(arguments)
    builder = SparkSession.builder.appName("tiercast")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    columns = OrderColumns(**{f.name: getattr(options, f.name) for f in fields(OrderColumns)})
    config = DailyConfig(
        run_date=options.run_date,
        excluded_status=options.excluded_status,
        recency_mode=options.recency_mode,
        strategy=options.strategy,
    ).resolved(ELAPSED if options.detailed else CALENDAR)
    given = dict(options.option)
    if options.format == "jdbc":
        orders = read_orders_jdbc(spark, given, columns, options.unsplit)
    else:
        orders = read_orders(spark, options.orders, columns, options.format, given)
    if options.backfill_from:
        dates = (options.backfill_from, config.run_date)
        summary = run_backfill(orders, options.target, *dates, config, options.detailed)
    else:
        summary = run(orders, options.target, config, options.detailed, options.statistics)
    # One row per date.
    summary.orderBy("run_date").show(summary.count(), truncate=False)


if __name__ == "__main__":
    main()
