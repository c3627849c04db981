"""Quintile scores over a global order, one order per metric and run date."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tiercast.config import AUTO, BUCKETS, SMALL_PLAN_BYTES, WINDOW
from tiercast.operators.ranked_keys import SORT_ROWS, Levels, TextTie, keys_at_ranks
from tiercast.operators.scratch import Scratch, plan_bytes, plan_table


class Score(NamedTuple):
    name: str
    metric: str
    descending: bool = False


# A missing value goes first in the descending order and last in the ascending ones.
SCORES = (
    Score("r_score", "recency_days", descending=True),
    Score("f_score", "frequency_orders"),
    Score("m_score", "monetary_value"),
)

# The summed money in units of its scale has up to 38 digits. Split here, both parts of any
# number below 9e36 fit a bigint and order alike; a larger one fails the cast.
SPLIT_DIGITS = 18
MONEY_SPLIT = 10**SPLIT_DIGITS
MONEY_PARTS = ("money_major", "money_minor")

# Place of missing values, the value in two parts, whether there is a customer id; the parts of
# the id follow.
VALUE_LEVELS = ("nulls", "major", "minor", "known")
# Bytes of a text id in one bigint, and those that are looked at together.
ID_BYTES, ID_WINDOW = 7, 21


def add_scores(
    base: DataFrame,
    strategy: str = AUTO,
    scratch: Scratch | None = None,
    sort_rows: int = SORT_ROWS,
) -> DataFrame:
    """Append the three scores and their sum to ``(run_date, customer_id, metrics)``.

    Buckets differ by at most one row, the larger ones first; equal values are separated by
    customer id. Both strategies give the same rows.
    """
    # The estimate does not see a backfill repeat its rows per date, and should not: a task of the
    # window sorts one date at a time, which never holds more than all customers.
    if strategy == AUTO and plan_bytes(base) <= SMALL_PLAN_BYTES:
        strategy = WINDOW
    if strategy == WINDOW:
        scored = _by_window(base)
    else:
        scored = _by_cuts(stage_with_keys(base, scratch), sort_rows)
    return scored.withColumn("rfm_score", sum_of(F.col(score.name) for score in SCORES))


def sum_of(columns) -> Column:
    return reduce(Column.__add__, columns)


def _by_window(base: DataFrame) -> DataFrame:
    def order(score: Score) -> list[Column]:
        metric = F.col(score.metric)
        directed = metric.desc_nulls_first() if score.descending else metric.asc_nulls_last()
        return [directed, F.col("customer_id").asc_nulls_first()]

    return base.withColumns(
        {
            score.name: F.ntile(BUCKETS).over(
                Window.partitionBy("run_date").orderBy(*order(score))
            )
            for score in SCORES
        }
    )


def money_scale(base: DataFrame) -> int:
    return base.schema["monetary_value"].dataType.scale


def stage_with_keys(base: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """The staged metrics with the money also as two bigints, so that passes avoid decimals.

    A table that was staged here before is returned as it is.
    """
    if set(MONEY_PARTS) <= set(base.columns):
        return base
    scale = money_scale(base)
    # In the money's own unit, the larger part counts steps of this size.
    step = F.lit(Decimal(10) ** (SPLIT_DIGITS - scale)).cast(f"decimal({SPLIT_DIGITS + 1},{scale})")
    money, unit = F.col("monetary_value"), F.lit(10**scale).cast(f"decimal({scale + 1},0)")
    major, minor = MONEY_PARTS
    rest = F.pmod(money, step)
    keyed = base.withColumns(
        {
            major: ((money - rest) / step).cast("decimal(38,0)").cast("bigint"),
            minor: (rest.cast(f"decimal({SPLIT_DIGITS + 1},{scale})") * unit).cast("bigint"),
        }
    )
    return (scratch or Scratch(base.sparkSession)).stage(keyed, "metrics")


def value_parts(metric: str) -> tuple[Column, Column]:
    if metric == "monetary_value":
        return tuple(F.col(part) for part in MONEY_PARTS)
    return F.lit(0).cast("bigint"), F.col(metric).cast("bigint")


def _text_parts(offset: int) -> dict[str, Column]:
    """Bigints that order like the ``ID_WINDOW`` bytes of a text id from an offset on: runs of seven
    bytes, and the number of bytes, which tells an id from one that goes on with zero bytes."""
    customer = F.col("customer_id")
    text = F.encode(customer, "UTF-8")

    def part(i: int) -> Column:
        digits = F.hex(F.substring(text, offset + ID_BYTES * i + 1, ID_BYTES))
        return F.conv(F.rpad(digits, 2 * ID_BYTES, "0"), 16, 10).cast("bigint")

    left = F.greatest(F.octet_length(customer) - offset, F.lit(0))
    return {
        **{f"id_{i}": part(i) for i in range(ID_WINDOW // ID_BYTES)},
        "id_length": F.least(left, F.lit(ID_WINDOW)).cast("bigint"),
    }


def id_levels(staged: DataFrame) -> tuple[dict[str, Column], TextTie | None]:
    """The customer id as bigints that order like it, and what breaks their ties: a text id beyond
    its first bytes."""
    if staged.schema["customer_id"].dataType.simpleString() == "bigint":
        return {"id": F.col("customer_id")}, None
    return _text_parts(0), TextTie("customer_id", ID_WINDOW, _text_parts)


def _value_key(score: Score) -> dict[str, Column]:
    sign = -1 if score.descending else 1
    absent = F.lit(0).cast("bigint")
    major, minor = (F.coalesce(part * sign, absent) for part in value_parts(score.metric))
    missing = F.col(score.metric).isNull()
    values = (missing != F.lit(score.descending), major, minor, F.col("customer_id").isNotNull())
    return {name: value.cast("bigint") for name, value in zip(VALUE_LEVELS, values)}


def _key(score: Score, ids: dict[str, Column]) -> dict[str, Column]:
    absent = F.lit(0).cast("bigint")
    return _value_key(score) | {name: F.coalesce(part, absent) for name, part in ids.items()}


def bucket_ends(n_rows: int) -> list[int]:
    """Rank of the last row of each bucket but the final one."""
    size, larger = divmod(n_rows, BUCKETS)
    return [bucket * size + min(bucket, larger) for bucket in range(1, BUCKETS)]


def score_entries(
    staged: DataFrame, ids: dict[str, Column], tie: TextTie | None
) -> DataFrame:
    """One row per customer and metric, in the form ``keys_at_ranks`` orders."""
    per_metric = [
        staged.select(
            F.unix_date("run_date").alias("day"),
            F.lit(number).alias("metric"),
            *[level.alias(name) for name, level in _key(score, ids).items()],
            *([tie.column] if tie else []),
        )
        for number, score in enumerate(SCORES)
    ]
    return reduce(DataFrame.unionAll, per_metric)


def _by_cuts(staged: DataFrame, sort_rows: int) -> DataFrame:
    """Compare every row with the four bucket ends of each metric: no sort, no shuffle."""
    ids, tie = id_levels(staged)
    levels: Levels = (*VALUE_LEVELS, *ids)
    entries = score_entries(staged, ids, tie)
    keys, totals = keys_at_ranks(entries, bucket_ends, sort_rows, levels, tie)
    if not totals:
        return _by_window(staged).drop(*MONEY_PARTS)
    # The cuts hold whole ids, bigint or text.
    at = {
        (k.day, k.metric, k.rank): dict(zip(levels, k.key))
        | {"id": k.text or "" if tie else k.key[-1]}
        for k in keys
    }
    fields = [*[(level, pa.int64()) for level in VALUE_LEVELS], ("id", pa.string() if tie else pa.int64())]
    cuts_type = pa.list_(pa.struct(fields))
    columns = [f"{score.name}_cuts" for score in SCORES]

    names = [name for name, _ in fields]

    def cuts_of(day: int, number: int) -> list[dict]:
        ends = bucket_ends(totals[day, number])
        return [{name: at[day, number, end][name] for name in names} for end in ends]

    cuts = plan_table(
        staged.sparkSession,
        [
            {"day": day, **{c: cuts_of(day, number) for number, c in enumerate(columns)}}
            for day in sorted({day for day, _ in totals})
        ],
        # Structs compare field by field, so the order of the levels must be given.
        pa.schema([("day", pa.int32()), *[(column, cuts_type) for column in columns]]),
    )

    whole_id = F.coalesce("customer_id", F.lit("" if tie else 0))

    def bucket(score: Score, column: str) -> Column:
        parts = _value_key(score) | {"id": whole_id}
        key = F.struct(*[part.alias(name) for name, part in parts.items()])
        passed = ((key > F.col(column)[i]).cast("int") for i in range(BUCKETS - 1))
        return sum_of([F.lit(1), *passed])

    # One row per run date, so the broadcast does not grow with the customers.
    return (
        staged.withColumn("day", F.unix_date("run_date"))
        .join(F.broadcast(cuts), "day")
        .withColumns({s.name: bucket(s, c) for s, c in zip(SCORES, columns)})
        .drop("day", *columns, *MONEY_PARTS)
    )
