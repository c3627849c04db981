"""Label sets, held as ordered tables of score ranges. The first matching row wins."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from tiercast.config import BUCKETS

ANY = (1, BUCKETS)


class Behaviour(NamedTuple):
    label: str
    r: tuple[int, int] = ANY
    f: tuple[int, int] = ANY
    m: tuple[int, int] = ANY


class Tier(NamedTuple):
    label: str
    total: tuple[int, int]


# The short behaviour set, inclusive ranges of the three scores.
CORE_BEHAVIOURS = (
    Behaviour("Champions", r=(4, 5), f=(4, 5), m=(4, 5)),
    Behaviour("Loyal High Spenders", f=(4, 5), m=(4, 5)),
    Behaviour("Loyal Budget Spenders", f=(4, 5), m=(1, 3)),
    Behaviour("Loyal At Risk", r=(1, 2), f=(4, 5)),
    Behaviour("At Risk", r=(1, 2)),
)

# The long behaviour set.
DETAILED_BEHAVIOURS = (
    Behaviour("Champions", r=(4, 5), f=(4, 5), m=(4, 5)),
    Behaviour("Loyal High Spenders", r=(1, 3), f=(4, 5), m=(4, 5)),
    Behaviour("Loyal Budget Spenders", f=(4, 5), m=(1, 3)),
    Behaviour("Big Spenders", r=(3, 5), f=(1, 3), m=(4, 5)),
    Behaviour("New High Value Customers", r=(5, 5), f=(1, 2), m=(4, 5)),
    Behaviour("New Customers", r=(5, 5), f=(1, 2), m=(1, 2)),
    Behaviour("Potential Loyalists", r=(4, 5), f=(3, 3), m=(3, 3)),
    Behaviour("Promising Customers", r=(4, 4), f=(2, 2), m=(2, 2)),
    Behaviour("Loyal At Risk", r=(1, 2), f=(4, 5)),
    Behaviour("Big Spenders At Risk", r=(1, 2), m=(4, 5)),
    Behaviour("About to Churn", r=(2, 2), f=(1, 2), m=(1, 2)),
    Behaviour("Hibernating", r=(1, 1), f=(1, 2), m=(1, 2)),
    Behaviour("One-time Buyers", f=(1, 1), m=(1, 2)),
    Behaviour("Bargain Hunters", f=(3, 5), m=(1, 1)),
    Behaviour("Low Value Customers", r=(1, 3), f=(1, 2), m=(1, 2)),
)

# Tiers over the score sum.
TIERS = (
    Tier("Loyal Customers", (10, 15)),
    Tier("Potential Loyalists", (8, 9)),
    Tier("Promising Customers", (6, 7)),
    Tier("At Risk", (4, 5)),
    Tier("Hibernating", (3, 3)),
)

# Fixed value: the label when no row matches.
OTHERWISE = "Others"


SCALE = range(1, BUCKETS + 1)
HIGHEST_SUM = 3 * BUCKETS


def _first_label(table: tuple, matches: Callable[[NamedTuple], bool]) -> str:
    return next((row.label for row in table if matches(row)), OTHERWISE)


def _within(value: int, bounds: tuple[int, int]) -> bool:
    return bounds[0] <= value <= bounds[1]


def _looked_up(labels: list[str], position: Column) -> Column:
    """The label at a position. One array access per row: a long chain of conditions would grow
    the generated method beyond what the JVM compiles."""
    return F.coalesce(F.get(F.lit(labels), position), F.lit(OTHERWISE))


def _behaviour(table: tuple[Behaviour, ...]) -> Column:
    def label(r: int, f: int, m: int) -> str:
        return _first_label(
            table, lambda row: _within(r, row.r) and _within(f, row.f) and _within(m, row.m)
        )

    cells = [label(r, f, m) for r in SCALE for f in SCALE for m in SCALE]
    r, f, m = (F.col(score) - 1 for score in ("r_score", "f_score", "m_score"))
    return _looked_up(cells, (r * BUCKETS + f) * BUCKETS + m)


def core_behaviour() -> Column:
    """Six labels from the three scores."""
    return _behaviour(CORE_BEHAVIOURS)


def detailed_behaviour() -> Column:
    """Sixteen labels from the three scores."""
    return _behaviour(DETAILED_BEHAVIOURS)


def score_tier() -> Column:
    """Six labels from the score sum."""
    sums = [
        _first_label(TIERS, lambda row: _within(total, row.total))
        for total in range(HIGHEST_SUM + 1)
    ]
    return _looked_up(sums, F.col("rfm_score"))
