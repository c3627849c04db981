"""Exact keys at given ranks of a global order, without sorting the whole input.

A quintile score needs only the keys where one bucket ends and the next begins, and an exact
quartile only the values around one position. Each pass counts rows per slot of the range that
still holds a wanted rank and keeps the slot the rank falls into; map-side counts make the shuffle
small whatever the distribution. When few rows are left around a rank, those are sorted. Ties are
narrowed by the tie-breaker in the same way, so one value held by most rows is no obstacle.

Entries are ordered by bigint columns, the levels, within the int columns ``(day, metric)``,
which Spark packs into one long join key. The levels are given by name, the most significant first.
A text can break ties after all levels: it is taken window by window of so many bytes, and a later
window is looked at only where more rows than one task may sort agree in everything before it. So one
long text costs nothing but its own bytes. The driver holds one row per wanted rank, never data.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tiercast.operators.scratch import plan_table

Key = tuple[int, ...]
Levels = tuple[str, ...]

# Rows around one rank that a single task may sort.
SORT_ROWS = 200_000
# Slots per bracket, fewer where many run dates share a pass.
MAX_SLOTS, MIN_SLOTS, SLOTS_PER_PASS = 4096, 64, 1 << 17
# Up to here bracket bounds are also given to Catalyst as literals.
LITERAL_BRACKETS = 24

GROUP = ["day", "metric"]


class RankedKey(NamedTuple):
    day: int
    metric: int
    rank: int
    key: Key
    text: str | None = None


class TextTie(NamedTuple):
    """A text column that breaks ties. ``parts(offset)`` gives the levels of the ``window`` bytes from
    that offset on, the last of them how many of these the text has."""

    column: str
    window: int
    parts: Callable[[int], dict[str, Column]]


class Bracket(NamedTuple):
    """A key range known to hold ``ranks``; ``before`` rows of the whole order precede it.

    Up to the first level where the bounds differ all rows are equal.
    """

    day: int
    metric: int
    low: Key
    high: Key
    before: int
    n_rows: int
    ranks: list[int]
    # The level split last, if any.
    split_level: int | None = None

    @property
    def open_level(self) -> int:
        differ = (i for i, (low, high) in enumerate(zip(self.low, self.high)) if low != high)
        return next(differ, len(self.low))

    @property
    def log_spaced(self) -> bool:
        """Whether to split into slots of growing width.

        A few huge values would push all others into one slot of equal width, so the first split
        of a level is log-spaced. In the narrow ranges after it, equal widths separate better.
        """
        return self.split_level != self.open_level


def _low(level: str) -> str:
    return f"{level}_lo"


def _high(level: str) -> str:
    return f"{level}_hi"


def keys_at_ranks(
    entries: DataFrame,
    ranks_for: Callable[[int], list[int]],
    sort_rows: int,
    levels: Levels,
    tie: TextTie | None = None,
) -> tuple[list[RankedKey], dict[tuple[int, int], int]]:
    """The keys at the 1-based ranks that ``ranks_for(row count)`` asks for, per day and metric,
    and those row counts.

    ``entries`` is read once per pass and has to be stable: read it from a staged table. With a tie
    it holds that column, and the levels end with those of the text's first window.
    """
    brackets = _whole_ranges(entries, ranks_for, levels)
    totals = {(b.day, b.metric): b.n_rows for b in brackets}
    return _found(entries, brackets, sort_rows, levels, tie, 0), totals


def _found(
    entries: DataFrame,
    brackets: list[Bracket],
    sort_rows: int,
    levels: Levels,
    tie: TextTie | None,
    offset: int,
) -> list[RankedKey]:
    points: list[Bracket] = []
    short: list[Bracket] = []
    while brackets:
        points += [b for b in brackets if b.open_level == len(levels)]
        rest = [b for b in brackets if b.open_level < len(levels)]
        short += [b for b in rest if b.n_rows <= sort_rows]
        long = [b for b in rest if b.n_rows > sort_rows]
        brackets = _narrow(entries, long, levels) if long else []
    if tie is None:
        found = [RankedKey(b.day, b.metric, r, b.low) for b in points for r in b.ranks]
    else:
        # Texts that end within the window are equal.
        deep = [b for b in points if b.n_rows > sort_rows and b.low[-1] == tie.window]
        short += [b for b in points if b not in deep]
        found = _deeper(entries, deep, sort_rows, levels, tie, offset) if deep else []
    return found + (_sorted_out(entries, short, levels, tie) if short else [])


def _deeper(
    entries: DataFrame,
    brackets: list[Bracket],
    sort_rows: int,
    levels: Levels,
    tie: TextTie,
    offset: int,
) -> list[RankedKey]:
    """Go on with the next window of the text, among the rows of each bracket alone."""
    offset += tie.window
    parts = tie.parts(offset)
    _, inside = _inside(entries, brackets, levels)
    rows = inside.select(
        F.col("bracket").alias("day"),
        F.lit(0).alias("metric"),
        tie.column,
        *[part.alias(name) for name, part in parts.items()],
    )
    names = tuple(parts)
    within = [
        Bracket(
            row.day,
            0,
            *_bounds(row, names),
            brackets[row.day].before,
            row.n_rows,
            brackets[row.day].ranks,
        )
        for row in rows.groupBy(*GROUP).agg(*_summary(names)).collect()
    ]
    return [
        key._replace(day=brackets[key.day].day, metric=brackets[key.day].metric, key=brackets[key.day].low)
        for key in _found(rows, within, sort_rows, names, tie, offset)
    ]


def _summary(levels: Levels) -> list[Column]:
    return [
        *[F.min(level).alias(_low(level)) for level in levels],
        *[F.max(level).alias(_high(level)) for level in levels],
        F.count(F.lit(1)).alias("n_rows"),
    ]


def _bounds(row, levels: Levels) -> tuple[Key, Key]:
    return tuple(row[_low(level)] for level in levels), tuple(row[_high(level)] for level in levels)


def _whole_ranges(
    entries: DataFrame, ranks_for: Callable[[int], list[int]], levels: Levels
) -> list[Bracket]:
    groups = entries.groupBy(*GROUP).agg(*_summary(levels)).collect()
    brackets = []
    for row in groups:
        ranks = sorted(set(ranks_for(row.n_rows)))
        brackets.append(Bracket(row.day, row.metric, *_bounds(row, levels), 0, row.n_rows, ranks))
    return brackets


def _any_of(tests: list[Column]) -> Column:
    return reduce(Column.__or__, tests)


def _holds(bracket: Bracket, levels: Levels) -> Column:
    """Whether an entry can be in the bracket, as a test on literals."""
    within = [F.col("metric") == bracket.metric]
    for level, low, high in zip(levels[: bracket.open_level + 1], bracket.low, bracket.high):
        within.append(F.col(level).between(low, high))
    return reduce(Column.__and__, within)


def _inside(
    entries: DataFrame, brackets: list[Bracket], levels: Levels
) -> tuple[DataFrame, DataFrame]:
    """The numbered brackets, and the entries that fall into them."""
    rows = []
    for number, bracket in enumerate(brackets):
        differ = [high - low for low, high in zip(bracket.low, bracket.high) if low != high]
        span = differ[0] if differ else 0
        rows.append(
            {
                "bracket": number,
                "day": bracket.day,
                "metric": bracket.metric,
                "open_level": bracket.open_level,
                "log_spaced": bracket.log_spaced,
                "span": math.log1p(span) if bracket.log_spaced else float(span),
                # A difference beyond bigint has to be taken in doubles.
                "vast": span >= 2**63,
                "before": bracket.before,
                "ranks": bracket.ranks,
                **dict(zip(map(_low, levels), bracket.low)),
                **dict(zip(map(_high, levels), bracket.high)),
            }
        )
    table = plan_table(entries.sparkSession, rows).withColumns(
        {name: F.col(name).cast("int") for name in ("bracket", "open_level", *GROUP)}
    )
    narrowed = any(bracket.split_level is not None for bracket in brackets)
    if narrowed and len(brackets) <= LITERAL_BRACKETS:
        # Drops most entries, and whole metrics, before the join sees them.
        entries = entries.where(_any_of([_holds(bracket, levels) for bracket in brackets]))
    within = [F.col(level).between(F.col(_low(level)), F.col(_high(level))) for level in levels]
    # One row per wanted rank, so the broadcast does not grow with the entries.
    return table, entries.join(F.broadcast(table), GROUP).where(reduce(Column.__and__, within))


def _slot(level: str, slots: int) -> Column:
    """Slot number, non-decreasing in the key; the ends of the range never share a slot."""
    here, low = F.col(level), F.col(_low(level))
    rough = here.cast("double") - low.cast("double")
    offset = F.when(F.col("vast"), rough).otherwise((here - low).cast("double"))
    distance = F.when(F.col("log_spaced"), F.log1p(offset)).otherwise(offset)
    share = distance / F.col("span")
    return F.least(F.floor(share * slots).cast("int"), F.lit(slots - 1))


def _narrow(entries: DataFrame, brackets: list[Bracket], levels: Levels) -> list[Bracket]:
    """Replace each bracket by the slots that hold its ranks."""
    slots = max(MIN_SLOTS, min(MAX_SLOTS, SLOTS_PER_PASS // len(brackets)))
    table, inside = _inside(entries, brackets, levels)
    slot = reduce(
        lambda cases, i: cases.when(F.col("open_level") == i, _slot(levels[i], slots)),
        sorted({b.open_level for b in brackets}),
        F,
    )
    counted = inside.groupBy("bracket", slot.alias("slot")).agg(*_summary(levels))

    earlier = (
        Window.partitionBy("bracket")
        .orderBy("slot")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.col("before") + F.coalesce(F.sum("n_rows").over(earlier), F.lit(0))
    wanted = F.filter(
        "ranks",
        lambda rank: (rank > F.col("before")) & (rank <= F.col("before") + F.col("n_rows")),
    )
    owners = table.select("bracket", *GROUP, "open_level", "before", "ranks")
    kept = (
        counted.join(F.broadcast(owners), "bracket")
        .withColumn("before", before)
        .withColumn("ranks", wanted)
        .where(F.size("ranks") > 0)
    )
    return [
        Bracket(
            row.day,
            row.metric,
            *_bounds(row, levels),
            row.before,
            row.n_rows,
            row.ranks,
            row.open_level,
        )
        for row in kept.collect()
    ]


def _sorted_out(
    entries: DataFrame, brackets: list[Bracket], levels: Levels, tie: TextTie | None
) -> list[RankedKey]:
    _, inside = _inside(entries, brackets, levels)
    texts = [tie.column] if tie else []
    order = Window.partitionBy("bracket").orderBy(*levels, *texts)
    ranked = (
        inside.withColumn("rank", F.col("before") + F.row_number().over(order))
        .where(F.array_contains("ranks", F.col("rank")))
        .select(*GROUP, "rank", *levels, *texts)
    )
    return [
        RankedKey(
            row.day,
            row.metric,
            row.rank,
            tuple(row[level] for level in levels),
            row[tie.column] if tie else None,
        )
        for row in ranked.collect()
    ]
