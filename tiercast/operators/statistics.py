"""Statistics over pairs of metrics and over single metrics, as small tables.

Input is the metrics table of one run date, or of many: with ``by`` naming the date, every table has
its rows for each date, from the same passes. Counts, means and co-moments merge across tasks, so a
date costs a row per task and not a job. Missing values are skipped, pairwise for pairs.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from decimal import Decimal
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiercast.config import AUTO, DISTRIBUTED, SMALL_PLAN_BYTES, WINDOW
from tiercast.operators.quintiles import (
    MONEY_SPLIT,
    money_scale,
    stage_with_keys,
    value_parts,
)
from tiercast.operators.ranked_keys import SORT_ROWS, Key, keys_at_ranks
from tiercast.operators.scratch import Scratch, plan_bytes, plan_table

METRICS = ("recency_days", "frequency_orders", "monetary_value")
PAIRS = tuple((x, y) for i, x in enumerate(METRICS) for y in METRICS[i + 1 :])

# The histogram never has more bins, the density curve has this many points and
# reaches this many bandwidths beyond the data.
MAX_BINS = 50
GRID_POINTS = 100
GRID_MARGIN = 3
# Rows that the grid is summed in. More columns than this leaves in one would not be compiled.
GRID_PARTS = 4


def _number(metric: str) -> Column:
    return F.col(metric).cast("double")


# The columns that tell run dates apart; none for a table of one date.
By = tuple[str, ...]


def pair_measures(metrics: DataFrame, by: By = ()) -> DataFrame:
    """Count, correlation and least-squares line of each pair, from one aggregation.

    A pair without spread in one of its metrics has no correlation: r is NULL there.
    """

    def measures(x: Column, y: Column) -> dict[str, Column]:
        both = x.isNotNull() & y.isNotNull()
        spread = F.sqrt(F.var_pop(F.when(both, x))) * F.sqrt(F.var_pop(F.when(both, y)))
        r = F.try_divide(F.covar_pop(x, y), spread)
        return {
            "n": F.count_if(both),
            # Rounding may carry an exact line beyond one.
            "r": F.when(r.isNotNull(), F.greatest(F.least(r, F.lit(1.0)), F.lit(-1.0))),
            "slope": F.regr_slope(y, x),
            "intercept": F.regr_intercept(y, x),
            "r2": F.regr_r2(y, x),
        }

    found = [measures(_number(x), _number(y)) for x, y in PAIRS]
    wide = metrics.groupBy(*by).agg(
        *[column.alias(f"{name}_{i}") for i, of in enumerate(found) for name, column in of.items()]
    )
    rows = [
        F.struct(
            F.lit(x).alias("x"),
            F.lit(y).alias("y"),
            *[F.col(f"{name}_{i}").alias(name) for name in found[i]],
        )
        for i, (x, y) in enumerate(PAIRS)
    ]
    return wide.select(*by, F.inline(F.array(*rows)))


def _measured(metrics: DataFrame, by: By) -> DataFrame:
    """The pair measures, or the table itself if it holds them already."""
    return metrics if "slope" in metrics.columns else pair_measures(metrics, by)


def _hundredths(size: Column) -> Column:
    """A number in [0, 1] as whole hundredths, rounded by its binary value, ties to even.

    Twice the distance to the middle between two hundredths is taken in two parts, each of which
    doubles hold exactly, so its sign is right.
    """
    high = size.cast("float").cast("double")
    low = size - high
    below = F.floor(size * 100)
    beyond = (high * 200 - (2 * below + 1)) + low * 200
    up = (beyond > 0) | ((beyond == 0) & (below % 2 == 1))
    return (below + up.cast("int")).cast("int")


def correlation_label(r: Column) -> Column:
    """``r = 0.12``, as the value itself rounds and not its shortest decimal text."""
    parts = _hundredths(F.abs(r))
    sign = F.when(r < 0, "-").otherwise("")
    text = F.format_string("r = %s%d.%02d", sign, F.floor(parts / 100), parts % 100)
    return F.when(r.isNotNull(), text)


def metric_correlation(metrics: DataFrame, by: By = ()) -> DataFrame:
    """Pearson's r of each pair, with its two-decimal label."""
    return _measured(metrics, by).select(*by, "x", "y", "r", correlation_label(F.col("r")).alias("label"))


def _tail(from_z: Column, freedom: Column, reach: Column) -> Column:
    """Area beyond ``from_z`` under cosh(z)^-freedom, by Simpson's rule over ``reach``.

    Under no correlation, artanh(r) has this density up to a constant. The logarithm of cosh goes
    through log1p and sinh, which stays exact for the tiny z of large inputs.
    """
    steps = 4000
    width = reach / steps

    def term(i: Column) -> Column:
        half_sinh = F.sinh((from_z + i * width) / 2)
        weight = F.when(i.isin(0, steps), 1).when(i % 2 == 1, 4).otherwise(2)
        return weight * F.exp(-freedom * F.log1p(2 * half_sinh * half_sinh))

    terms = F.transform(F.sequence(F.lit(0), F.lit(steps)), term)
    return F.aggregate(terms, F.lit(0.0), lambda acc, value: acc + value) * width / 3


def metric_significance(metrics: DataFrame, by: By = ()) -> DataFrame:
    """Two-sided p-value of each pair's r against no correlation, from r and the row count."""
    measured = _measured(metrics, by).withColumns(
        {"z": F.atanh(F.abs("r")), "freedom": F.col("n").cast("double") - 2}
    )
    whole = 40 / F.sqrt("freedom")
    # Far out the density falls faster, by exp(-freedom tanh(z)) per unit.
    far = F.try_divide(F.lit(45.0), F.col("freedom") * F.tanh("z"))
    share = _tail(F.col("z"), F.col("freedom"), F.least(whole, far)) / _tail(
        F.lit(0.0), F.col("freedom"), whole
    )
    # Two rows always lie on a line; an exact line has no tail.
    p = (
        F.when(F.col("r").isNull() | (F.col("n") < 2), None)
        .when(F.col("n") == 2, 1.0)
        .when(F.abs("r") >= 1, 0.0)
        .otherwise(share)
    )
    return measured.select(*by, "x", "y", "n", "r", p.alias("p_value"))


def metric_regression(metrics: DataFrame, by: By = ()) -> DataFrame:
    """Least-squares line of each pair, y over x."""
    return _measured(metrics, by).select(*by, "x", "y", "slope", "intercept", "r2", "n")


# The metrics with few distinct values, which are counted before anything is done per value.
COUNTED = ("recency_days", "frequency_orders")


def _values_of(metrics: DataFrame, names: Sequence[str], by: By) -> DataFrame:
    """One row per metric and present value."""
    rows = [F.struct(F.lit(m).alias("metric"), _number(m).alias("value")) for m in names]
    return metrics.select(*by, F.inline(F.array(*rows))).where(F.col("value").isNotNull())


def _weighted_values(metrics: DataFrame, by: By) -> DataFrame:
    """``(*by, metric, value, weight)``: days and counts once per distinct value, money row by row."""
    values = _values_of(metrics, COUNTED, by)
    counted = values.groupBy(*by, "metric", "value").agg(F.count("*").alias("weight"))
    rest = _values_of(metrics, [m for m in METRICS if m not in COUNTED], by)
    return counted.unionAll(rest.withColumn("weight", F.lit(1).cast("bigint")))


def _per_metric(metrics: DataFrame, measures: dict, by: By) -> DataFrame:
    """One row per metric from one aggregation. ``measures`` maps a name to f(metric) -> Column."""
    wide = metrics.groupBy(*by).agg(
        *[
            measure(_number(m)).alias(f"{name}_{i}")
            for i, m in enumerate(METRICS)
            for name, measure in measures.items()
        ]
    )
    rows = [
        F.struct(F.lit(m).alias("metric"), *[F.col(f"{k}_{i}").alias(k) for k in measures])
        for i, m in enumerate(METRICS)
    ]
    return wide.select(*by, F.inline(F.array(*rows)))


def _is_small(metrics: DataFrame) -> bool:
    return plan_bytes(metrics) <= SMALL_PLAN_BYTES


EXTENT = {"n": F.count, "lo": F.min, "hi": F.max}


QUARTILES = {"q1": 0.25, "q3": 0.75}


def _between(low, high, share, when):
    """NumPy's linear interpolation, from the nearer end. ``when(test, a, b)`` chooses."""
    step = high - low
    return when(share < 0.5, low + step * share, high - step * (1 - share))


def _quartile(value: Column, share: float) -> Column:
    """From the sorted values, which one task gathers: for small inputs."""
    sorted_values = F.array_sort(F.collect_list(value))
    position = (F.size(sorted_values) - 1) * F.lit(share)
    below = F.floor(position).cast("int")

    def choose(test: Column, a: Column, b: Column) -> Column:
        return F.when(test, a).otherwise(b)

    return _between(
        F.get(sorted_values, below),
        F.get(sorted_values, F.ceil(position).cast("int")),
        position - below,
        choose,
    )


def _quartiles_by_rank(staged: DataFrame, sort_rows: int, by: By) -> DataFrame:
    """The same quartiles, from the values at the neighbouring ranks alone.

    All dates share the passes; the driver holds a few ranks per date.
    """
    (date,) = by or (None,)
    day = F.unix_date(date) if date else F.lit(0)
    scale = money_scale(staged)

    def positions(n: int) -> list[float]:
        return [share * (n - 1) for share in QUARTILES.values()]

    def ranks(n: int) -> list[int]:
        return [rank + 1 for p in positions(n) for rank in (math.floor(p), math.ceil(p))]

    # Equal values are interchangeable here, so they need no tie-breaker.
    none = F.lit(0).cast("bigint")
    levels = ("nulls", "major", "minor")
    entries = reduce(
        DataFrame.unionAll,
        [
            staged.where(F.col(m).isNotNull()).select(
                day.alias("day"),
                F.lit(i).alias("metric"),
                *[part.alias(level) for level, part in zip(levels, (none, *value_parts(m)))],
            )
            for i, m in enumerate(METRICS)
        ],
    )
    keys, totals = keys_at_ranks(entries, ranks, sort_rows, levels)

    def value_of(metric: str, key: Key) -> float:
        _, major, minor = key
        if metric == "monetary_value":
            return float(Decimal(major * MONEY_SPLIT + minor).scaleb(-scale))
        return float(minor)

    at = {(k.day, k.metric, k.rank): value_of(METRICS[k.metric], k.key) for k in keys}

    def quartile(day: int, metric: int, position: float) -> float:
        low, high = (at[day, metric, rank(position) + 1] for rank in (math.floor, math.ceil))
        share = position - math.floor(position)
        return _between(low, high, share, lambda test, a, b: a if test else b)

    rows = []
    for (day, metric), n in totals.items():
        q1, q3 = (quartile(day, metric, position) for position in positions(n))
        rows.append({"day": day, "metric": METRICS[metric], "q1": q1, "q3": q3})
    kinds = [("day", pa.int32()), ("metric", pa.string()), ("q1", pa.float64()), ("q3", pa.float64())]
    table = plan_table(staged.sparkSession, rows, pa.schema(kinds))
    dates = [F.date_from_unix_date("day").alias(date)] if date else []
    return table.select(*dates, "metric", "q1", "q3")


def metric_histogram(
    metrics: DataFrame,
    strategy: str = AUTO,
    scratch: Scratch | None = None,
    sort_rows: int = SORT_ROWS,
    by: By = (),
) -> DataFrame:
    """Density-normalised histogram of each metric, non-empty bins only.

    The bin width follows Freedman and Diaconis; without spread between the quartiles there are
    as many bins as the root of the row count.
    """
    if strategy == AUTO:
        strategy = WINDOW if _is_small(metrics) else DISTRIBUTED
    if strategy == WINDOW:
        quartiles = {
            name: lambda value, share=share: _quartile(value, share)
            for name, share in QUARTILES.items()
        }
        extent = _per_metric(metrics, {**EXTENT, **quartiles}, by)
    else:
        metrics = stage_with_keys(metrics, scratch)
        extent = _per_metric(metrics, EXTENT, by).join(
            F.broadcast(_quartiles_by_rank(metrics, sort_rows, by)), [*by, "metric"]
        )

    spread = F.col("hi") - F.col("lo")
    step = 2 * (F.col("q3") - F.col("q1")) / F.pow(F.col("n").cast("double"), F.lit(1 / 3))
    wanted = F.when(step == 0, F.floor(F.sqrt("n"))).otherwise(
        F.ceil(F.try_divide(spread, step))
    )
    binned = extent.withColumn("n_bins", F.greatest(F.least(wanted, F.lit(MAX_BINS)), F.lit(1)))
    layout = binned.withColumn("width", spread / F.col("n_bins")).select(
        *by, "metric", "n", "lo", "n_bins", "width"
    )

    # Three rows per date, one per metric.
    place = F.coalesce(F.try_divide(F.col("value") - F.col("lo"), F.col("width")), F.lit(0.0))
    counted = (
        _weighted_values(metrics, by)
        .join(F.broadcast(layout), [*by, "metric"])
        .groupBy(
            *by,
            "metric",
            F.least(F.floor(place), F.col("n_bins") - 1).cast("int").alias("bin"),
        )
        .agg(F.sum("weight").alias("n_rows"))
    )
    start = F.col("lo") + F.col("bin") * F.col("width")
    return counted.join(F.broadcast(layout), [*by, "metric"]).select(
        *by,
        "metric",
        "bin",
        start.alias("bin_start"),
        (start + F.col("width")).alias("bin_end"),
        "n_rows",
        F.try_divide(F.col("n_rows").cast("double"), F.col("n") * F.col("width")).alias("density"),
    )


def metric_density(
    metrics: DataFrame, scratch: Scratch | None = None, by: By = ()
) -> DataFrame:
    """Gaussian density curve of each metric with Scott's bandwidth, on an even grid.

    A value adds to all points of the grid, weighted by how often it occurs: recency and frequency
    have few distinct values, which are counted first. The grid is summed in ``GRID_PARTS`` rows of as
    many sums each, so a task puts out that many rows per metric and date, however many values it
    reads.
    """
    if not _is_small(metrics):
        # Read twice below.
        metrics = stage_with_keys(metrics, scratch)
    measures = {**EXTENT, "spread": F.stddev_samp}
    scale = F.col("spread") * F.pow(F.col("n").cast("double"), F.lit(-0.2))
    layout = (
        _per_metric(metrics, measures, by)
        .withColumn("h", scale)
        # A metric without spread has no curve.
        .where(F.col("h") > 0)
        .withColumn("start", F.col("lo") - GRID_MARGIN * F.col("h"))
        .withColumn("end", F.col("hi") + GRID_MARGIN * F.col("h"))
        .withColumn("step", (F.col("end") - F.col("start")) / (GRID_POINTS - 1))
        .select(*by, "metric", "n", "h", "start", "step")
    )
    each = GRID_POINTS // GRID_PARTS
    parts = layout.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(GRID_PARTS - 1))))

    def mass(i: int) -> Column:
        x = F.col("start") + (F.col("part") * each + i) * F.col("step")
        z = (x - F.col("value")) / F.col("h")
        return F.sum(F.col("weight") * F.exp(-0.5 * z * z))

    keys = [*by, "metric"]
    # A few rows per date on the right side.
    sums = (
        _weighted_values(metrics, by)
        .join(F.broadcast(parts), keys)
        .groupBy(*keys, "part")
        .agg(*[mass(i).alias(f"mass_{i}") for i in range(each)])
    )
    masses = F.array(*[F.col(f"mass_{i}") for i in range(each)])
    x = F.col("start") + F.col("point") * F.col("step")
    norm = F.col("n") * F.col("h") * math.sqrt(2 * math.pi)
    return (
        sums.select(*keys, "part", F.posexplode(masses).alias("place", "mass"))
        .withColumn("point", (F.col("part") * each + F.col("place")).cast("int"))
        .join(F.broadcast(layout), keys)
        .select(*keys, "point", x.alias("x"), (F.col("mass") / norm).alias("density"))
    )
