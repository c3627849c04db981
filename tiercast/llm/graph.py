"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiercast.operators.scratch import Scratch

ROWS_PER_TASK = 250_000


def components(edges: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """``(node, root)`` of every node in the bigint pairs ``(a, b)``; the root is the smallest
    node of its component.

    Large-star and small-star steps alternate until every component is a star: each node's larger
    neighbours, then its smaller ones, are linked to the smallest node it sees. A node's
    neighbours are never gathered: their minimum combines per task and comes back by a join with a
    staged table, which adaptive execution splits for a node of many edges. Each step is written,
    so lost executors repeat one step only, by as many tasks as the edges need.
    """
    pairs = edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    current, step = scratch.stage(pairs.distinct(), f"{name}-0"), 0
    tasks = -(-current.count() // ROWS_PER_TASK)

    def staged(frame: DataFrame, part: str) -> DataFrame:
        return scratch.stage(frame.coalesce(max(tasks, 1)), f"{name}-{step}{part}")

    while not _is_stars(current):
        step += 1
        both = current.unionAll(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        seen = staged(_least_seen(both), "-seen")
        larger = _linked(both.where(F.col("v") > F.col("u")), seen)
        large = staged(larger.distinct(), "-large")
        # A node keeps its own link to the least, which the others get too.
        least = staged(large.groupBy("u").agg(F.min("v").alias("v")), "-least")
        smaller = _linked(large, least.select(F.col("u").alias("of"), F.col("v").alias("least")))
        current = staged(smaller.unionAll(least).distinct(), "")
    roots = current.select(F.col("v").alias("node")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        roots.select("node", F.col("node").alias("root"))
    )


def _is_stars(pairs: DataFrame) -> bool:
    """Whether each node has one link at most, to a node that has none."""
    ends = pairs.select(F.col("u").alias("node"), F.lit(1).alias("up")).unionAll(
        pairs.select(F.col("v").alias("node"), F.lit(0).alias("up"))
    )
    links, ways = F.sum("up"), F.count_if(F.col("up") == 0)
    crossing = ends.groupBy("node").agg(links.alias("links"), ways.alias("ways"))
    return crossing.where("links > 1 or (links = 1 and ways > 0)").isEmpty()


def _least_seen(pairs: DataFrame) -> DataFrame:
    """``(of, least)``: the smallest of each u and all its v."""
    least = pairs.groupBy("u").agg(F.min("v").alias("w"))
    return least.select(F.col("u").alias("of"), F.least("u", "w").alias("least"))


def _linked(pairs: DataFrame, least: DataFrame) -> DataFrame:
    """Each v of the pairs, linked to what its u sees."""
    return (
        pairs.join(least, F.col("u") == F.col("of"))
        .where(F.col("v") != F.col("least"))
        .select(F.col("v").alias("u"), F.col("least").alias("v"))
    )
