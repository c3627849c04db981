"""Near-duplicate vectors by spherical k-means cells and blocked cosine products.

Equal vectors of a label collapse first. Centroids come from a bounded sample (``SAMPLE`` vectors);
every vector goes to the cell of its nearest centroid. A linked partner can lie in another cell
only if the vector is close enough to the plane between both centroids: with d the unit vector
across that plane, x·d <= sqrt(1 - least²) whenever some y beyond it has a cosine of ``least`` with
x. Such vectors also visit the other cell, as guests, so no link is lost. The number of centroids is
the largest for which sample vectors visit ``MOST_VISITS`` cells in the mean: many for clustered
vectors, few for vectors without structure, where no cells could help.

Within a cell, blocks of at most about ``BLOCK`` vectors meet in matrix products of one task each.
A product gives link counts per vector and one edge per vector to the smallest vector it is
connected to in these blocks, never a list of pairs.

Results for odd input: vectors that are missing, empty, zero, or hold missing or non-finite
components, and vectors without a label, link with nothing; vectors of different lengths do not
link; a missing ``vec_id`` is no component's smallest unless alone; repeated rows are vectors of
their own; an empty table gives an empty table; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiercast.llm.common import in_arrow, numbered, workers_can_import
from tiercast.llm.graph import components
from tiercast.operators.scratch import Scratch

LEAST_COSINE = 0.93
SAMPLE = 20_000
MOST_CELLS = 256
MOST_VISITS = 3.5
ROUNDS = 8
BLOCK = 2048

PLACE = (T.StructField("cell", T.IntegerType()), T.StructField("guest", T.BooleanType()))


def _usable() -> Column:
    vector = F.col("embedding")
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    some = F.exists(vector, lambda x: x != 0)
    return F.col("label").isNotNull() & F.coalesce(finite & some, F.lit(False))


def _units(vectors: pa.Array) -> np.ndarray:
    """Vectors of one length, scaled to length one, in double precision."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    matrix = flat.reshape(len(vectors), -1)
    # Scaled by the largest component first, so that squares neither overflow nor vanish.
    matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def spherical_kmeans(units: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centroids; cells that run empty keep theirs."""
    centroids = units[np.random.default_rng(3).choice(len(units), k, replace=False)]
    for _ in range(rounds):
        nearest = (units @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, units)
        norms = np.linalg.norm(sums, axis=1)
        full = norms > 0
        centroids = centroids.copy()
        centroids[full] = sums[full] / norms[full, None]
    return centroids


def visits(units: np.ndarray, centroids: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """The home cell of each vector, and the cells of higher number it visits as a guest.

    Of two linked vectors in different cells the one in the lower cell visits the other.
    """
    likeness = units @ centroids.T
    home = likeness.argmax(axis=1)
    across = np.linalg.norm(centroids[:, None] - centroids[None], axis=2)
    depth = likeness.max(axis=1, keepdims=True) - likeness
    near = depth <= np.sqrt(1 - least * least) * across[home] + 1e-9
    return home, near & (np.arange(len(centroids)) > home[:, None])


def fit_cells(units: np.ndarray, least: float) -> np.ndarray:
    """The centroids of the largest k whose visits stay few."""
    best = spherical_kmeans(units, 1)
    k = 2
    while k <= min(MOST_CELLS, len(units) // 8):
        centroids = spherical_kmeans(units, k)
        if visits(units, centroids, least)[1].sum(axis=1).mean() > MOST_VISITS:
            break
        best, k = centroids, 2 * k
    return best


def _sample(distinct: DataFrame, n: int) -> tuple[int, np.ndarray | None]:
    """The most common vector length, and sample vectors of that length."""
    lengths = distinct.groupBy(F.size("embedding").alias("size")).count()
    first = lengths.orderBy(F.col("count").desc(), "size").first()
    if first is None:
        return 0, None
    share = min(1_000_000, max(1, n * 1_000_000 // first["count"]))
    chosen = F.pmod(F.xxhash64("rep", F.lit("sample")), 1_000_000) < share
    table = (
        distinct.where((F.size("embedding") == first["size"]) & chosen)
        .orderBy("rep")
        .select("embedding")
        .limit(2 * n)
        .toArrow()
    )
    vectors = table.column("embedding").combine_chunks()
    return first["size"], _units(vectors) if len(vectors) else None


def _placed(distinct: DataFrame, size: int, centroids: np.ndarray | None, least: float):
    """Every vector in its home cell and, as a guest, in the cells it visits."""
    schema = T.StructType([*distinct.schema, *PLACE])
    names = schema.fieldNames()
    broadcast = distinct.sparkSession.sparkContext.broadcast(centroids)

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(start, BLOCK)
                cells = [[] for _ in range(batch.num_rows)]
                home = np.zeros(batch.num_rows, np.int64)
                lengths = pa.compute.list_value_length(batch.column("embedding")).to_numpy()
                usual = np.flatnonzero(lengths == size)
                if len(usual) and broadcast.value is not None:
                    units = _units(batch.column("embedding").take(pa.array(usual)))
                    home[usual], near = visits(units, broadcast.value, least)
                    for i, row in zip(usual, near):
                        cells[i] = np.flatnonzero(row).tolist()
                counts = np.array([1 + len(c) for c in cells])
                rows = pa.array(np.repeat(np.arange(batch.num_rows), counts))
                cell = [c for h, more in zip(home.tolist(), cells) for c in (h, *more)]
                guest = [g for more in cells for g in (False, *[True] * len(more))]
                columns = [column.take(rows) for column in batch.columns]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(cell, pa.int32()), pa.array(guest)], names
                )

    return in_arrow(distinct, place, schema)


CELL = ["label", "size", "cell"]


def _blocks(placed: DataFrame, scratch: Scratch) -> DataFrame:
    """Each vector once for every product it takes part in: ``(..., left, right, is_left)``.

    Home blocks meet each other, and guest blocks, numbered -1, -2, ..., meet home blocks.
    """
    counts = scratch.stage(
        placed.groupBy(*CELL).agg(
            F.ceil(F.count_if(~F.col("guest")) / BLOCK).cast("int").alias("homes"),
            F.ceil(F.count_if("guest") / BLOCK).cast("int").alias("guests"),
        ),
        "cells",
    )
    sized = placed.join(counts, CELL)
    of_kind = F.when(F.col("guest"), F.col("guests")).otherwise(F.col("homes"))
    number = F.pmod(F.xxhash64("rep"), of_kind)
    block = F.when(F.col("guest"), -1 - number).otherwise(number).cast("int")
    homes = F.when(F.col("homes") > 0, F.sequence(F.lit(0), F.col("homes") - 1)).otherwise(
        F.array().cast("array<int>")
    )
    guests = F.when(F.col("guests") > 0, F.sequence(-F.col("guests"), F.lit(-1))).otherwise(
        F.array().cast("array<int>")
    )
    partners = F.when(F.col("guest"), homes).otherwise(F.concat(guests, homes))
    return (
        sized.withColumn("block", block)
        .withColumn("partner", F.explode(partners))
        .select(
            "rep",
            "copies",
            "embedding",
            *CELL,
            F.least("block", "partner").alias("left"),
            F.greatest("block", "partner").alias("right"),
            (F.col("block") <= F.col("partner")).alias("is_left"),
        )
    )


def _product(least: float):
    def product(table: pa.Table) -> pa.Table:
        same = table.column("left")[0].as_py() == table.column("right")[0].as_py()
        is_left = np.array(table.column("is_left").to_pylist(), bool)
        reps = table.column("rep").to_numpy()
        copies = table.column("copies").to_numpy()
        units = _units(table.column("embedding").combine_chunks())
        left = np.flatnonzero(is_left)
        right = left if same else np.flatnonzero(~is_left)
        linked = units[left] @ units[right].T >= least
        if same:
            np.fill_diagonal(linked, False)
        total = np.zeros(len(reps), np.int64)
        total[left] += linked @ copies[right]
        if not same:
            total[right] += linked.T @ copies[left]
        root = reps.copy()
        rows, columns = linked.any(axis=1), linked.any(axis=0)
        left, right, linked = left[rows], right[columns], linked[np.ix_(rows, columns)]
        changed = bool(len(left))
        while changed:
            before = root.copy()
            far = np.iinfo(np.int64).max
            root[left] = np.minimum(root[left], np.where(linked, root[right], far).min(axis=1))
            back = np.where(linked, root[left][:, None], far).min(axis=0)
            root[right] = np.minimum(root[right], back)
            changed = bool((root != before).any())
        found = total > 0
        return pa.table({"rep": reps[found], "links": total[found], "root": root[found]})

    return product


def near_vectors(
    vectors: DataFrame, least: float = LEAST_COSINE, scratch: Scratch | None = None
) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    Vectors of equal labels link at a cosine of at least ``least``; ``component_id`` is the smallest
    ``vec_id`` that links reach.
    """
    scratch = scratch or Scratch(vectors.sparkSession)
    rows = numbered(vectors, scratch, "rows", ("vec_id", "label", "embedding"), usable=_usable())
    flat = rows.select("row", "usable", "doc.*")
    usable = flat.where("usable").drop("usable")
    distinct = scratch.stage(
        usable.groupBy("label", "embedding")
        .agg(F.min("row").alias("rep"), F.count("*").alias("copies"))
        .withColumn("size", F.size("embedding")),
        "distinct",
    )
    workers_can_import(vectors.sparkSession)
    size, sample = _sample(distinct, SAMPLE)
    centroids = None if sample is None else fit_cells(sample, least)
    placed = scratch.stage(_placed(distinct, size, centroids, least), "placed")
    products = (
        _blocks(placed, scratch)
        .groupBy(*CELL, "left", "right")
        .applyInArrow(_product(least), "rep long, links long, root long")
    )
    found = scratch.stage(products, "found")
    counted = found.groupBy("rep").agg(F.sum("links").alias("links"))
    edges = found.select(F.col("rep").alias("a"), F.col("root").alias("b"))
    rooted = components(edges, scratch)

    links = F.coalesce("links", F.lit(0).cast("bigint")) + F.col("copies") - 1
    classes = scratch.stage(
        distinct.drop("size")
        .join(counted, "rep", "left")
        .join(rooted, F.col("rep") == F.col("node"), "left")
        .select(
            F.col("label").alias("of_label"),
            F.col("embedding").alias("of"),
            links.alias("n_links"),
            F.coalesce("root", "rep").alias("class"),
        ),
        "classes",
    )
    matches = (F.col("label") == F.col("of_label")) & (F.col("embedding") == F.col("of"))
    members = scratch.stage(
        usable.join(classes, matches).select("vec_id", "n_links", "class"), "members"
    )
    least_ids = scratch.stage(
        members.groupBy("class").agg(F.min("vec_id").alias("component_id")), "least-ids"
    )
    linked = members.join(least_ids, "class").select("vec_id", "n_links", "component_id")
    alone = flat.where(~F.col("usable")).select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    # A missing id stays only where no other id is reached.
    kept = F.col("vec_id").eqNullSafe(F.col("component_id"))
    return linked.unionAll(alone).withColumn("kept", kept)
