"""Hard negatives: vectors of other labels that score almost as high as an anchor's positives.

Scores are integer inner products of vectors scaled to whole components. The anchors of a block are
joined to a spanning tree of least total distance. For a vector c and an anchor a below its parent p,
a·c differs from p·c by at most |a - p| |c|, so the parent's score, or the range it is known to lie
in, gives a range for the child's. Only vectors whose range reaches an anchor's window are scored
anew. For the positives the window begins at the anchor's weakest best score so far; for the
negatives of a positive it ends at that one's score and begins at ``NEAR`` of it, or at the weakest
best score within.

A block of anchors meets all vectors in one pass for its positives and one for its negatives; the
blocks follow one another, so the driver and a task hold one block. Each task returns its best rows
per anchor (and positive); these are merged in two steps.

Components count as 64-bit floats times ``SCALE``, rounded down. Where products could leave the whole
numbers that doubles hold, they are taken in Python's integers; a score beyond 64 bits is returned
as the nearest that fits.

Results for odd input: rows without a label or a vector, or with a missing or non-finite component,
take no part; vectors of different lengths have no score; empty vectors score 0 with each other; a
missing ``vec_id`` is no anchor and comes after all others of its score; rows that repeat a
``vec_id`` are rows of their own; an anchor without positives, and a positive without negatives,
have no rows; an empty table gives an empty table; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from tiercast.llm.common import in_arrow, numbered
from tiercast.operators.scratch import Scratch

# Fixed values of the contract.
SCALE = 256
POSITIVES = NEGATIVES = 5
# A negative's score is at least so many hundredths of the positive's.
NEAR = 80

BLOCK = 1024
# Vectors that meet a block at a time.
STEP = 2048
EXACT = 1 << 53
MERGE_PARTS = 16


class Anchors(NamedTuple):
    """A block: row numbers, labels, scaled vectors, and the tree.

    ``levels``: per depth the anchors there, their parents, and their distances from these.
    """

    rows: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]


def spanning_tree(vectors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The levels of a spanning tree of least total distance, grown from the first vector."""
    points = vectors.astype(np.float64)
    n = len(points)
    parent, depth = np.zeros(n, np.int64), np.zeros(n, np.int64)
    near = np.linalg.norm(points - points[0], axis=1)
    distance, outside = np.zeros(n), np.ones(n, bool)
    outside[0] = False
    for _ in range(n - 1):
        new = int(np.where(outside, near, np.inf).argmin())
        if not outside[new]:
            # Distances beyond doubles: any vertex will do.
            new = int(outside.argmax())
        outside[new] = False
        depth[new], distance[new] = depth[parent[new]] + 1, near[new]
        away = np.linalg.norm(points - points[new], axis=1)
        closer = outside & (away < near)
        near[closer], parent[closer] = away[closer], new
    levels = []
    for level in range(1, depth.max(initial=0) + 1):
        here = np.flatnonzero(depth == level)
        levels.append((here, parent[here], distance[here]))
    return levels


def scores_within(
    anchors: Anchors, vectors: np.ndarray, low: np.ndarray, high: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Scores (anchors x vectors), and for which pairs they are exact: at least those whose score
    lies between the anchor's ``low`` and ``high``."""
    lengths = np.linalg.norm(vectors.astype(np.float64), axis=1)
    shape = (len(anchors.rows), len(vectors))
    found = np.zeros(shape, np.result_type(anchors.vectors, vectors))
    known = np.zeros(shape, bool)
    least, most = np.empty(shape), np.empty(shape)
    found[0] = vectors @ anchors.vectors[0]
    known[0], least[0], most[0] = True, found[0], found[0]
    for here, parent, distance in anchors.levels:
        # With room for the rounding of the sums of floats.
        reach = distance[:, None] * lengths[None]
        reach = reach * (1 + 1e-9) + 1e-9 * np.maximum(np.abs(least[parent]), np.abs(most[parent])) + 1
        least[here], most[here] = least[parent] - reach, most[parent] + reach
        # A range that overflowed tells nothing.
        wanted = ~((most[here] < low[here, None]) | (least[here] > high[here, None]))
        rows, columns = wanted.any(axis=1), wanted.any(axis=0)
        if not rows.any():
            continue
        rows, columns = here[rows], np.flatnonzero(columns)
        part = np.ix_(rows, columns)
        found[part] = anchors.vectors[rows] @ vectors[columns].T
        known[part] = True
        least[part] = most[part] = found[part].astype(np.float64)
    return found, known


class Best:
    """The best vectors of each slot so far: by score, then by id, a missing id last."""

    def __init__(self, slots: int, top: int) -> None:
        self.top = top
        self.found: list[list[tuple]] = [[] for _ in range(slots)]
        self.least = np.full(slots, -np.inf)

    def add(self, slot: int, scores: np.ndarray, ids: list, rows: np.ndarray) -> None:
        if len(scores) > 4 * self.top:
            # Equal scores stay, since ids decide between them.
            kept = scores >= np.partition(scores, -self.top)[-self.top]
            scores, ids, rows = scores[kept], [i for i, k in zip(ids, kept) if k], rows[kept]
        more = [
            (-int(score), i is None, 0 if i is None else i, row)
            for score, i, row in zip(scores, ids, rows.tolist())
        ]
        self.found[slot] = sorted(self.found[slot] + more)[: self.top]
        if len(self.found[slot]) == self.top:
            self.least[slot] = float(-self.found[slot][-1][0])


def _scaled(vectors: pa.Array) -> np.ndarray:
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(flat * SCALE).reshape(len(vectors), -1)


def _whole(vectors: np.ndarray) -> np.ndarray:
    """The same numbers as Python's integers."""
    return np.frompyfunc(int, 1, 1)(vectors).astype(object)


def _met(
    batches: Iterable[pa.RecordBatch], anchors: Anchors, best: Best, windows
) -> Iterator[tuple]:
    """Let ``windows`` choose from the scores of each batch, and return what is best."""
    reach = np.abs(anchors.vectors).max(initial=0) * max(anchors.vectors.shape[1], 1)
    for whole in batches:
        for start in range(0, whole.num_rows, STEP):
            batch = whole.slice(start, STEP)
            vectors = _scaled(batch.column("embedding"))
            block = anchors
            if float(np.abs(vectors).max(initial=0)) * float(reach) >= EXACT:
                vectors = _whole(vectors)
                block = anchors._replace(vectors=_whole(anchors.vectors))
            rows = batch.column("row").to_numpy()
            labels = batch.column("label").to_numpy()
            ids = batch.column("vec_id").to_pylist()
            for slot, chosen, scores in windows(block, vectors, rows, labels):
                best.add(slot, scores, [ids[i] for i in chosen], rows[chosen])
    for slot, found in enumerate(best.found):
        for score, missing, vec_id, row in found:
            yield slot, None if missing else vec_id, row, max(min(-score, 2**63 - 1), -(2**63))


def _pass(vectors: DataFrame, shared, windows, slots: int, top: int) -> DataFrame:
    """``(slot, vec_id, row, score, rank)``: the best ``top`` rows of each slot over all vectors."""
    id_type = to_arrow_type(vectors.schema["vec_id"].dataType)

    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, *bounds = shared.value
        best = Best(slots, top)
        choose = windows(anchors, best, *bounds)
        found = list(_met(batches, anchors, best, choose))
        kinds = (pa.int32(), id_type, pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array([row[i] for row in found], kind) for i, kind in enumerate(kinds)],
            ["slot", "vec_id", "row", "score"],
        )

    kind = vectors.schema["vec_id"].dataType.simpleString()
    found = in_arrow(vectors, meet, f"slot int, vec_id {kind}, row long, score long")
    order = [F.col("score").desc(), F.col("vec_id").asc_nulls_last(), F.col("row")]
    part = F.pmod(F.xxhash64("row"), MERGE_PARTS)
    for keys in (["slot", part], ["slot"]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        found = found.withColumn("rank", rank).where(F.col("rank") <= top)
    return found


def _positive_windows(anchors: Anchors, best: Best):
    every = np.full(len(anchors.rows), np.inf)

    def choose(block: Anchors, vectors: np.ndarray, rows: np.ndarray, labels: np.ndarray):
        scores, known = scores_within(block, vectors, best.least, every)
        good = known & (block.labels[:, None] == labels) & (block.rows[:, None] != rows)
        good &= scores >= best.least[:, None]
        for anchor in np.flatnonzero(good.any(axis=1)):
            chosen = np.flatnonzero(good[anchor])
            yield anchor, chosen, scores[anchor, chosen]

    return choose


def _negative_windows(anchors: Anchors, best: Best, owner: np.ndarray, positive: np.ndarray):
    """Slots are positives: ``owner`` is the anchor of each, ``positive`` its score."""
    low, high = -(-NEAR * positive.astype(object) // 100), positive

    def choose(block: Anchors, vectors: np.ndarray, rows: np.ndarray, labels: np.ndarray):
        bottom = np.maximum(low.astype(np.float64), best.least)
        lowest, highest = np.full(len(block.rows), np.inf), np.full(len(block.rows), -np.inf)
        # Rounding to doubles must not narrow a window.
        np.minimum.at(lowest, owner, np.nextafter(bottom, -np.inf))
        np.maximum.at(highest, owner, np.nextafter(high.astype(np.float64), np.inf))
        scores, known = scores_within(block, vectors, lowest, highest)
        good = known & (block.labels[:, None] != labels)
        for slot, anchor in enumerate(owner):
            own = scores[anchor]
            inside = good[anchor] & (own >= low[slot]) & (own <= high[slot]) & (own >= best.least[slot])
            if inside.any():
                chosen = np.flatnonzero(inside)
                yield slot, chosen, own[chosen]

    return choose


def _anchor_blocks(anchors: DataFrame) -> Iterator[Anchors]:
    """Blocks of anchors of one length each; the driver holds one block at a time."""
    held, size = [], None
    for row in anchors.orderBy("size", "row").toLocalIterator():
        if held and (row["size"] != size or len(held) == BLOCK):
            yield _block(held)
            held = []
        size = row["size"]
        held.append(row)
    if held:
        yield _block(held)


def _block(rows: list) -> Anchors:
    vectors = _scaled(pa.array([row.embedding for row in rows], pa.list_(pa.float64())))
    return Anchors(
        np.array([row.row for row in rows], np.int64),
        np.array([row.label for row in rows], np.int64),
        vectors,
        spanning_tree(vectors),
    )


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, scratch: Scratch | None = None
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    For each anchor its ``POSITIVES`` best rows of the same label, and for each of these the
    ``NEGATIVES`` best rows of other labels that score between ``NEAR`` hundredths of it and it.
    """
    spark = vectors.sparkSession
    scratch = scratch or Scratch(spark)
    finite = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    usable = vectors.where(F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)))
    rows = numbered(
        usable,
        scratch,
        "rows",
        ("vec_id",),
        label=F.col("label").cast("bigint"),
        embedding=F.col("embedding"),
        size=F.size("embedding"),
        is_anchor=F.coalesce(is_anchor, F.lit(False)),
    )
    flat = rows.select("row", "doc.vec_id", "label", "embedding", "size", "is_anchor")
    context = spark.sparkContext
    id_kind = flat.schema["vec_id"].dataType
    parts = []
    for number, block in enumerate(_anchor_blocks(flat.where("is_anchor"))):
        same_length = flat.where(F.col("size") == block.vectors.shape[1])
        near = same_length.select("row", "vec_id", "label", "embedding")
        slots = len(block.rows)
        found = _pass(near, context.broadcast((block,)), _positive_windows, slots, POSITIVES)
        # A few rows per anchor of the block.
        positives = scratch.stage(found, f"positives-{number}").orderBy("slot", "rank").collect()
        if not positives:
            continue
        owner = np.array([row.slot for row in positives], np.int64)
        score = np.array([row.score for row in positives], np.int64)
        bounds = context.broadcast((block, owner, score))
        found = _pass(near, bounds, _negative_windows, len(positives), NEGATIVES)
        negatives = scratch.stage(found, f"negatives-{number}")
        given = spark.createDataFrame(
            [
                (slot, int(block.rows[row.slot]), row.vec_id, row.score)
                for slot, row in enumerate(positives)
            ],
            T.StructType(
                [
                    T.StructField("slot", T.IntegerType()),
                    T.StructField("anchor_row", T.LongType()),
                    T.StructField("positive_id", id_kind),
                    T.StructField("positive_score", T.LongType()),
                ]
            ),
        )
        ids = flat.where("is_anchor").select(
            F.col("row").alias("anchor_row"), F.col("vec_id").alias("anchor_id")
        )
        # Both hold a few rows per anchor of the block, at most.
        named = F.broadcast(given).join(ids, "anchor_row")
        parts.append(
            negatives.join(F.broadcast(named), "slot").select(
                "anchor_id",
                "positive_id",
                "rank",
                F.col("vec_id").alias("negative_id"),
                "positive_score",
                F.col("score").alias("negative_score"),
            )
        )
    if not parts:
        kind = id_kind.simpleString()
        return spark.createDataFrame(
            [],
            f"anchor_id {kind}, positive_id {kind}, rank int, negative_id {kind},"
            " positive_score long, negative_score long",
        )
    return reduce(DataFrame.unionAll, parts)
