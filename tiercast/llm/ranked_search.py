"""Ranked lexical search: the best documents of each item, by dual-tree search.

A document's score for an item is an inner product: the item's term weights (repeats added) with
the document's term impacts. Both are non-negative integers, so the largest value per term over a
group of items and over a group of documents bounds every score between the groups.

Documents are cut into term counts once, of the terms that items have, and staged. From these follow
the numbers of documents, terms and holders of each term. A task then reads staged documents in
batches and builds a hierarchy of each: the batch, groups of ``GROUP`` neighbours by leading term,
documents; each node holds its largest impact per term. Items have a hierarchy of their own. A pair
of nodes whose bound is below the weakest k-th score among the node's items is left, with all below
it; equal bounds are followed, since ties are decided by ``doc_id``. Scores of the pairs that remain
are exact. K-th scores start from a first search of a share of the documents and rise within each
task, which returns its best documents per item; these are merged by item in two steps.

Items are searched in blocks of bounded size, one after another, each against all documents.

Results for odd input: an item without a term, or whose terms no document has, has no rows; a
missing ``doc_id`` comes after all others of its score; rows that repeat an ``item_id`` or a
``doc_id`` are rows of their own, so such items have their ranks each; a missing text has no
terms; empty tables give an empty table; other columns do not matter.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from tiercast.llm.common import in_arrow, slices
from tiercast.operators.scratch import Scratch

# Fixed value of the contract.
TOP = 20

# Items of one block, and the bytes of their texts.
BLOCK_ITEMS, BLOCK_BYTES = 512, 4 << 20
# Numbers in one matrix of impacts, and documents below one node.
CELLS, GROUP = 1 << 22, 32
# Items below one node.
ITEM_GROUP = 8
# One document in so many is searched first, for the k-th scores to start from.
FIRST_SHARE = 32
# Sums below this are exact in doubles.
EXACT = 1 << 53
# Documents that one task searches.
TASK_DOCS = 8192
# Parts of an item's rows that are merged by themselves first.
MERGE_PARTS = 64

_SPACE, _CASE = 32, 32
# Bytes of terms: digits, letters (A-Z in lower case), and all beyond ASCII; others are space.
_TERM_BYTES = bytes(
    c + _CASE if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else _SPACE
    for c in range(256)
)


def terms(text: str | None) -> list[bytes]:
    """The terms of a text, in order."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split()


class Corpus(NamedTuple):
    """Numbers of the documents with a term, of all their terms, and of the holders of each term."""

    documents: int
    length: int
    holders: np.ndarray


class Items(NamedTuple):
    """A block of items: their ids, and per item the count of each of the block's terms."""

    ids: list
    vocabulary: dict[bytes, int]
    counts: np.ndarray


def item_blocks(items: DataFrame) -> Iterator[Items]:
    """The items in blocks; the driver holds one block at a time."""
    rows, size = [], 0
    for row in items.select("item_id", "text").toLocalIterator():
        rows.append(row)
        size += len(row.text or "")
        if len(rows) >= BLOCK_ITEMS or size >= BLOCK_BYTES:
            yield _block(rows)
            rows, size = [], 0
    if rows:
        yield _block(rows)


def _block(rows: list) -> Items:
    found = [Counter(terms(row.text)) for row in rows]
    vocabulary = {term: i for i, term in enumerate(sorted(set().union(*found)))}
    counts = np.zeros((len(rows), len(vocabulary)), np.int64)
    for i, of in enumerate(found):
        for term, n in of.items():
            counts[i, vocabulary[term]] = n
    return Items([row.item_id for row in rows], vocabulary, counts)


def _counted(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``(doc_id, n, terms, counts)``: length and the block's terms of each document with a term."""
    narrow = docs.select("doc_id", "text")
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = known.value
        for part, texts in slices(batches, "text"):
            found = [terms(text) for text in texts]
            held = [Counter(filter(number.__contains__, of)) for of in found]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array([len(of) for of in found], pa.int64()),
                    pa.array([[number[term] for term in of] for of in held], pa.list_(pa.int32())),
                    pa.array([list(of.values()) for of in held], pa.list_(pa.int64())),
                ],
                ["doc_id", "n", "terms", "counts"],
            )

    kind = narrow.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n long, terms array<int>, counts array<long>"
    return in_arrow(narrow, count, schema).where(F.col("n") > 0)


def _corpus(counted: DataFrame, size: int) -> Corpus:
    whole = counted.agg(F.count("*").alias("documents"), F.sum("n").alias("length")).first()
    # One row per term of the block.
    held = counted.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()
    holders = np.zeros(size, np.int64)
    holders[held["term"].to_numpy()] = held["count"].to_numpy()
    return Corpus(whole.documents, whole.length or 0, holders)


def term_weights(corpus: Corpus) -> np.ndarray:
    return np.array(
        [
            math.floor(1000 * math.log((2 * corpus.documents + 2) / (2 * held + 1)))
            for held in corpus.holders.tolist()
        ],
        np.int64,
    )


def impacts(counts: np.ndarray, lengths: np.ndarray, corpus: Corpus) -> np.ndarray:
    """What one unit of a term's weight adds to the score of a document."""
    m = 75 + (25 * lengths * corpus.documents) // corpus.length
    return (1_000_000_000 * counts) // (1000 * counts + 12 * m)


class Node(NamedTuple):
    """Items ``start`` to ``end`` in tree order, and their largest weight per term."""

    start: int
    end: int
    largest: np.ndarray
    children: tuple


class ItemTree(NamedTuple):
    order: np.ndarray
    # In tree order.
    weights: np.ndarray
    root: Node


def item_tree(weights: np.ndarray) -> ItemTree:
    """A hierarchy over items whose neighbours share leading terms."""
    leading = np.argsort(-weights, axis=1, kind="stable")[:, :3]
    order = np.lexsort(leading.T[::-1]) if leading.shape[1] else np.arange(len(weights))
    ordered = weights[order]

    def node(start: int, end: int) -> Node:
        children = ()
        if end - start > ITEM_GROUP:
            step = max(ITEM_GROUP, -(-(end - start) // ITEM_GROUP))
            children = tuple(node(i, min(i + step, end)) for i in range(start, end, step))
        return Node(start, end, ordered[start:end].max(axis=0), children)

    return ItemTree(order, ordered, node(0, len(order)))


class Best:
    """The best documents per item found so far, and the scores that others have to reach."""

    def __init__(self, least: np.ndarray, top: int) -> None:
        # A score of 0 is no match.
        self.least = np.maximum(least, 1)
        self.top = top
        self.found: list[list[tuple]] = [[] for _ in least]

    def add(self, item: int, scores: np.ndarray, ids: list) -> None:
        """Scores and ids of documents that reach ``least``."""
        # A missing id comes after all others.
        more = [(-score, i is None, 0 if i is None else i) for score, i in zip(scores.tolist(), ids)]
        kept = sorted(self.found[item] + more)[: self.top]
        self.found[item] = kept
        if len(kept) == self.top:
            self.least[item] = max(self.least[item], -kept[-1][0])


def search_batch(tree: ItemTree, best: Best, matrix: np.ndarray, ids: list) -> int:
    """Meet all items with the documents of a matrix of impacts; returns the scores computed."""
    groups = [matrix[i : i + GROUP].max(axis=0) for i in range(0, len(matrix), GROUP)]
    largest, scored = np.array(groups), 0
    # The pair of the two roots, then items and groups in turn.
    pending = [(tree.root, np.arange(len(groups)))]
    if (tree.root.largest @ largest.max(axis=0)) < best.least.min():
        return 0
    while pending:
        node, near = pending.pop()
        bounds = largest[near] @ node.largest
        near = near[bounds >= best.least[node.start : node.end].min()]
        if not len(near):
            continue
        if node.children:
            pending += [(child, near) for child in node.children]
            continue
        for item in range(node.start, node.end):
            own = near[largest[near] @ tree.weights[item] >= best.least[item]]
            if not len(own):
                continue
            rows = (own[:, None] * GROUP + np.arange(GROUP)).ravel()
            rows = rows[rows < len(matrix)]
            scores = matrix[rows] @ tree.weights[item]
            scored += len(rows)
            good = scores >= best.least[item]
            if good.any():
                best.add(item, scores[good].astype(np.int64), [ids[i] for i in rows[good]])
    return scored


def _matrices(
    batches: Iterable[pa.RecordBatch], tree: ItemTree, corpus: Corpus
) -> Iterator[tuple[np.ndarray, list]]:
    """Impacts of documents, over the terms that items weigh, neighbours by leading term together."""
    exact = tree.weights.sum(axis=1).max(initial=0) * 1_000_000 < EXACT
    size = tree.weights.shape[1]
    step = max(GROUP, CELLS // max(size, 1) // GROUP * GROUP)
    largest = tree.root.largest
    for whole in batches:
        for start in range(0, whole.num_rows, step):
            batch = whole.slice(start, step)
            lists = batch.column("terms")
            held = np.diff(lists.offsets.to_numpy())
            row = np.repeat(np.arange(batch.num_rows), held)
            term = lists.flatten().to_numpy()
            count = batch.column("counts").flatten().to_numpy()
            impact = impacts(count, batch.column("n").to_numpy()[row], corpus)
            matrix = np.zeros((batch.num_rows, size), np.float64 if exact else np.int64)
            matrix[row, term] = impact
            leading = (matrix * largest).argmax(axis=1) if size else np.zeros(batch.num_rows, int)
            order = np.lexsort((-matrix[np.arange(batch.num_rows), leading], leading))
            ids = batch.column("doc_id").to_pylist()
            yield matrix[order], [ids[i] for i in order]


def _searched(
    counted: DataFrame, tree: ItemTree, corpus: Corpus, least: np.ndarray, top: int
) -> DataFrame:
    """``(place, doc_id, score)``: the best documents of each task per item, in tree order."""
    shared = counted.sparkSession.sparkContext.broadcast((tree, corpus, least))
    kind = counted.schema["doc_id"].dataType.simpleString()
    id_type = to_arrow_type(counted.schema["doc_id"].dataType)

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, corpus, least = shared.value
        dtype = np.float64 if tree.weights.sum(axis=1).max(initial=0) * 1_000_000 < EXACT else np.int64
        typed = tree._replace(weights=tree.weights.astype(dtype))
        best = Best(least, top)
        for matrix, ids in _matrices(batches, typed, corpus):
            search_batch(typed, best, matrix, ids)
        rows = [(i, *of) for i, found in enumerate(best.found) for of in found]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([row[0] for row in rows], pa.int32()),
                pa.array([None if row[2] else row[3] for row in rows], id_type),
                pa.array([-row[1] for row in rows], pa.int64()),
            ],
            ["place", "doc_id", "score"],
        )

    return in_arrow(counted, search, f"place int, doc_id {kind}, score long")


def _merged(found: DataFrame, top: int) -> DataFrame:
    """The best of all tasks. Parts of an item's rows are ranked first, so no task gets more of them
    than its share."""
    best = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    part = F.pmod(F.xxhash64("doc_id", "score"), MERGE_PARTS)
    for keys in ([F.col("place"), part], [F.col("place")]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*best))
        found = found.withColumn("rank", rank).where(F.col("rank") <= top)
    return found


def _search_block(
    docs: DataFrame, block: Items, top: int, scratch: Scratch, name: str
) -> tuple[DataFrame, list[tuple]]:
    """``(place, rank, doc_id, score)``, staged, and the places of the item ids."""
    counted = scratch.stage(_counted(docs, block.vocabulary), f"{name}-counted")
    corpus = _corpus(counted, len(block.vocabulary))
    weights = block.counts * term_weights(corpus) if corpus.documents else block.counts * 0
    tree = item_tree(weights)
    # By documents, since their counts are small and the work for each is not.
    useful = counted.where(F.size("terms") > 0).repartition(corpus.documents // TASK_DOCS + 1)
    # The k-th score among some documents is one that the k-th of all reaches.
    least = np.zeros(len(block.ids), np.int64)
    share = F.pmod(F.xxhash64("doc_id", "n"), FIRST_SHARE) == 0
    first = _merged(_searched(useful.where(share), tree, corpus, least, top), top)
    for row in first.where(F.col("rank") == top).collect():
        least[row.place] = row.score
    found = _merged(_searched(useful, tree, corpus, least, top), top)
    numbered = [(place, block.ids[item]) for place, item in enumerate(tree.order.tolist())]
    return scratch.stage(found, f"{name}-found"), numbered


def ranked_documents(
    docs: DataFrame, items: DataFrame, top: int = TOP, scratch: Scratch | None = None
) -> DataFrame:
    """``item_id, rank, doc_id, score``: up to ``top`` documents per item with a score above 0."""
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark)
    kind = items.schema["item_id"].dataType.simpleString()
    parts = []
    for number, block in enumerate(item_blocks(items)):
        found, ids = _search_block(docs, block, top, scratch, f"block-{number}")
        # One row per item of the block.
        names = spark.createDataFrame(ids, f"place int, item_id {kind}")
        parts.append(
            found.join(F.broadcast(names), "place").select("item_id", "rank", "doc_id", "score")
        )
    if not parts:
        doc_kind = docs.schema["doc_id"].dataType.simpleString()
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id {doc_kind}, score long")
    return reduce(DataFrame.unionAll, parts)
