"""Packing documents into fixed-length sequences along a space-filling curve.

A document's token ids are hashed into a vector, the vector is projected to a few dimensions, and
the cell it falls into gets its place on a Hilbert curve. Documents are range-sorted by that place
and written one after another, so a sequence holds neighbours, that is documents with like words;
cutting the stream every ``SEQUENCE`` tokens leaves padding only at its very end.

Only ids, keys and lengths are sorted. Running sums within each range and over the ranges give each
document's place in the stream; a last join brings it to the staged token ids.

Results for odd input: a missing or empty text is the end id alone; rows without or with repeated
``doc_id`` are packed each for itself; ties on the curve follow the row number; an empty table gives
an empty table; other columns do not matter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tiercast.llm.common import in_arrow, slices
from tiercast.llm.tokens import encoder
from tiercast.operators.scratch import Scratch

SEQUENCE = 2048
HASHED, DIMENSIONS, BITS = 1024, 4, 12
# Documents whose hashed vectors are held at a time.
ROWS = 256
ROW_GROUP_BYTES = 16 << 20


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of integer cells (rows x dimensions), by Skilling's transform."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            flip = (x[i] & q) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(flip, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


def _projection() -> np.ndarray:
    return np.random.default_rng(7).standard_normal((HASHED, DIMENSIONS))


def curve_keys(ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The place on the curve of each document, from its token ids."""
    projection = _projection()
    bucket = ((ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(54)).astype(int)
    ends = np.cumsum(lengths)
    keys = []
    for start in range(0, len(lengths), ROWS):
        part = lengths[start : start + ROWS]
        first = ends[start] - lengths[start]
        owner = np.repeat(np.arange(len(part)), part)
        cells = owner * HASHED + bucket[first : first + len(owner)]
        counts = np.bincount(cells, minlength=len(part) * HASHED).reshape(len(part), HASHED)
        vectors = np.log1p(counts)
        norm = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
        place = vectors @ projection / np.maximum(norm, 1e-12)
        # Unit vectors have projections of about unit variance; tanh spreads them over the cells.
        cell = np.floor((np.tanh(place) + 1) / 2 * (1 << BITS)).astype(np.int64)
        keys.append(hilbert_keys(np.clip(cell, 0, (1 << BITS) - 1)))
    return np.concatenate([*keys, np.empty(0, np.int64)])


def _tokenised(docs: DataFrame, scratch: Scratch, tokenizer: str, end_id: int) -> DataFrame:
    """Staged ``(row, doc_id, ids, n, place)``; the ids as two bytes each."""

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches, "text"):
            ids, lengths = encoder(tokenizer).encode(texts)
            keys = curve_keys(ids, lengths)
            closed = np.insert(ids, np.cumsum(lengths), end_id)
            if closed.max(initial=0) >= 1 << 16:
                raise ValueError("the tokenizer has ids of more than two bytes")
            closed = closed.astype("<u2")
            ends = np.cumsum(lengths + 1)
            raw = closed.tobytes()
            cuts = zip((2 * (ends - lengths - 1)).tolist(), (2 * ends).tolist())
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("row"),
                    rows.column("doc_id"),
                    pa.array([raw[start:end] for start, end in cuts], pa.binary()),
                    pa.array(lengths + 1),
                    pa.array(keys),
                ],
                ["row", "doc_id", "ids", "n", "place"],
            )

    narrow = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    kind = narrow.schema["doc_id"].dataType.simpleString()
    schema = f"row long, doc_id {kind}, ids binary, n long, place long"
    return scratch.stage(in_arrow(narrow, encode, schema), "tokens", ROW_GROUP_BYTES)


def _starts(staged: DataFrame, scratch: Scratch) -> DataFrame:
    """``(row, at)``: the tokens before each document along the curve."""
    order = ["place", "row"]
    # The ranges are drawn from a sample; written once, all that follows agrees on them.
    ranged = scratch.stage(
        staged.select("row", "place", "n")
        .repartitionByRange(*order)
        .withColumn("part", F.spark_partition_id()),
        "order",
    )
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range.
    ranges = (
        ranged.groupBy("part")
        .agg(F.sum("n").alias("tokens"))
        .select("part", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("before"))
    )
    within = (
        Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = ranged.select(
        "row", "part", F.coalesce(F.sum("n").over(within), F.lit(0)).alias("inside")
    )
    return inside.join(ranges, "part").select("row", (F.col("before") + F.col("inside")).alias("at"))


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 1,
    sequence: int = SEQUENCE,
    scratch: Scratch | None = None,
) -> DataFrame:
    """All documents, cut into pieces of sequences.

    Returns per piece ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids``,
    the ids as little-endian 32-bit integers.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    staged = _tokenised(docs, scratch, tokenizer, end_id)
    placed = staged.select("row", "doc_id", "ids").join(_starts(staged, scratch), "row")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Few documents at a time, as their ids are repeated in the result.
            for first in range(0, batch.num_rows, ROWS):
                yield _pieces(batch.slice(first, ROWS), sequence)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long,"
        " sequence_id long, offset long, ids binary"
    )
    return in_arrow(placed.select("doc_id", "ids", "at"), cut, schema)


def _pieces(batch: pa.RecordBatch, sequence: int) -> pa.RecordBatch:
    raw = batch.column("ids").to_pylist()
    at = batch.column("at").to_numpy()
    total = np.fromiter((len(ids) // 2 for ids in raw), np.int64, len(raw))
    counts = (at + total - 1) // sequence - at // sequence + 1
    owner = np.repeat(np.arange(len(raw)), counts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    number = at[owner] // sequence + nth
    begin = np.maximum(number * sequence, at[owner])
    end = np.minimum((number + 1) * sequence, at[owner] + total[owner])
    start = begin - at[owner]
    ids = [
        np.frombuffer(raw[i], "<u2")[s:e].astype("<u4").tobytes()
        for i, s, e in zip(owner.tolist(), start.tolist(), (end - at[owner]).tolist())
    ]
    return pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id").take(pa.array(owner)),
            pa.array(start),
            pa.array(end - begin),
            pa.array([zlib.crc32(piece) for piece in ids], pa.int64()),
            pa.array(total[owner]),
            pa.array(number),
            pa.array(begin - number * sequence),
            pa.array(ids, pa.binary()),
        ],
        [
            "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids",
        ],
    )
