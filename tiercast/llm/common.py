"""Helpers that several operators share."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tiercast.operators.scratch import Scratch

# The white space of the contracts, ASCII only.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# Text that one step of a Python worker holds in its numpy arrays.
CHUNK_CHARS = 1 << 18


def whole_text(name: str = "text") -> Column:
    """The text, empty where it is missing."""
    return F.coalesce(F.col(name), F.lit(""))


def spaced_text(name: str = "text") -> Column:
    """The text with every run of white space as one space."""
    return F.regexp_replace(whole_text(name), SPACE, " ")


def packed(rows: DataFrame, keep: Sequence[str]) -> Column:
    """Those columns as one struct."""
    return F.struct(*[F.col(f"`{column}`") for column in keep])


def numbered(
    rows: DataFrame,
    scratch: Scratch,
    name: str,
    keep: Sequence[str] | None = None,
    **extra: Column,
) -> DataFrame:
    """Stage ``(row, doc, *extra)``: a unique number and the input columns as one struct, all of
    them or those of ``keep``.

    The numbers are written with the rows, so later reads agree on them however tasks are dealt
    out or repeated; missing and repeated ids are told apart by them. As a struct, the input
    columns cannot clash with an operator's own, and unused ones are not read again.
    """
    staged = rows.select(
        F.monotonically_increasing_id().alias("row"),
        packed(rows, keep or rows.columns).alias("doc"),
        *[column.alias(key) for key, column in extra.items()],
    )
    return scratch.stage(staged, name)


def unpacked(rows: DataFrame) -> DataFrame:
    """The input rows again."""
    return rows.select("doc.*")


def workers_can_import(spark: SparkSession) -> None:
    """On one machine, let Python workers import this package from where the driver has it.

    On a cluster the package is given to spark-submit with --py-files.
    """
    context = spark.sparkContext
    if context.master.startswith("local"):
        context.environment.setdefault("PYTHONPATH", _ROOT)


def in_arrow(
    frame: DataFrame,
    function: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str | StructType,
) -> DataFrame:
    """``mapInArrow`` with functions of this package."""
    workers_can_import(frame.sparkSession)
    return frame.mapInArrow(function, schema)


def slices(
    batches: Iterable[pa.RecordBatch], text: str, limit: int = CHUNK_CHARS
) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of Arrow batches with about ``limit`` bytes of text each, at least one row."""
    for batch in batches:
        lengths = pa.compute.binary_length(batch.column(text)).fill_null(0).to_pylist()
        start = size = 0
        for i, length in enumerate(lengths):
            if size and size + length > limit:
                part = batch.slice(start, i - start)
                yield part, _texts(part, text)
                start, size = i, 0
            size += length
        if start < len(lengths):
            part = batch.slice(start)
            yield part, _texts(part, text)


def _texts(part: pa.RecordBatch, name: str) -> list[str]:
    return [text or "" for text in part.column(name).to_pylist()]
