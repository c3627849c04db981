"""Exact duplicates by most-significant-digit radix partitioning.

All texts start in one group. Each level splits the groups by the next bytes of their texts; a
group that is left with one text is done, and so is a group whose texts have ended, because all
bytes agreed. Equality is decided by the bytes themselves, never by a digest.

A digit is a run of bytes whose width grows from level to level, so texts of any length need few
levels. The first level is one pass over all texts, which also numbers the rows; after it only
texts that share their beginning with another are kept at hand, and only their digits are shuffled.
Counting combines per task, so a text held by a third of all rows is one row per task there. Rows
find their group by a join with the staged group table, which adaptive execution splits where one
group is large.

Results for odd input: a missing text is empty, empty texts are equal; a missing ``doc_id`` sorts
after all others; of rows that repeat a ``doc_id`` with an equal text one stays; an empty table
gives an empty table; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiercast.llm.common import packed, spaced_text, unpacked
from tiercast.operators.scratch import Scratch

FIRST_DIGIT, GROWTH, WIDEST_DIGIT = 256, 16, 1 << 20


def _text_bytes() -> Column:
    return F.encode(spaced_text(), "UTF-8")


def _shared(rows: DataFrame, keys: list[str], width: int, number: Column) -> DataFrame:
    """The groups with several members, numbered, and whether their texts ended."""
    return (
        rows.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("members"), F.min("row").alias("row"))
        .where(F.col("members") > 1)
        .select(*keys, number.alias("group"), (F.length("digit") < width).alias("ended"))
    )


def _first_level(
    docs: DataFrame, keep: Sequence[str], scratch: Scratch, extra: dict[str, Column]
) -> DataFrame:
    """All rows, staged: ``(row, doc, group, ended, bytes, *extra)``.

    ``group`` is set where the first digit is shared, ``bytes`` where more have to be compared.
    """
    digit = F.substring(_text_bytes(), 1, FIRST_DIGIT).alias("digit")
    beginnings = docs.select(digit, F.lit(0).alias("row"))
    # Row numbers are not negative, so these differ from the groups of later levels.
    number = -1 - F.monotonically_increasing_id()
    groups = scratch.stage(
        _shared(beginnings, ["digit"], FIRST_DIGIT, number), "groups-0"
    ).withColumnRenamed("digit", "of")
    rows = docs.select(
        packed(docs, keep).alias("doc"),
        digit,
        _text_bytes().alias("bytes"),
        *[column.alias(name) for name, column in extra.items()],
    )
    # The same join at any size: most texts pass through it, none is broadcast.
    joined = rows.join(groups.hint("merge"), F.col("digit") == F.col("of"), "left")
    going_on = F.col("group").isNotNull() & ~F.col("ended")
    return scratch.stage(
        joined.select(
            F.monotonically_increasing_id().alias("row"),
            "doc",
            "group",
            "ended",
            F.when(going_on, F.col("bytes")).alias("bytes"),
            *extra,
        ),
        "rows",
    )


def _groups(staged: DataFrame, scratch: Scratch) -> DataFrame:
    """``(row, group)`` of all rows whose text is not unique."""
    finished = [staged.where("ended").select("row", "group")]
    texts = staged.where("not ended").select("row", "bytes")
    open_rows = staged.where("not ended").select("row", F.col("group").alias("parent"))
    offset, width, level = FIRST_DIGIT, FIRST_DIGIT * GROWTH, 1
    while not open_rows.isEmpty():
        digit = F.substring("bytes", offset + 1, width).alias("digit")
        if level == 1:
            rows = staged.where("not ended").select("row", F.col("group").alias("parent"), digit)
        else:
            rows = scratch.stage(
                texts.select("row", digit).join(open_rows, "row"), f"digits-{level}"
            )
        groups = scratch.stage(
            _shared(rows, ["parent", "digit"], width, F.col("row")).select(
                F.col("parent").alias("of_parent"), F.col("digit").alias("of"), "group", "ended"
            ),
            f"groups-{level}",
        )
        same = (F.col("parent") == F.col("of_parent")) & (F.col("digit") == F.col("of"))
        members = scratch.stage(
            rows.join(groups, same).select("row", "group", "ended"), f"members-{level}"
        )
        finished.append(members.where("ended").select("row", "group"))
        open_rows = members.where("not ended").select("row", F.col("group").alias("parent"))
        offset, width, level = offset + width, min(width * GROWTH, WIDEST_DIGIT), level + 1
    return reduce(DataFrame.unionAll, finished)


def _members(staged: DataFrame, scratch: Scratch) -> DataFrame:
    """``(row, keep_id, group_size, first_row)`` of all rows whose text is not unique."""
    identity = staged.where("group is not null").select("row", F.col("doc.doc_id").alias("doc_id"))
    grouped = scratch.stage(_groups(staged, scratch).join(identity, "row"), "grouped")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "row"))
    groups = scratch.stage(
        grouped.groupBy("group").agg(F.count(F.lit(1)).alias("group_size"), first.alias("first")),
        "groups",
    )
    return grouped.select("row", "group").join(groups, "group").select(
        "row",
        F.col("first.doc_id").alias("keep_id"),
        "group_size",
        F.col("first.row").alias("first_row"),
    )


def exact_groups(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """One row per document: its group of equal texts, and whether it is the one that stays.

    Returns ``doc_id, keep_id, group_size, kept, text_sha256``; the digest describes the
    normalised text and plays no part in the grouping.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    digest = {"text_sha256": F.sha2(_text_bytes(), 256)}
    staged = _first_level(docs, ["doc_id"], scratch, digest)
    members = _members(staged, scratch)
    single = F.col("first_row").isNull()
    return (
        staged.select("row", F.col("doc.doc_id").alias("doc_id"), "text_sha256")
        .join(members, "row", "left")
        .select(
            "doc_id",
            F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
            F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
            (single | (F.col("first_row") == F.col("row"))).alias("kept"),
            "text_sha256",
        )
    )


def drop_exact_duplicates(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """The documents, all columns, with one row of each group of equal texts."""
    scratch = scratch or Scratch(docs.sparkSession)
    staged = _first_level(docs, docs.columns, scratch, {})
    dropped = _members(staged, scratch).where(F.col("first_row") != F.col("row")).select("row")
    kept = staged.select("row", "doc").join(scratch.stage(dropped, "dropped"), "row", "left_anti")
    return unpacked(kept)
