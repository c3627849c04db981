"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Each source's target share of the words becomes an integer number of equal blocks: the seats go to
the highest quotients target / (2 k + 1). Within a source, documents lie in seeded order, and the
source takes that many blocks from a seeded start on, going round as often as its quota asks.
So a run is repeatable, a source meets its quota to the word, and only the two documents at the
ends of its run are cut.

Positions need no sort of a whole source: the order key starts with hex digits, a window adds up
the words within one leading part of the keys, and part totals are added up per source. Only
sums per source and part are gathered.

Results for odd input: a missing text has size 0 and takes nothing; documents without a source form
one, after all others; repeated rows count as often as they are there; an empty table gives an
empty table; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tiercast.llm.common import SPACE, WORD, numbered, whole_text
from tiercast.operators.scratch import Scratch

# Fixed values of the contract: weights by source in turn, and the most a source is repeated.
WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3

BLOCK_WORDS = 32
SEED = 17
# Hex digits of the order key that name a part: 4,096 parts per source.
PART_DIGITS = 3


def sources_and_targets(sizes: DataFrame) -> DataFrame:
    """``(source, number, source_size, target)`` from rows of ``(source, size)``.

    A source whose share by weight exceeds its cap stops there, and the rest is shared again: with
    the sources in the order of cap per weight, those before some place are capped and all others
    share what is left, so running sums find that place. The windows hold one row per source.
    """
    by_source = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    weights = F.array(*[F.lit(weight) for weight in WEIGHTS])
    cap = F.col("source_size") * MOST_REPEATS
    tight_first = Window.orderBy(
        (F.col("cap") / F.col("weight")).asc(), F.col("number").asc()
    ).rowsBetween(Window.unboundedPreceding, -1)

    def before(name: str) -> Column:
        return F.coalesce(F.sum(name).over(tight_first), F.lit(0))

    rest = F.col("total") - F.col("cap_before")
    fits = (rest * F.col("weight")).cast("double") <= (
        F.col("cap").cast("double") * F.col("weight_left")
    )
    place = F.struct("cap_before", "weight_left")
    first = F.min(F.when(fits, place)).over(everything)
    share = (F.col("total") - F.col("first.cap_before")) * F.col("weight")
    return (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("number", F.row_number().over(by_source))
        .withColumn("weight", F.element_at(weights, (F.col("number") - 1) % len(WEIGHTS) + 1))
        .withColumn("cap", cap)
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("cap_before", before("cap"))
        .withColumn("weight_left", F.sum("weight").over(everything) - before("weight"))
        .withColumn("first", first)
        .withColumn("fits", fits)
        .select(
            "source",
            "number",
            "source_size",
            F.when(F.col("fits"), share.cast("double") / F.col("first.weight_left"))
            .otherwise(F.col("cap").cast("double"))
            .alias("target"),
        )
    )


def block_quotas(targets: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Append ``blocks``, the seats of each source, to ``(number, target, ...)``.

    As many seats as whole blocks fit into all words go to the highest quotients, ties to the
    earlier source. Rounding target / block gives all seats but at most one per two sources; only
    quotients near that are ranked, a number that grows with the sources and not with the words.
    """
    everything = Window.partitionBy()
    rounded = targets.withColumns(
        {
            "near": F.floor(F.col("target") / block_words + 0.5),
            "seats": F.floor(F.sum("source_size").over(everything) / block_words),
            "reach": F.try_divide(F.col("target"), F.sum("target").over(everything))
            * (F.count(F.lit(1)).over(everything) / 2 + 2),
        }
    ).withColumn("open", F.col("seats") - F.sum("near").over(everything))
    steps = F.sequence(F.lit(1), F.ceil(F.coalesce("reach", F.lit(0.0))).cast("int") + 2)
    more = F.col("open") > 0
    # The next seat to win, or the last one won.
    seat = F.when(more, F.col("near") + F.col("step") - 1).otherwise(F.col("near") - F.col("step"))
    ranked = (
        rounded.withColumn("step", F.explode(steps))
        .withColumn("seat", seat)
        .where((F.col("open") != 0) & (F.col("seat") >= 0) & (F.col("target") > 0))
        .withColumn("quotient", F.col("target") / (2 * F.col("seat") + 1))
    )
    sign = F.when(more, -1.0).otherwise(1.0)
    order = Window.orderBy(
        (sign * F.col("quotient")).asc(), (-sign * F.col("number")).asc(), F.col("step").asc()
    )
    changed = (
        ranked.withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= F.abs("open"))
        .groupBy("number")
        .agg(F.sum(F.signum("open").cast("bigint")).alias("change"))
    )
    blocks = F.col("near") + F.coalesce("change", F.lit(0).cast("bigint"))
    return rounded.join(changed, "number", "left").select(
        *targets.columns, blocks.cast("bigint").alias("blocks")
    )


def shard_quotas(quotas: DataFrame, shards: int) -> DataFrame:
    """Each source's blocks dealt evenly over the shards of the mix: ``(source, shard, blocks)``."""

    def until(shard: Column) -> Column:
        return F.floor(F.col("blocks") * shard / shards)

    shard = F.col("shard")
    return (
        quotas.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
        .select("source", "shard", (until(shard + 1) - until(shard)).alias("blocks"))
    )


def _positions(sizes: DataFrame) -> DataFrame:
    """Append ``first``: the words before a document in its source, in seeded order."""
    part = F.substring("order_key", 1, PART_DIGITS)
    sizes = sizes.withColumn("part", part)
    order = (
        Window.partitionBy("source", "part")
        .orderBy("order_key", "doc_id", "size", "text_hash")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    earlier = (
        Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    )
    parts = (
        sizes.groupBy("source", "part")
        .agg(F.sum("size").alias("part_size"))
        .withColumn("part_first", F.coalesce(F.sum("part_size").over(earlier), F.lit(0)))
        .select(F.col("source").alias("part_source"), F.col("part").alias("of_part"), "part_first")
    )
    within = F.coalesce(F.sum("size").over(order), F.lit(0))
    joined = F.col("source").eqNullSafe(F.col("part_source")) & (
        F.col("part") == F.col("of_part")
    )
    return (
        sizes.withColumn("within", within)
        .join(parts, joined)
        .withColumn("first", F.col("part_first") + F.col("within"))
        .drop("part", "within", "part_first", "part_source", "of_part")
    )


def _overlap(start: Column, end: Column) -> Column:
    """Words of a document at [first, first + size) within [start, end)."""
    last = F.least(F.col("first") + F.col("size"), end)
    return F.greatest(last - F.greatest(F.col("first"), start), F.lit(0))


def mixed(staged: DataFrame, block_words: int, seed: int) -> DataFrame:
    """``(row, doc_id, size, source_size, target, taken, passes, cut...)`` of numbered rows."""
    sizes = staged.select(
        "row",
        F.col("doc.doc_id").alias("doc_id"),
        F.col("doc.source").alias("source"),
        "size",
        "order_key",
        "text_hash",
    )
    targets = sources_and_targets(sizes)
    words = F.least(F.col("blocks") * block_words, F.col("source_size") * MOST_REPEATS)
    turns = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce("source", F.lit(""))).cast("binary"))
    any_block = F.conv(F.substring(turns, 1, 12), 16, 10).cast("bigint") % F.greatest(
        F.ceil(F.col("source_size") / block_words), F.lit(1)
    )
    quotas = (
        block_quotas(targets, block_words)
        .withColumn("words", words)
        .select(
            F.col("source").alias("quota_source"),
            "source_size",
            "target",
            # Whole rounds over the source, and the run of words of the last round.
            F.coalesce(
                F.floor(F.try_divide("words", "source_size")), F.lit(0).cast("bigint")
            ).alias("passes"),
            F.coalesce(F.try_mod("words", "source_size"), F.lit(0).cast("bigint")).alias("run"),
            (any_block * block_words).alias("start"),
        )
    )
    end = F.col("start") + F.col("run")
    return (
        _positions(sizes)
        .join(quotas, F.col("source").eqNullSafe(F.col("quota_source")))
        .withColumn("upper", _overlap(F.col("start"), F.least(end, F.col("source_size"))))
        .withColumn("lower", _overlap(F.lit(0), end - F.col("source_size")))
        .withColumn(
            "taken", F.col("passes") * F.col("size") + F.col("upper") + F.col("lower")
        )
    )


def _staged(docs: DataFrame, scratch: Scratch, seed: int, keep: Sequence[str] | None) -> DataFrame:
    """The documents numbered, with the words of each, counted once, and its place in the order."""
    key = F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return numbered(
        docs,
        scratch,
        "sizes",
        keep,
        size=F.regexp_count(whole_text(), F.lit(WORD)).cast("bigint"),
        order_key=F.md5(key.cast("binary")),
        text_hash=F.xxhash64("text"),
    )


def mix_sources(
    docs: DataFrame,
    scratch: Scratch | None = None,
    block_words: int = BLOCK_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """What the mix takes of every document: ``doc_id, size, source_size, target, taken``."""
    scratch = scratch or Scratch(docs.sparkSession)
    staged = _staged(docs, scratch, seed, ("doc_id", "source"))
    return mixed(staged, block_words, seed).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def _excerpt(start: Column, words: Column) -> Column:
    """That run of words of the text, with the white space between them."""
    pieces = F.regexp_extract_all("text", F.lit(f"({WORD}{SPACE}|{WORD})"))
    run = F.slice(pieces, (start + 1).cast("int"), words.cast("int"))
    return F.regexp_replace(F.array_join(run, ""), SPACE + r"\z", "")


def mixed_documents(
    docs: DataFrame,
    scratch: Scratch | None = None,
    block_words: int = BLOCK_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """The mix itself: a row, with all columns, for each time a document is taken.

    Where a run begins or ends within a document, the row holds that part of its text. A column
    ``n_chars`` follows the text.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    staged = _staged(docs, scratch, seed, None)
    parts = mixed(staged, block_words, seed).where(F.col("taken") > 0)
    # Where in the document its share of the run starts; what wraps around starts at its begin.
    inside = F.greatest(F.col("start") - F.col("first"), F.lit(0))
    takes = parts.select("row", "size", "passes", "upper", "lower", inside.alias("inside"))
    text = F.col("doc.text")

    def part(words: str, start: Column) -> Column:
        return (
            F.when(F.col(words) == 0, F.array().cast("array<string>"))
            .when(F.col(words) == F.col("size"), F.array("text"))
            .otherwise(F.array(_excerpt(start, F.col(words))))
        )

    texts = F.concat(
        F.array_repeat("text", F.col("passes").cast("int")),
        part("upper", F.col("inside")),
        part("lower", F.lit(0)),
    )
    taken = (
        staged.select("row", "doc")
        .join(takes, "row")
        .withColumn("text", text)
        .withColumn("text", F.explode(texts))
    )
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("bigint")}
    return taken.select(
        *[new.get(name, F.col(f"doc.`{name}`")).alias(name) for name in docs.columns]
    )
