"""Near-duplicate documents by banded DartMinHash signatures.

Texts of equal words collapse to one representative first, so copies cost one row per task. The
representatives' signatures are cut into bands; texts that agree on a band share a bucket. No
bucket is expanded into pairs: the member that meets most others over all its buckets is its hub,
each other member is compared with the hub by exact weighted Jaccard similarity of their whole texts,
and links form components. In a group of near copies that is a copy with few changes, to which
most of the others link. A hub that is linked with hubs that meet more others leaves its bucket to the
first of them, and the members are compared with that one too. So a group has few hubs, and a member
few of them, where it would else have one for every few of its buckets.
Where a bucket then still holds several components, each member outside its largest one is compared
with a few members of that one in turn. What is still open meets by exact prefixes of the differences
from the hub, the units that either of the two texts lacks. Two texts differ from each other in just
the units in which one of them alone differs from the hub. Either both are so close to the hub that
they are linked with it, or they are similar only if they share differences, and then the ones that
few texts of the hub have, taken up to the number that may not be shared, have one in common. Only
members of one bucket in different components that share such a difference, and whose numbers allow
it, are compared. What the whole group has in common is in no prefix. So a pair in one bucket that is
similar enough always ends up in one component, whatever the size of the bucket; true copies need
one comparison each.

With 32 bands of 6, a pair at similarity 0.8 misses all buckets in 6 of 100,000 cases, and ones
above that less often.

Results for odd input: texts without a word link with nothing; texts of fewer words than a shingle
are one shingle; a missing ``doc_id`` sorts after all others; rows that repeat a ``doc_id`` are rows
of their own, and of equal ids one stays; an empty table gives an empty table; other columns do not
matter.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tiercast.llm import dart_minhash as darts
from tiercast.llm.common import in_arrow, numbered, slices, unpacked
from tiercast.llm.graph import components
from tiercast.operators.scratch import Scratch

LEAST_SIMILARITY = 0.8
COORDINATES, BANDS = 192, 32
# For the rounding of bounds that are compared with whole weights.
SLACK = 1e-6
# By round: how often each member outside its bucket's largest component is compared with a member of
# that one before prefixes are taken, and the number of members from which one is drawn.
DRAWS = (1, 4)
DRAWN_FROM = 8


def _signed(rows: DataFrame) -> DataFrame:
    """``(row, doc_id, high, low, bands)``: identity and band keys of the words of each text."""

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, "text"):
            sets = [darts.weighted(text) for text in texts]
            some = [i for i, (elements, _) in enumerate(sets) if len(elements)]
            keys: list[list[int] | None] = [None] * len(texts)
            marks: list[tuple[int | None, int | None]] = [(None, None)] * len(texts)
            if some:
                signature = darts.signatures([sets[i] for i in some], COORDINATES)
                for i, row in zip(some, darts.bands(signature, BANDS).tolist()):
                    keys[i], marks[i] = row, darts.fingerprint(texts[i])
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("row"),
                    part.column("doc_id"),
                    pa.array([high for high, _ in marks], pa.int64()),
                    pa.array([low for _, low in marks], pa.int64()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                ["row", "doc_id", "high", "low", "bands"],
            )

    narrow = rows.select("row", F.col("doc.doc_id").alias("doc_id"), F.col("doc.text").alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    schema = f"row long, doc_id {kind}, high long, low long, bands array<long>"
    return in_arrow(narrow, sign, schema)


def _sets(rows: DataFrame) -> DataFrame:
    """``(row, units)`` of ``(row, text)``: a hash for each unit of weight of the text's shingles.

    The n-th occurrence of a shingle is a unit of its own, so the plain Jaccard similarity of these
    sets is the weighted one of the texts.
    """

    def hash_units(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, "text"):
            units = [darts.units(*darts.weighted(text)).view("int64") for text in texts]
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), pa.array(units, pa.list_(pa.int64()))], ["row", "units"]
            )

    return in_arrow(rows.select("row", "text"), hash_units, "row long, units array<long>")


def _verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs ``(a, b)`` whose texts are similar enough."""
    left = sets.select(F.col("row").alias("a"), F.col("units").alias("left"))
    right = sets.select(F.col("row").alias("b"), F.col("units").alias("right"))
    shared = F.size(F.array_intersect("left", "right"))
    union = F.greatest(F.size("left") + F.size("right") - shared, F.lit(1))
    joined = pairs.join(left, "a").join(right, "b")
    return joined.where(shared / union >= least).select("a", "b")


def _links(
    entries: DataFrame, same: DataFrame, rows: DataFrame, least: float, scratch: Scratch
) -> DataFrame | None:
    """``(node, root)`` of the representatives that have links.

    ``entries``: staged ``(band, key, hub, met, rep)`` of the buckets with several members, with the
    number of others that the hub meets; ``same``: the representatives with all their band keys.
    """
    tested = scratch.stage(_with_hubs(entries), "pairs-hubs")
    if tested.isEmpty():
        return None
    # Only texts in some bucket with others are ever compared.
    candidates = scratch.stage(entries.select(F.col("rep").alias("row")).distinct(), "candidates")
    # The same join at any size, so that its cost is in proportion.
    texts = rows.select("row", F.col("doc.text").alias("text")).join(candidates.hint("merge"), "row")
    sets = scratch.stage(_sets(texts), "sets")
    found = scratch.stage(_verified(tested, sets, least), "links-hubs")
    entries = _led(entries, found, scratch)
    pairs = scratch.stage(_with_hubs(entries).join(tested, ["a", "b"], "left_anti"), "pairs-0")
    found, tested = found.unionAll(_verified(pairs, sets, least)), tested.unionAll(pairs)
    rooted, step = None, 0
    while True:
        found = scratch.stage(found, f"links-{step}")
        if rooted is None or not found.isEmpty():
            if rooted is not None:
                found = found.unionAll(
                    rooted.select(F.col("node").alias("a"), F.col("root").alias("b"))
                )
            rooted = components(found, scratch, f"components-{step}")
            rooted = scratch.stage(rooted, f"rooted-{step}")
        if step > len(DRAWS):
            return rooted
        open_ = _open_buckets(entries, rooted, scratch, f"open-{step}")
        if open_ is None:
            return rooted
        step += 1
        if step <= len(DRAWS):
            met = _drawn(open_, DRAWS[step - 1], step)
        else:
            met = _prefix_pairs(open_, same, sets, least, scratch)
        pairs = scratch.stage(met.join(tested, ["a", "b"], "left_anti"), f"pairs-{step}")
        found, tested = _verified(pairs, sets, least), tested.unionAll(pairs)


def _with_hubs(entries: DataFrame) -> DataFrame:
    """``(a, b)``: each member of a bucket with its hub."""
    return (
        entries.where(F.col("rep") != F.col("hub"))
        .select(F.greatest("rep", "hub").alias("a"), F.least("rep", "hub").alias("b"))
        .distinct()
    )


def _led(entries: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """``(band, key, rep, hub)``: the entries, each bucket's hub replaced by the one that meets most
    others of the hubs of other buckets with which it is linked."""
    first = F.min(F.struct((-F.col("met")).alias("order"), "hub"))
    linked = entries.withColumns({"a": F.greatest("rep", "hub"), "b": F.least("rep", "hub")})
    leads = (
        linked.join(links, ["a", "b"], "left_semi")
        .groupBy(F.col("rep").alias("hub"))
        .agg(first.alias("first"))
        .select("hub", F.col("first.hub").alias("lead"))
    )
    # A hub has one bucket per band at most.
    hubs = (
        entries.where(F.col("rep") == F.col("hub"))
        .join(leads, "hub", "left")
        .select("band", "key", F.coalesce("lead", "hub").alias("hub"))
    )
    members = entries.select("band", "key", "rep")
    return scratch.stage(members.join(scratch.stage(hubs, "leads"), ["band", "key"]), "led")


def _open_buckets(
    entries: DataFrame, rooted: DataFrame, scratch: Scratch, name: str
) -> DataFrame | None:
    """``(band, key, rep, component, largest, in_largest)`` of the buckets that hold several
    components: each member's, the largest one of the bucket and its size."""
    placed = entries.join(rooted, F.col("rep") == F.col("node"), "left").select(
        *entries.columns, F.coalesce("root", "rep").alias("component")
    )
    buckets = scratch.stage(
        placed.groupBy("band", "key", "component")
        .agg(F.count("*").alias("members"))
        .groupBy("band", "key")
        .agg(
            F.count("*").alias("n_components"),
            F.max(F.struct("members", "component")).alias("first"),
        )
        .where(F.col("n_components") > 1)
        .select(
            "band",
            "key",
            F.col("first.component").alias("largest"),
            F.col("first.members").alias("in_largest"),
        ),
        f"{name}-buckets",
    )
    if buckets.isEmpty():
        return None
    return scratch.stage(placed.join(buckets, ["band", "key"]), name)


def _drawn(open_: DataFrame, draws: int, step: int) -> DataFrame:
    """``(a, b)``: each member outside the largest component of a bucket, with some of that one,
    drawn by hashes."""
    parts = F.ceil(F.col("in_largest") / DRAWN_FROM)

    def part(draw: Column) -> Column:
        return F.pmod(F.xxhash64("rep", F.lit(step), draw), parts)

    hubs = (
        open_.where(F.col("component") == F.col("largest"))
        .groupBy("band", "key", part(F.lit(0)).alias("part"))
        .agg(F.min("rep").alias("hub"))
    )
    # Buckets of one largest component are alike, so a member draws in the widest of them.
    widest = F.max(F.struct("in_largest", "band", "key")).alias("widest")
    outside = (
        open_.where(F.col("component") != F.col("largest"))
        .groupBy("rep", "largest")
        .agg(widest)
        .select("rep", "widest.*")
        .withColumn(
            "part",
            F.explode(F.array_distinct(F.array(*[part(F.lit(i)) for i in range(1, draws + 1)]))),
        )
    )
    return (
        outside.join(hubs, ["band", "key", "part"])
        .select(F.greatest("rep", "hub").alias("a"), F.least("rep", "hub").alias("b"))
        .distinct()
    )


def _prefixes(open_: DataFrame, sets: DataFrame, least: float, scratch: Scratch) -> DataFrame:
    """``(hub, rep, unit, total, hub_total, differing, before)``: of each open text and each of its hubs
    the units that one of the two lacks, those in which few open texts differ from that hub first, up
    to the number in which a similar text may not differ from it and one more, and how many come
    before; those in which no other differs come first of all and are left out."""
    text = sets.select(F.col("row").alias("rep"), F.col("units").alias("left"))
    hub = sets.select(F.col("row").alias("hub"), F.col("units").alias("right"))
    differing = F.concat(F.array_except("left", "right"), F.array_except("right", "left"))
    units = scratch.stage(
        open_.select("hub", "rep")
        .distinct()
        .join(text, "rep")
        .join(hub, "hub")
        .select(
            "hub",
            "rep",
            F.size("left").alias("total"),
            F.size("right").alias("hub_total"),
            differing.alias("units"),
        )
        .select(
            *["hub", "rep", "total", "hub_total"],
            F.size("units").alias("differing"),
            F.explode("units").alias("unit"),
        ),
        "open-units",
    )
    # One row per unit; no list of holders is built.
    held = units.groupBy("hub", "unit").agg(F.count("*").alias("holders"), F.min("rep").alias("only"))
    held = scratch.stage(held, "open-holders")
    alone = (
        held.where(F.col("holders") == 1)
        .groupBy("hub", F.col("only").alias("rep"))
        .agg(F.count("*").alias("own"))
    )
    own = F.coalesce("own", F.lit(0))
    shared = (
        units.join(held.where(F.col("holders") > 1).select("hub", "unit", "holders"), ["hub", "unit"])
        .join(alone, ["hub", "rep"], "left")
        .withColumn("own", own)
        .where(_within(F.col("own"), least))
    )
    # A window holds the differences of one text.
    place = F.row_number().over(Window.partitionBy("hub", "rep").orderBy("holders", "unit"))
    return scratch.stage(
        shared.withColumn("before", F.col("own") + place - 1)
        .where(_within(F.col("before"), least))
        .select("hub", "rep", "unit", "total", "hub_total", "differing", "before"),
        "open-prefixes",
    )


def _within(units: Column, least: float) -> Column:
    """Whether a text of ``total`` units can differ in that many from a similar one, which has at
    most ``total / least``."""
    return units * least <= F.col("total") * (1 - least) + SLACK


def _prefix_pairs(
    open_: DataFrame, same: DataFrame, sets: DataFrame, least: float, scratch: Scratch
) -> DataFrame:
    """``(a, b)``: members of a bucket in different components, one of them outside the bucket's
    largest, that can be similar."""
    prefixes = _prefixes(open_, sets, least, scratch)
    outside = F.max(F.col("component") != F.col("largest"))
    members = scratch.stage(
        open_.groupBy("hub", "rep")
        .agg(F.first("component").alias("component"), outside.alias("outside"))
        .join(same.select("rep", "bands"), "rep"),
        "open-members",
    )
    # Once for both sides.
    placed = scratch.stage(prefixes.join(members, ["hub", "rep"]), "open-placed")
    # Of two texts, the one that differs less from the hub has at most half of what they differ in;
    # less still if it is linked with the hub, since the other one is not and differs by so much more.
    total, hub_total, differing = F.col("total"), F.col("hub_total"), F.col("differing")
    linked = differing * (1 + least) <= (total + hub_total) * (1 - least) - SLACK
    unshared = (2 * F.col("before") - differing) * (1 + least)
    left = placed.where(
        _within(2 * F.col("before"), least)
        & (~linked | (unshared <= (total - hub_total) * (1 - least) + SLACK))
    )
    right = placed.toDF(*[f"other_{c}" for c in placed.columns])
    less = F.struct("differing", "rep") < F.struct("other_differing", "other_rep")
    in_one_bucket = F.exists(F.zip_with("bands", "other_bands", lambda a, b: a == b), lambda same: same)
    # Of the differences that two texts share, none comes before the first; so they share no more
    # than either has from there on, and differ in the others.
    shared = F.least(
        F.col("differing") - F.col("before"), F.col("other_differing") - F.col("other_before")
    )
    apart = F.col("differing") + F.col("other_differing") - 2 * shared
    enough = apart * (1 + least) <= (F.col("total") + F.col("other_total")) * (1 - least) + SLACK
    met = left.join(
        right,
        (F.col("hub") == F.col("other_hub"))
        & (F.col("unit") == F.col("other_unit"))
        & less
        & (F.col("component") != F.col("other_component"))
        & (F.col("outside") | F.col("other_outside"))
        & enough
        & in_one_bucket,
    )
    return met.select(
        F.greatest("rep", "other_rep").alias("a"), F.least("rep", "other_rep").alias("b")
    ).distinct()


def _classes(rows: DataFrame, least: float, scratch: Scratch) -> DataFrame:
    """``(row, doc_id, class_id, class_size, first_row)`` of all rows."""
    signed = scratch.stage(_signed(rows), "signed")
    words = signed.where(F.col("high").isNotNull())
    same = scratch.stage(
        words.groupBy("high", "low").agg(F.min("row").alias("rep"), F.first("bands").alias("bands")),
        "representatives",
    )
    keyed = same.select("rep", F.posexplode("bands").alias("band", "key"))
    shared = scratch.stage(
        keyed.groupBy("band", "key").agg(F.count("*").alias("members")).where(F.col("members") > 1),
        "shared",
    )
    met = scratch.stage(keyed.join(shared, ["band", "key"]), "met")
    central = met.groupBy("rep").agg(F.sum("members").alias("met"))
    hubs = (
        met.join(central, "rep")
        .groupBy("band", "key")
        .agg(F.min(F.struct((-F.col("met")).alias("order"), "rep")).alias("first"))
        .select("band", "key", F.col("first.rep").alias("hub"), (-F.col("first.order")).alias("met"))
    )
    entries = scratch.stage(
        met.drop("members").join(scratch.stage(hubs, "hubs"), ["band", "key"]), "entries"
    )
    rooted = _links(entries, same, rows, least, scratch)

    member = words.select("row", "doc_id", "high", "low").join(
        same.select("high", "low", "rep"), ["high", "low"]
    )
    if rooted is None:
        root = F.col("rep")
    else:
        member = member.join(rooted, F.col("rep") == F.col("node"), "left")
        root = F.coalesce("root", "rep")
    wordless = signed.where(F.col("high").isNull())
    members = scratch.stage(
        member.select("row", "doc_id", root.alias("class")).unionAll(
            wordless.select("row", "doc_id", F.col("row").alias("class"))
        ),
        "members",
    )
    first = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "row"))
    classes = scratch.stage(
        members.groupBy("class")
        .agg(first.alias("first"), F.count("*").alias("class_size"))
        .select(
            "class",
            "class_size",
            F.col("first.doc_id").alias("class_id"),
            F.col("first.row").alias("first_row"),
        ),
        "classes",
    )
    return members.join(classes, "class").drop("class")


def near_duplicates(
    docs: DataFrame, least: float = LEAST_SIMILARITY, scratch: Scratch | None = None
) -> DataFrame:
    """One row per document: ``doc_id, class_id, class_size, kept``.

    ``class_id`` is the smallest ``doc_id`` that links reach.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    rows = numbered(docs, scratch, "rows", ("doc_id", "text"))
    kept = (F.col("row") == F.col("first_row")).alias("kept")
    return _classes(rows, least, scratch).select("doc_id", "class_id", "class_size", kept)


def drop_near_duplicates(
    docs: DataFrame, least: float = LEAST_SIMILARITY, scratch: Scratch | None = None
) -> DataFrame:
    """The documents, all columns, with one row of each class."""
    scratch = scratch or Scratch(docs.sparkSession)
    rows = numbered(docs, scratch, "rows")
    classes = _classes(rows, least, scratch)
    dropped = classes.where(F.col("row") != F.col("first_row")).select("row")
    return unpacked(rows.join(scratch.stage(dropped, "dropped"), "row", "left_anti"))
