import heapq
import random
import re

import pytest
from odd import documents, nothing
from pyspark.sql import functions as F

from tiercast.llm import mixing


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(sizes):
    """Share by weight, cap, and share the excess again until none is above its cap."""
    names = sorted(sizes, key=lambda name: (name is None, name or ""))
    weight = {name: (5, 2, 1)[i % 3] for i, name in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[name] for name in capped)
        rest = sum(weight[name] for name in names if name not in capped)
        share = {
            name: 3 * sizes[name] if name in capped else left * weight[name] / rest
            for name in names
        }
        over = {name for name in names if name not in capped and share[name] > 3 * sizes[name]}
        if not over:
            return share
        capped |= over


def brute_seats(targets, seats):
    """One seat after the other to the highest quotient."""
    won = dict.fromkeys(targets, 0)
    order = {name: i for i, name in enumerate(targets)}
    queue = [(-target, order[name], name) for name, target in targets.items() if target > 0]
    heapq.heapify(queue)
    for _ in range(seats if queue else 0):
        _, place, name = heapq.heappop(queue)
        won[name] += 1
        heapq.heappush(queue, (-targets[name] / (2 * won[name] + 1), place, name))
    return won


@pytest.mark.parametrize("seed", range(6))
def test_targets_and_seats_equal_brute_force(spark, seed):
    random.seed(seed)
    count = random.choice((1, 2, 7, 40))
    sizes = {f"s{i:02}": int(10 ** random.uniform(0, 6)) for i in range(count)}
    if seed % 2:
        sizes[None] = 12345
    frame = spark.createDataFrame(list(sizes.items()), "source string, size long")
    targets = mixing.sources_and_targets(frame)
    expected = brute_targets(sizes)
    found = {row.source: row.target for row in targets.collect()}
    assert found == pytest.approx(expected, rel=1e-12)
    in_order = {row.source: row.target for row in targets.orderBy("number").collect()}
    for block in (1, 7, 64):
        seats = sum(sizes.values()) // block
        if seats > 400_000:
            continue
        quotas = mixing.block_quotas(targets, block)
        blocks = {row.source: row.blocks for row in quotas.collect()}
        assert blocks == brute_seats(in_order, seats)


def test_shards_share_a_quota(spark):
    quotas = spark.createDataFrame([("a", 10), ("b", 3), ("c", 0)], "source string, blocks long")
    rows = mixing.shard_quotas(quotas, 4).collect()
    for source, blocks in (("a", 10), ("b", 3), ("c", 0)):
        parts = [row.blocks for row in rows if row.source == source]
        assert len(parts) == 4 and sum(parts) == blocks and max(parts) - min(parts) <= 1


def test_odd_rows(spark):
    frame = documents(spark)
    rows = mixing.mix_sources(frame).collect()
    given = frame.select("doc_id", "text", "source").collect()
    assert sorted((r.doc_id, r.size) for r in rows if r.doc_id is not None) == sorted(
        (r.doc_id, size(r.text)) for r in given if r.doc_id is not None
    )
    assert len(rows) == len(given)
    sizes = {}
    for row in given:
        sizes[row.source] = sizes.get(row.source, 0) + size(row.text)
    targets = brute_targets(sizes)
    # Small sources may share a target, so compare the multisets.
    assert sorted({round(r.target, 6) for r in rows}) == sorted(
        {round(t, 6) for t in targets.values()}
    )
    assert all(0 <= r.taken <= 3 * r.size for r in rows)
    again = mixing.mix_sources(frame.repartition(5)).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))


def test_nothing(spark):
    assert mixing.mix_sources(nothing(spark)).isEmpty()
    assert mixing.mixed_documents(nothing(spark)).isEmpty()
    empty = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [(r.size, r.target, r.taken) for r in mixing.mix_sources(empty).collect()] == [(0, 0.0, 0)] * 2
    assert mixing.mixed_documents(empty).isEmpty()


def test_taken_words_meet_the_targets(spark, check_dir):
    docs = spark.read.parquet(f"{check_dir}/documents.parquet")
    rows = mixing.mix_sources(docs).join(docs.select("doc_id", "source"), "doc_id")
    per_source = rows.groupBy("source").agg(
        F.sum("taken").alias("taken"), F.first("target").alias("target"), F.sum("size").alias("size")
    )
    for row in per_source.collect():
        assert abs(row.taken - row.target) <= mixing.BLOCK_WORDS
        assert row.taken <= 3 * row.size


def test_the_mix_holds_the_taken_words(spark, check_dir):
    docs = spark.read.parquet(f"{check_dir}/documents.parquet")
    taken = {row.doc_id: row.taken for row in mixing.mix_sources(docs).collect()}
    texts = {row.doc_id: row.text for row in docs.collect()}
    mix = mixing.mixed_documents(docs)
    assert mix.columns == docs.columns
    words, cut = {}, 0
    for row in mix.collect():
        words[row.doc_id] = words.get(row.doc_id, 0) + size(row.text)
        assert row.text in texts[row.doc_id]
        assert row.n_chars == len(row.text)
        cut += row.text != texts[row.doc_id]
    assert words == {doc_id: n for doc_id, n in taken.items() if n}
    # Only at the ends of each source's run.
    assert cut <= 3 * docs.select("source").distinct().count()
