import math
from collections import Counter

import numpy as np
import odd
import pytest
from pyspark.sql import functions as F

from tiercast.llm import toxicity
from tiercast.operators.scratch import Scratch

BAD, GOOD = "you are a vile wretch and a fool", "the garden is lovely in the morning sun"


def labelled(spark, n=120):
    """Texts of both kinds with a little of everything around the words that tell."""
    rows = []
    for i in range(n):
        around = " ".join(f"w{(i * k) % 37}" for k in range(1, 9))
        rows.append((i, f"{around} {BAD if i % 3 == 0 else GOOD} {around}", int(i % 3 == 0)))
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return frame.select("doc_id", "text"), frame.select("doc_id", "toxic")


def levels(totals, size):
    for bucket, n in totals.items():
        for level, least in enumerate(toxicity.COUNT_LEVELS):
            if n >= least:
                yield bucket * toxicity.LEVELS + level
        for level, per in enumerate(toxicity.RATE_LEVELS, len(toxicity.COUNT_LEVELS)):
            if n > 1 and n * per >= size:
                yield bucket * toxicity.LEVELS + level


@pytest.mark.parametrize("piece", [7, 64, 1 << 18])
def test_features_equal_brute_force_whatever_the_pieces(monkeypatch, piece):
    monkeypatch.setattr(toxicity, "PIECE", piece)
    texts = [BAD, "", "  ", "a", "ab", "Ünï 中文 😀 12 !?", "aaaa aaaa aaaa aaaa" * 30, f"{GOOD}. {BAD}! " * 9]
    every = np.ones(toxicity.BUCKETS * toxicity.LEVELS, bool)
    text, feature = toxicity.held_features(texts, every)
    for i, one in enumerate(texts):
        spaced = toxicity.normal(one)
        totals = Counter(
            brute_bucket(spaced[start : start + n])
            for n in toxicity.GRAMS
            for start in range(len(spaced) - n + 1)
        )
        assert set(feature[text == i].tolist()) == set(levels(totals, len(spaced)))


def brute_bucket(gram):
    key = ord(gram[0]) + 1
    for c in gram[1:]:
        key = (key * 0x9E3779B97F4A7C15 + ord(c) + 1) % 2**64
    mixed = (key ^ (key >> 29)) * 0xD6E8FEB86659FD93 % 2**64
    return mixed >> (64 - toxicity.BUCKET_BITS)


def test_ratios_equal_the_formula():
    counts = np.array([[3.0, 0, 10], [0, 5, 10]])
    p, q = counts[1] + 1, counts[0] + 1
    expected = [math.log((a / p.sum()) / (b / q.sum())) for a, b in zip(p, q)]
    assert np.allclose(toxicity.log_count_ratios(counts), expected)


def test_learns_and_scores_texts_it_has_not_seen(spark):
    docs, labels = labelled(spark)
    rows = toxicity.score_toxicity(docs, labels).collect()
    out = [row for row in rows if row.held_out]
    assert 10 < len(out) < 60
    assert all(row.predicted == int(row.doc_id % 3 == 0) for row in out)
    assert all(0 <= row.score <= 1 and row.predicted == int(row.score >= 0.3) for row in rows)


def test_labels_of_held_out_rows_lang_and_source_play_no_part(spark):
    docs, labels = labelled(spark)
    turned = labels.withColumn(
        "toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic"))
    )
    extra = docs.withColumns({n: F.lit(f"own {n}") for n in ("lang", "source", "toxic", "weight", "score", "held")})
    plain = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, labels).collect()}
    other = {r.doc_id: r.score for r in toxicity.score_toxicity(extra, turned).collect()}
    assert plain.keys() == other.keys()
    assert all(math.isclose(plain[i], other[i], abs_tol=1e-9) for i in plain)


def test_held_out_accuracy_on_the_given_table(spark, check_dir):
    """Half of what is wrong here are junk texts that carry the label by chance."""
    folder = check_dir.replace("sf0.01", "sf0.1")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    scored = toxicity.score_toxicity(docs, labels).where("held_out").join(labels, "doc_id")
    counts = Counter((row.toxic, row.predicted) for row in scored.select("toxic", "predicted").collect())
    assert counts[1, 1] >= 0.92 * (counts[1, 1] + counts[1, 0])
    assert counts[0, 1] <= 0.01 * (counts[0, 0] + counts[0, 1])


def test_odd_input(spark):
    docs = odd.documents(spark)
    labels = spark.createDataFrame(
        [(0, 1), (0, 0), (1, 1), (8, 0), (9, 0), (None, 1), (10, None), (5, 0), (99, 1)],
        "doc_id long, toxic int",
    ).withColumn("score", F.lit("own"))
    rows = toxicity.score_toxicity(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(0 <= row.score <= 1 for row in rows)
    by_id = {}
    for row in rows:
        by_id.setdefault(row.doc_id, set()).add(row.score)
    assert len(by_id[8]) == 1 and by_id[2] == by_id[3] == by_id[4]
    assert toxicity.score_toxicity(odd.nothing(spark), labels).isEmpty()


def test_one_class_or_none(spark):
    docs, labels = labelled(spark, 30)
    for kept, score in (("toxic = 1", 1.0), ("toxic = 0", 0.0), ("false", 0.0)):
        rows = toxicity.score_toxicity(docs, labels.where(kept)).collect()
        assert {row.score for row in rows} == {score}


def test_the_sample_is_bounded_and_weighted(spark):
    docs, labels = labelled(spark, 3000)
    sample, sizes = toxicity._sampled(docs, labels, 200)
    rows = sample.groupBy("toxic").agg(F.count("*").alias("n"), F.sum("weight").alias("w")).collect()
    assert sizes == {1: 1000, 0: 2000}
    for row in rows:
        assert 130 < row.n < 270
        assert math.isclose(row.w, sizes[row.toxic], rel_tol=0.35)


def test_staged_tables_are_in_the_given_folder(spark):
    docs, labels = labelled(spark, 60)
    with Scratch(spark) as scratch:
        assert toxicity.score_toxicity(docs, labels, scratch).count() == 60
