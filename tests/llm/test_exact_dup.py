import hashlib
import random
import re
from collections import defaultdict

import pytest
from odd import documents, nothing

from tiercast.llm import exact_dup


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[normal(text)].append(doc_id)
    found = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        digest = hashlib.sha256(text.encode()).hexdigest()
        left = True
        for i in ids:
            kept = left and i == keep
            left = left and not kept
            found.append((i, keep, len(ids), kept, digest))
    return sorted(found, key=repr)


def found(frame):
    return sorted((tuple(row) for row in exact_dup.exact_groups(frame).collect()), key=repr)


def test_odd_rows(spark):
    frame = documents(spark)
    rows = [(row.doc_id, row.text) for row in frame.collect()]
    assert found(frame) == expected(rows)


def test_nothing(spark):
    assert exact_dup.exact_groups(nothing(spark)).isEmpty()
    assert exact_dup.drop_exact_duplicates(nothing(spark)).isEmpty()


@pytest.mark.parametrize("first", [1, 3, 64])
def test_long_common_beginnings(spark, monkeypatch, first):
    # Texts that part at any byte, also at the ends of digits, and prefixes of each other.
    monkeypatch.setattr(exact_dup, "FIRST_DIGIT", first)
    monkeypatch.setattr(exact_dup, "GROWTH", 2)
    monkeypatch.setattr(exact_dup, "WIDEST_DIGIT", 50)
    random.seed(first)
    base = "é" * 20 + "x" * 200
    texts = [base[: random.choice((0, 1, 2, 3, 63, 64, 65, 128, 191, 220))] for _ in range(60)]
    texts += [base[:i] + "y" + base[i + 1 :] for i in (0, 5, 63, 64, 65, 150, 219) for _ in range(2)]
    rows = list(enumerate(texts))
    random.shuffle(rows)
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == expected(rows)


def test_a_hot_group(spark):
    rows = [(i, "the same text " * 40 if i % 3 else f"its own {i}") for i in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert found(frame) == expected(rows)


def test_kept_documents_keep_their_columns(spark):
    frame = documents(spark)
    kept = exact_dup.drop_exact_duplicates(frame)
    assert kept.dtypes == frame.dtypes
    rows = expected([(row.doc_id, row.text) for row in frame.collect()])
    assert kept.count() == sum(row[3] for row in rows)
    assert {normal(row.text) for row in kept.collect()} == {
        normal(row.text) for row in frame.collect()
    }
