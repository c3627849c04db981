import random
import re
from collections import Counter

import numpy as np
import pytest
from odd import documents, nothing

from tiercast.llm import dart_minhash as darts
from tiercast.llm import near_dup
from tiercast.operators.scratch import Scratch


def plain_shingles(text):
    words = re.findall(r"(?:[a-z0-9]|[^\x00-\x7f])+", (text or "").lower())
    if not words:
        return Counter()
    width = min(5, len(words))
    return Counter(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def plain_similarity(left, right):
    shared = sum((left & right).values())
    total = sum(left.values()) + sum(right.values()) - shared
    return shared / total if total else 0.0


def brute_classes(rows, least=near_dup.LEAST_SIMILARITY):
    sets = [plain_shingles(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and plain_similarity(sets[i], sets[j]) >= least:
                root[find(i)] = find(j)
    members = {}
    for i in range(len(rows)):
        members.setdefault(find(i), []).append(rows[i][0])
    found = []
    for ids in members.values():
        first = min(ids, key=lambda i: (i is None, i))
        found += [(i, first, len(ids)) for i in ids]
    return sorted(found, key=repr)


def classes(frame):
    rows = near_dup.near_duplicates(frame).collect()
    return sorted(((r.doc_id, r.class_id, r.class_size) for r in rows), key=repr)


def words(rnd, n):
    return [f"w{rnd.randint(0, 5000)}" for _ in range(n)]


def test_similarity_is_weighted_jaccard():
    rnd = random.Random(1)
    base = words(rnd, 120)
    texts = ["", "a", "a b", "A, b!", " ".join(base), " ".join(base[:60] * 3), "ß É é 中"]
    texts += [" ".join(base[:i] + ["new"] + base[i:]) for i in (0, 3, 60)]
    for a in texts:
        for b in texts:
            expected = plain_similarity(plain_shingles(a), plain_shingles(b))
            assert darts.similarity(darts.weighted(a), darts.weighted(b)) == pytest.approx(expected)


@pytest.mark.parametrize("share", [0.02, 0.1, 0.3])
def test_signatures_estimate_similarity(share):
    rnd = random.Random(2)
    errors = []
    for _ in range(60):
        left = words(rnd, rnd.choice((8, 40, 300)))
        left = left + left[: len(left) // 3] * 2
        right = [w if rnd.random() > share else "zz" for w in left]
        sets = [darts.weighted(" ".join(text)) for text in (left, right)]
        signature = darts.signatures(sets, 192)
        errors.append((signature[0] == signature[1]).mean() - darts.similarity(*sets))
    assert abs(np.mean(errors)) < 0.02
    assert np.std(errors) < 0.05


def test_signatures_do_not_depend_on_their_batch():
    rnd = random.Random(3)
    sets = [darts.weighted(" ".join(words(rnd, n))) for n in (1, 2, 6, 50, 2000, 3, 700)]
    together = darts.signatures(sets, 64)
    for one, row in zip(sets, together):
        assert (darts.signatures([one], 64)[0] == row).all()
    assert (together != 0).all()


def test_odd_rows(spark):
    frame = documents(spark)
    rows = [(row.doc_id, row.text) for row in frame.collect()]
    assert classes(frame) == brute_classes(rows)
    assert near_dup.near_duplicates(nothing(spark)).isEmpty()
    kept = near_dup.drop_near_duplicates(frame)
    assert kept.dtypes == frame.dtypes
    assert kept.count() == len({(c, s) for _, c, s in classes(frame) if s > 1}) + sum(
        s == 1 for _, _, s in classes(frame)
    )


def test_groups_and_chains_equal_brute_force(spark):
    rnd = random.Random(4)
    rows = []
    for _ in range(6):
        base = words(rnd, rnd.choice((60, 150, 400)))
        for edits in (0, 0, 1, 1, 2, 3):
            text = list(base)
            for _ in range(edits):
                text[rnd.randrange(len(text))] = f"edit{rnd.random()}"
            rows.append(" ".join(text))
    # Each is close to the next, the ends are far apart.
    chain = words(rnd, 400)
    for step in range(12):
        rows.append(" ".join(chain))
        for i in range(6):
            chain[(step * 31 + i * 5) % 400] = f"step{step}-{i}"
    # One passage in many documents that are not alike.
    passage = words(rnd, 60)
    rows += [" ".join(words(rnd, 40) + passage + words(rnd, 40)) for _ in range(30)]
    rnd.shuffle(rows)
    rows = list(enumerate(rows))
    assert classes(spark.createDataFrame(rows, "doc_id long, text string")) == brute_classes(rows)


@pytest.mark.parametrize("draws", [(), (1, 4)])
def test_members_that_differ_from_the_hub_are_linked(spark, monkeypatch, draws):
    monkeypatch.setattr(near_dup, "DRAWS", draws)
    # With one coordinate per band, buckets hold many texts that are not alike.
    monkeypatch.setattr(near_dup, "COORDINATES", 8)
    monkeypatch.setattr(near_dup, "BANDS", 8)
    rnd = random.Random(5)
    passage = words(rnd, 150)
    rows = []
    for group in range(8):
        own = words(rnd, 100)
        for copy in range(3):
            rows.append(" ".join(passage + own[: 98 + copy] + [f"g{group}c{copy}"]))
    rnd.shuffle(rows)
    rows = list(enumerate(rows))
    found = classes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert found == brute_classes(rows)


def test_a_hot_group_of_copies_and_near_copies(spark):
    rnd = random.Random(6)
    base = words(rnd, 80)
    rows = [" ".join(base)] * 500
    rows += [" ".join(base[:i] + [f"x{n}"] + base[i + 1 :]) for n, i in enumerate([5, 70] * 200)]
    rows += [" ".join(words(rnd, 80)) for _ in range(300)]
    rows = list(enumerate(rows))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(11)
    found = classes(frame)
    assert [row for row in found if row[2] > 1] == sorted(((i, 0, 900) for i in range(900)), key=repr)


def group_of_near_copies(n, seed):
    """Near-copies of one text, some changed little, some much, in several components."""
    rnd = random.Random(seed)
    base = words(rnd, 150)
    rows = []
    for i in range(n):
        text = list(base)
        for _ in range(rnd.choice((1, 2, 3, 5, 7))):
            text[rnd.randrange(len(text))] = f"edit{i}-{rnd.random()}"
        rows.append(" ".join(text))
    return list(enumerate(rows))


def test_pairs_grow_with_the_members_of_a_group(spark):
    compared = {}
    for n in (300, 1200):
        rows = group_of_near_copies(n, 9)
        frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
        with Scratch(spark) as scratch:
            found = near_dup.near_duplicates(frame, scratch=scratch)
            found = sorted(((r.doc_id, r.class_id, r.class_size) for r in found.collect()), key=repr)
            compared[n] = spark.read.parquet(f"{scratch.path}/pairs-*").count()
        if n == 300:
            assert found == brute_classes(rows)
    assert all(pairs <= 64 * n for n, pairs in compared.items())


def test_members_of_a_group_have_few_hubs(spark):
    rows = group_of_near_copies(300, 11)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    with Scratch(spark) as scratch:
        found = near_dup.near_duplicates(frame, scratch=scratch)
        found = sorted(((r.doc_id, r.class_id, r.class_size) for r in found.collect()), key=repr)
        open_ = spark.read.parquet(f"{scratch.path}/open-members")
        hubs, members = open_.count(), open_.select("rep").distinct().count()
        prefixes = spark.read.parquet(f"{scratch.path}/open-prefixes").count()
    assert found == brute_classes(rows)
    assert hubs <= 2 * members
    assert prefixes <= 20 * members


def group_around_a_text(n, seed):
    """Near-copies of one text, most of them below the least similarity to most others: words left
    out, put in, or swapped, with little that only one of them holds."""
    rnd = random.Random(seed)
    base = words(rnd, 130)
    rows = []
    for _ in range(n):
        text = list(base)
        for _ in range(rnd.choice((1, 2, 3, 4, 5))):
            at = rnd.randrange(len(text) - 1)
            match rnd.randrange(3):
                case 0:
                    del text[at]
                case 1:
                    text.insert(at, rnd.choice(base[:4]))
                case 2:
                    text[at], text[at + 1] = text[at + 1], text[at]
        rows.append(" ".join(text))
    return list(enumerate(rows))


def test_few_members_far_from_the_hub_meet_by_prefixes(spark):
    for n in (300, 1500):
        rows = group_around_a_text(n, 10)
        frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
        with Scratch(spark) as scratch:
            found = near_dup.near_duplicates(frame, scratch=scratch)
            found = sorted(((r.doc_id, r.class_id, r.class_size) for r in found.collect()), key=repr)
            met = spark.read.parquet(f"{scratch.path}/pairs-3").count()
        if n == 300:
            assert found == brute_classes(rows)
        assert met <= 5 * n


@pytest.mark.parametrize("seed", range(2))
def test_groups_of_odd_sizes_equal_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(near_dup, "DRAWS", ())
    # With one coordinate per band, nearly all members share a bucket.
    monkeypatch.setattr(near_dup, "COORDINATES", 16)
    monkeypatch.setattr(near_dup, "BANDS", 16)
    rnd = random.Random(seed)
    rows = []
    for _ in range(4):
        base = words(rnd, rnd.choice((30, 60, 90)))
        for _ in range(25):
            text = base[rnd.randrange(12) :][: rnd.choice((len(base), len(base) - 8))]
            for _ in range(rnd.randrange(3)):
                at = rnd.randrange(len(text) - 1)
                text[at : at + 1] = rnd.choice(([], ["new"], [text[at], text[at - 1]]))
            rows.append(" ".join(text))
    rnd.shuffle(rows)
    rows = list(enumerate(rows))
    assert classes(spark.createDataFrame(rows, "doc_id long, text string")) == brute_classes(rows)
