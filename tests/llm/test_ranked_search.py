import math
import random
from collections import Counter

import numpy as np
import odd
import pytest
from pyspark.sql import functions as F

from tiercast.llm import ranked_search as search


def brute_terms(text):
    found, word = [], ""
    for c in (text or "") + " ":
        if c.isascii() and not c.isalnum():
            if word:
                found.append(word)
            word = ""
        else:
            word += c.lower() if c.isascii() else c
    return found


def brute(docs, items, top=20):
    """``docs``: (doc_id, text); ``items``: (item_id, text)."""
    counted = [(i, Counter(brute_terms(text))) for i, text in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, length = len(counted), sum(sum(c.values()) for _, c in counted)
    holders = Counter(term for _, c in counted for term in c)
    rows = []
    for item_id, text in items:
        wanted, scored = Counter(brute_terms(text)), []
        for doc_id, c in counted:
            m = 100 - 25 + (25 * sum(c.values()) * n_docs) // length
            score = sum(
                repeats * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holders[t] + 1)))
                * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m))
                for t, repeats in wanted.items()
                if c[t]
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, missing, doc_id) in enumerate(sorted(scored)[:top], 1):
            rows.append((item_id, rank, None if missing else doc_id, -score))
    return sorted(map(repr, rows))


def rows_of(frame):
    return sorted(repr(tuple(row)) for row in frame.collect())


def random_tables(seed, n_docs=400, n_items=40):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Ünï", "中文", "a1"]
    weights = [1 / (i + 1) for i in range(len(words))]

    def text(most):
        return " ".join(rng.choices(words, weights, k=rng.randint(0, most)))

    docs = [(i, text(40)) for i in range(n_docs)]
    # Copies, so that scores tie.
    docs += [(n_docs + i, docs[i % 7][1]) for i in range(60)]
    return docs, [(i, text(12)) for i in range(n_items)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(search, "BLOCK_ITEMS", 15)
    docs, items = random_tables(seed)
    found = search.ranked_documents(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(5),
        spark.createDataFrame(items, "item_id long, text string"),
    )
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows_of(found) == brute(docs, items)


def corpus_and_matrix(docs, items):
    block = search._block([type("Row", (), {"item_id": i, "text": t}) for i, t in items])
    counted = [Counter(t for t in search.terms(text)) for _, text in docs]
    size = len(block.vocabulary)
    holders = np.array([sum(term in c for c in counted) for term in block.vocabulary])
    corpus = search.Corpus(sum(map(bool, counted)), sum(sum(c.values()) for c in counted), holders)
    matrix = np.zeros((len(docs), size), np.int64)
    for i, c in enumerate(counted):
        for term, n in c.items():
            if term in block.vocabulary:
                lengths = np.array([sum(c.values())])
                matrix[i, block.vocabulary[term]] = search.impacts(np.array([n]), lengths, corpus)[0]
    return search.item_tree(block.counts * search.term_weights(corpus)), matrix


def test_pruned_pairs_hold_nothing():
    docs, items = random_tables(3, 2000, 40)
    tree, matrix = corpus_and_matrix(docs, items)
    order = np.lexsort((matrix.argmax(axis=1),))
    matrix = matrix[order]
    every = tree.weights @ matrix.T
    kth = np.sort(every, axis=1)[:, -5]
    best = search.Best(kth, 5)
    ids = order.tolist()
    scored = search.search_batch(tree, best, matrix, ids)
    assert 0 < scored < 0.8 * every.size
    for item, found in enumerate(best.found):
        expected = sorted((-s, False, i) for s, i in zip(every[item].tolist(), ids) if s > 0)[:5]
        assert found == expected


def test_nodes_hold_the_largest_weights_below_them():
    docs, items = random_tables(4, 50, 70)
    tree, _ = corpus_and_matrix(docs, items)

    def check(node):
        assert (node.largest == tree.weights[node.start : node.end].max(axis=0)).all()
        assert sum(c.end - c.start for c in node.children) in (0, node.end - node.start)
        for child in node.children:
            check(child)

    check(tree.root)
    assert tree.root.children and sorted(tree.order) == list(range(70))


def test_large_sums_stay_whole(spark):
    """Weights beyond what doubles hold are added in integers."""
    docs = [(i, "rare " * (i + 1) + "common") for i in range(30)] + [(100 + i, "other") for i in range(30)]
    items = [(1, "rare " * 700_000 + "common other")]
    found = search.ranked_documents(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
    )
    assert rows_of(found) == brute(docs, items)


def test_odd_input(spark):
    docs = odd.documents(spark).withColumns({n: F.lit(n) for n in ("rank", "terms", "counts", "place")})
    given = [(row.doc_id, row.text) for row in docs.select("doc_id", "text").collect()]
    items = [
        (1, "the quick brown fox"), (1, "der Hund"), (None, "row number"), (2, None), (3, ""),
        (4, "!!! ..."), (5, "absent"), (6, "short SHORT"), (7, "中文 Ünïcödé"), (8, "word5 and3 word5"),
    ]
    frame = spark.createDataFrame(items, "item_id long, text string").withColumn("score", F.lit(1))
    assert rows_of(search.ranked_documents(docs, frame)) == brute(given, items)
    assert search.ranked_documents(odd.nothing(spark), frame).isEmpty()
    assert search.ranked_documents(docs, frame.where("false")).isEmpty()
    assert search.ranked_documents(docs, frame.where("false")).columns == ["item_id", "rank", "doc_id", "score"]
