import math
import zlib
from collections import Counter

import numpy as np
import pytest
from odd import documents, nothing

from tiercast.llm import langid


def brute_grams(text):
    """Hash buckets of one text, by plain loops."""
    plain = []
    for c in f" {text} ".lower():
        c = c if c.isalpha() else " "
        if c != " " or not plain or plain[-1] != " ":
            plain.append(c)
    found = []
    for n in (1, 2, 3):
        for i in range(len(plain) - n + 1):
            h = sum(ord(c) * place for c, place in zip(plain[i : i + n], langid._PLACES)) % 2**64
            h ^= h >> 32
            found.append((h * langid._MIX % 2**64) >> 48)
    return found


def test_scores_equal_plain_naive_bayes(spark):
    rows = [row for row in documents(spark).collect() if row.doc_id not in (5, 6)]
    model = langid.train(documents(spark).where("doc_id not in (5, 6)"))
    known = [row for row in rows if None not in (row.doc_id, row.lang, row.text)]
    languages = sorted({row.lang for row in known})
    assert model.languages == languages
    counts = {name: Counter() for name in languages}
    for row in known:
        counts[row.lang].update(brute_grams(row.text))
    docs = Counter(row.lang for row in known)
    texts = [row.text or "" for row in rows]
    posterior, _ = langid.scores(model, texts)
    for text, found in zip(texts, posterior):
        logs = []
        for name in languages:
            total = sum(counts[name].values()) + langid.SMOOTHING * langid.BUCKETS
            logs.append(
                math.log(docs[name] / sum(docs.values()))
                + sum(
                    math.log((counts[name][gram] + langid.SMOOTHING) / total)
                    for gram in brute_grams(text)
                )
            )
        shares = np.exp(np.array(logs) - max(logs))
        assert found == pytest.approx(shares / shares.sum(), abs=1e-6)


def test_held_out_accuracy(spark, check_dir):
    docs = spark.read.parquet(f"{check_dir}/documents.parquet")
    found = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    out = [row for row in found if row.held_out]
    assert all(row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 3 == 1) for row in found)
    assert 250 < len(out) < 420
    assert sum(row.lang_pred == row.lang for row in out) / len(out) > 0.98
    assert all(0 <= row.score <= 1 for row in found)


def test_labels_of_held_out_rows_do_not_matter(spark, check_dir):
    docs = spark.read.parquet(f"{check_dir}/documents.parquet")
    spoiled = docs.selectExpr(
        "doc_id", "text", "case when crc32(cast(doc_id as string)) % 3 = 1 then 'xx' else lang end lang"
    )
    first = sorted(map(tuple, langid.identify(docs).collect()))
    assert sorted(map(tuple, langid.identify(spoiled).collect())) == first


def test_odd_rows(spark):
    rows = langid.identify(documents(spark)).collect()
    assert len(rows) == documents(spark).count()
    assert rows[0].__fields__ == ["doc_id", "held_out", "lang_pred", "score"]
    unknown = {2, 3, 4, 7}
    for row in rows:
        assert (row.lang_pred == "und") == (row.doc_id in unknown)
        assert row.lang_pred != "und" or row.score == 0


def test_nothing_to_learn_from(spark):
    assert langid.identify(nothing(spark)).isEmpty()
    frame = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [row.lang_pred for row in langid.identify(frame).collect()] == ["und"]
    assert langid.keep_identified(frame).isEmpty()


def test_long_texts_are_summed_in_pieces():
    model = langid.Model(["a", "b"], np.zeros((langid.BUCKETS, 2)), np.log([0.25, 0.75]))
    posterior, lettered = langid.scores(model, ["x y z " * 300_000, ""])
    assert posterior == pytest.approx(np.array([[0.25, 0.75]] * 2))
    assert lettered.tolist() == [True, False]


def test_kept_documents_keep_their_columns(spark):
    frame = documents(spark)
    kept = langid.keep_identified(frame)
    assert kept.dtypes == frame.dtypes
    assert {row.doc_id for row in kept.collect()}.isdisjoint({2, 3, 4, 7})
