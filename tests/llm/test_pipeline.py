"""The pipeline against a brute-force version of its stages."""

import numpy as np
import pytest
from odd import documents
from test_exact_dup import normal
from test_mixing import brute_targets, size
from test_near_dup import brute_classes

import corpus_pipeline
from tiercast.llm import langid, mixing, tokens
from tiercast.operators.scratch import Scratch


@pytest.fixture(scope="module")
def written(spark, small_dir):
    """What each stage returned."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = scratch.stage(stage(spark, docs, small_dir), name)
        found.append(docs)
    return found


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "exact_dedup", "near_dedup", "mixing", "packing",
    ]


def test_columns_stay(written):
    for docs in written[1:-1]:
        assert docs.columns == written[0].columns


def test_language_stage_keeps_clean_documents(written):
    found = {row.doc_id for row in written[1].collect()}
    rows = langid.identify(written[0]).collect()
    assert found == {r.doc_id for r in rows if r.lang_pred != "und" and r.score >= 0.5}
    assert len(found) >= 0.98 * len(rows)


def test_exact_stage(written):
    first = {}
    for row in written[1].collect():
        text = normal(row.text)
        first[text] = min(first.get(text, row.doc_id), row.doc_id)
    assert sorted(row.doc_id for row in written[2].collect()) == sorted(first.values())


def test_near_stage(written):
    rows = [(row.doc_id, row.text) for row in written[2].collect()]
    kept = {first for _, first, _ in brute_classes(rows)}
    assert {row.doc_id for row in written[3].collect()} == kept
    assert written[3].count() == len(kept)


def test_mixing_stage(written):
    given, taken, sizes = {}, {}, {}
    for row in written[3].collect():
        given[row.doc_id] = row.source
        sizes[row.source] = sizes.get(row.source, 0) + size(row.text)
    for row in written[4].collect():
        source = given[row.doc_id]
        taken[source] = taken.get(source, 0) + size(row.text)
    for source, target in brute_targets(sizes).items():
        assert abs(taken.get(source, 0) - target) <= mixing.BLOCK_WORDS


def test_packing_stage(written):
    encoder = tokens.Encoder(corpus_pipeline.tokenizer_path(corpus_pipeline.WORD_BPE))
    texts = [row.text for row in written[4].collect()]
    encoded = encoder._tokenizer.encode_batch(texts, add_special_tokens=False)
    pieces = sorted(written[5].collect(), key=lambda p: (p.sequence_id, p.offset))
    found, ids = [], []
    for piece in pieces:
        ids += np.frombuffer(piece.ids, "<u4").tolist()
        if len(ids) == piece.doc_tokens:
            found.append(ids)
            ids = []
    assert sorted(found) == sorted([*e.ids, 1] for e in encoded)


def test_odd_documents_go_through(spark):
    docs = documents(spark)
    for name, stage in corpus_pipeline.STAGES:
        docs = Scratch(spark).stage(stage(spark, docs, ""), name)
    assert docs.count() > 0
    docs = documents(spark).where("false")
    for name, stage in corpus_pipeline.STAGES:
        docs = Scratch(spark).stage(stage(spark, docs, ""), name)
        assert docs.isEmpty()


def test_run_reads_the_documents(spark, small_dir, written):
    assert corpus_pipeline.run(spark, small_dir).count() == written[-1].count()


def test_staged_tables_go_when_the_next_stage_starts(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    lazily = corpus_pipeline.exact_dedup(spark, docs, small_dir)
    (owner, first), *_ = corpus_pipeline._held[-1:]
    # Not written: the next stage reads the staged rows themselves.
    near = corpus_pipeline.near_dedup(spark, lazily, small_dir)
    assert (owner, first) in corpus_pipeline._held
    written = Scratch(spark).stage(near, "near")
    corpus_pipeline.mixing(spark, written, small_dir)
    assert len(corpus_pipeline._held) == 1
    assert (owner, first) not in corpus_pipeline._held
