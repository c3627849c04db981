import zlib
from collections import defaultdict

import numpy as np
import pytest
from odd import documents, nothing

from tiercast.llm import packing, tokens
from tiercast.llm.tokens import WORD_BPE, tokenizer_path

PATH = tokenizer_path(WORD_BPE)


def check(docs, pieces, sequence=2048):
    """Pieces rebuild the documents, and sequences are full but for the last."""
    encoder = tokens.Encoder(PATH)
    texts = [(row.doc_id, row.text or "") for row in docs.select("doc_id", "text").collect()]
    encoded = encoder._tokenizer.encode_batch([t for _, t in texts], add_special_tokens=False)
    wanted = sorted((repr(i), [*e.ids, 1]) for (i, _), e in zip(texts, encoded))
    by_place = sorted(pieces, key=lambda p: (p.sequence_id, p.offset))
    assert [p.sequence_id * sequence + p.offset for p in by_place] == [
        0,
        *np.cumsum([p.length for p in by_place])[:-1],
    ]
    assert max(p.offset + p.length for p in pieces) <= sequence
    rebuilt, ids = [], []
    for piece in by_place:
        assert zlib.crc32(piece.ids) == piece.ids_crc32
        assert piece.start == len(ids)
        part = np.frombuffer(piece.ids, "<u4").tolist()
        assert len(part) == piece.length > 0
        ids += part
        if len(ids) == piece.doc_tokens:
            rebuilt.append((repr(piece.doc_id), ids))
            ids = []
    assert sorted(rebuilt) == wanted


def test_odd_rows(spark):
    docs = documents(spark)
    check(docs, packing.pack(docs, PATH).collect())
    check(docs, packing.pack(docs, PATH, sequence=7).collect(), 7)
    assert packing.pack(nothing(spark), PATH).isEmpty()


def test_whole_table(spark, check_dir):
    docs = spark.read.parquet(f"{check_dir}/documents.parquet")
    check(docs, packing.pack(docs, PATH).collect())


@pytest.mark.parametrize("dimensions,bits", [(2, 4), (3, 3), (4, 2)])
def test_hilbert_curve_visits_every_cell_in_unit_steps(dimensions, bits):
    axes = np.meshgrid(*[np.arange(1 << bits)] * dimensions, indexing="ij")
    cells = np.stack([axis.ravel() for axis in axes], axis=1)
    keys = packing.hilbert_keys(cells, bits)
    assert sorted(keys.tolist()) == list(range(len(cells)))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_like_documents_are_neighbours(spark, check_dir):
    docs = spark.read.parquet(f"{check_dir}/documents.parquet")
    language = {row.doc_id: row.lang for row in docs.select("doc_id", "lang").collect()}
    shared = defaultdict(set)
    for piece in packing.pack(docs, PATH).collect():
        shared[piece.sequence_id].add(piece.doc_id)
    pairs = [
        language[a] == language[b] for ids in shared.values() for a in ids for b in ids if a < b
    ]
    counts = np.unique(list(language.values()), return_counts=True)[1] / len(language)
    assert np.mean(pairs) > (counts**2).sum() + 0.15
