import zlib

import numpy as np
import pytest
from odd import documents, nothing

from tiercast.llm import token_files, tokens
from tiercast.llm.perfect_hash import PerfectHash, fingerprints
from tiercast.llm.tokens import BYTE_BPE, tokenizer_path
from tiercast.operators.scratch import Scratch

PATH = tokenizer_path(BYTE_BPE)


def written(spark, docs, **options):
    scratch = Scratch(spark)
    manifest = token_files.write_tokens(docs, scratch.path, PATH, 2, **options)
    return scratch.stage(manifest, "manifest")


def wanted(docs):
    tokenizer = tokens.Encoder(PATH)._tokenizer
    rows = [(row.doc_id, row.text or "") for row in docs.select("doc_id", "text").collect()]
    encoded = tokenizer.encode_batch([text for _, text in rows], add_special_tokens=False)
    return [(doc_id, [*e.ids, 2]) for (doc_id, _), e in zip(rows, encoded)]


def check(spark, docs, **options):
    rows = token_files.read_back(written(spark, docs, **options)).collect()
    rows.sort(key=lambda row: row.start)
    assert [row.doc_id for row in rows] == sorted(
        (row.doc_id for row in rows), key=lambda i: (i is not None, i)
    )
    assert [row.start for row in rows] == [0, *np.cumsum([row.n_tokens for row in rows])[:-1]]
    expected = [
        (repr(doc_id), len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        for doc_id, ids in wanted(docs)
    ]
    assert sorted((repr(r.doc_id), r.n_tokens, r.ids_crc32) for r in rows) == sorted(expected)


def test_odd_rows(spark):
    check(spark, documents(spark))
    check(spark, documents(spark), vocabulary=1 << 20, shard_bytes=1)
    assert token_files.read_back(written(spark, nothing(spark))).isEmpty()


def test_whole_table(spark, check_dir):
    check(spark, spark.read.parquet(f"{check_dir}/documents.parquet"), shard_bytes=100_000)


def test_keyed_access(spark, check_dir):
    docs = spark.read.parquet(f"{check_dir}/documents.parquet")
    twice = docs.unionAll(docs.where("doc_id % 7 = 0"))
    expected = {}
    for doc_id, ids in wanted(twice):
        expected.setdefault(doc_id, []).append(ids)
    found = {}
    for row in written(spark, twice, shard_bytes=200_000).collect():
        shard = token_files.Shard(row.path)
        for doc_id in range(-50, 1100):
            for ids in shard.of(doc_id):
                found.setdefault(doc_id, []).append(ids.tolist())
        shard.close()
    assert found == expected


def test_lookup_opens_the_shards_of_a_key_and_reads_a_few_places(spark, check_dir):
    docs = spark.read.parquet(f"{check_dir}/documents.parquet")
    twice = docs.unionAll(docs.where("doc_id % 7 = 0")).unionAll(documents(spark).select(docs.columns).where("doc_id is null"))
    expected = {}
    for doc_id, ids in wanted(twice):
        expected.setdefault(doc_id, []).append(ids)
    manifest = written(spark, twice, shard_bytes=50_000)
    rows = manifest.orderBy("part", "number").collect()
    assert len(rows) > 10
    keyed = [row for row in rows if row.first_key is not None]
    assert all(a.last_key <= b.first_key for a, b in zip(keyed, keyed[1:]))
    for key in (0, 7, 500, 999):
        assert [ids.tolist() for ids in token_files.lookup(manifest, key)] == expected[key]
    assert token_files.lookup(manifest, 10**9) == token_files.lookup(manifest, -5) == []


def test_reads_of_a_lookup_do_not_grow_with_the_shard(spark):
    for n in (200, 20_000):
        docs = spark.range(n).selectExpr("id * 3 as doc_id", "concat('text ', id % 50) as text").coalesce(1)
        (row,) = written(spark, docs.hint("coalesce", 1), shard_bytes=1 << 30).limit(1).collect()
        shard = token_files.KeyedShard(row.path)
        opened = shard.reads
        plain = token_files.Shard(row.path)
        keys = [k for k in range(row.first_key, min(row.last_key, row.first_key + 900))]
        for key in keys:
            assert [a.tolist() for a in shard.of(key)] == [a.tolist() for a in plain.of(key)]
        assert opened == 2
        assert shard.reads - opened <= 6 * len(keys)


def test_shards_end_by_documents_too(spark, monkeypatch):
    docs = spark.range(500).selectExpr("id as doc_id", "'' as text")
    assert token_files.SHARD_DOCS == 1 << 20
    manifest = written(spark, docs)
    assert manifest.agg({"n_docs": "sum"}).first()[0] == 500
    monkeypatch.setattr(token_files, "READ_BYTES", 64)
    check(spark, docs.limit(60))


def test_ids_are_as_wide_as_the_tokenizer_needs():
    assert tokens.Encoder(PATH).vocabulary == 50_257


@pytest.mark.parametrize("n", [0, 1, 2, 100, 50_000])
def test_perfect_hash(n):
    random = np.random.default_rng(n)
    keys = np.unique(random.integers(-(2**62), 2**62, n))
    index = PerfectHash.build(keys)
    assert sorted(index.slots(keys).tolist()) == list(range(len(keys)))
    other = random.integers(-(2**62), 2**62, 1000)
    slots = index.slots(other)
    stored = np.zeros(max(len(keys), 1), np.uint32)
    stored[index.slots(keys)] = fingerprints(keys)
    wrong = (slots >= 0) & (stored[np.maximum(slots, 0)] == fingerprints(other))
    assert wrong.sum() <= 1


def test_repeated_keys_are_refused():
    with pytest.raises(ValueError):
        PerfectHash.build(np.array([5, 5]))
