"""Token ids in binary shards with keyed access through a minimal perfect hash.

Documents are range-partitioned by id; each task writes its range, in ascending order, to one or
more shards. A shard holds the raw ids, the token offset and id of every document, and an index:
the perfect hash maps a document id to a slot with a fingerprint and the place of its first
document and their number, so one id is found in constant time without a search. Several documents
of one id lie next to each other.

Shards are written under another name and then moved, with contents that depend on the rows alone,
so a repeated task replaces its shard by the same bytes. A manifest with one row per shard tells
their order, sizes and first and last document id; running sums over it give each shard's place in the
whole corpus. ``lookup`` takes a document id from the manifest to its shard, and from there by a few
small reads, whose number does not grow with the shard, to its token ids.

Layout, all little-endian: ids (2 bytes each if the tokenizer's vocabulary allows, else 4); token
offsets (n + 1 x 8); document ids (n x 8); perfect hash words, each with the number of bits set before
it (2 x 8), and level sizes (8); per slot fingerprint, first document and number of documents (3 x 4);
the footer.

Results for odd input: a missing or empty text has the end id alone; documents without an id come
first and are not in the index; rows that repeat an id are ordered by a hash of their text; an
empty table gives no shard; other columns do not matter.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tiercast.llm.common import in_arrow, slices
from tiercast.llm.perfect_hash import PerfectHash, fingerprints, hash_bit
from tiercast.llm.tokens import encoder

# Fixed values of the file format.
MAGIC = b"TIERTOK2"
# Bytes of an id; documents, those without id, keys, ids, hash words, hash levels; the magic.
FOOTER = struct.Struct("<7Q8s")
# A shard ends at so many bytes of ids, or so many documents.
SHARD_BYTES, SHARD_DOCS = 32 << 20, 1 << 20
# Bytes of ids that are read back at a time.
READ_BYTES = 8 << 20

MANIFEST = (
    "part int, number int, path string, n_docs long, n_tokens long, first_key long, last_key long"
)


def _files(path: str) -> tuple[arrow_fs.FileSystem, str]:
    return arrow_fs.FileSystem.from_uri(path)


class ShardWriter:
    """One shard being written: ids go to the file at once, the directory is kept till the end."""

    def __init__(self, path: str, id_bytes: int) -> None:
        self.path, self.id_bytes = path, id_bytes
        self._files, self._target = _files(path)
        attempt = TaskContext.get().taskAttemptId() if TaskContext.get() else 0
        self._written = f"{self._target}.{attempt}.tmp"
        self._out = self._files.open_output_stream(self._written)
        self._lengths: list[np.ndarray] = []
        self._keys: list[int | None] = []
        self.n_tokens = 0

    def add(self, keys: list[int | None], ids: np.ndarray, lengths: np.ndarray) -> None:
        self._out.write(ids.astype(f"<u{self.id_bytes}").tobytes())
        self._lengths.append(lengths)
        self._keys += keys
        self.n_tokens += len(ids)

    @property
    def n_docs(self) -> int:
        return len(self._keys)

    @property
    def key_range(self) -> tuple[int | None, int | None]:
        """The first and last id; documents come in their order, those without one first."""
        return next((key for key in self._keys if key is not None), None), self._keys[-1]

    def close(self) -> None:
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(self._lengths))])
        unkeyed = sum(key is None for key in self._keys)
        keys = np.array([key or 0 for key in self._keys], np.int64)
        distinct, firsts, counts = np.unique(
            keys[unkeyed:], return_index=True, return_counts=True
        )
        index = PerfectHash.build(distinct)
        slots = index.slots(distinct)
        entries = np.zeros((len(distinct), 3), "<u4")
        entries[slots] = np.column_stack([fingerprints(distinct), firsts + unkeyed, counts])
        for part in (
            offsets.astype("<u8"),
            keys.astype("<i8"),
            np.column_stack([index.words, index.before.astype(np.uint64)]).astype("<u8"),
            index.sizes.astype("<u8"),
            entries,
        ):
            self._out.write(part.tobytes())
        self._out.write(
            FOOTER.pack(
                self.id_bytes,
                len(keys),
                unkeyed,
                len(distinct),
                self.n_tokens,
                len(index.words),
                len(index.sizes),
                MAGIC,
            )
        )
        self._out.close()
        self._files.move(self._written, self._target)


class Shard:
    """A written shard, open for reading."""

    def __init__(self, path: str) -> None:
        files, target = _files(path)
        self._in = files.open_input_file(target)
        size = self._in.size()
        footer = FOOTER.unpack(self._in.read_at(FOOTER.size, size - FOOTER.size))
        self.id_bytes, n, self.unkeyed, n_keys, self.n_tokens, n_words, n_levels, magic = footer
        if magic != MAGIC:
            raise ValueError(f"{path} is no token shard")
        self._at = self.n_tokens * self.id_bytes
        self.offsets = self._take("<u8", n + 1).astype(np.int64)
        self.keys = self._take("<i8", n)
        words, sizes = self._take("<u8", 2 * n_words)[::2], self._take("<u8", n_levels)
        self._index = PerfectHash(words, sizes.astype(np.int64))
        self._entries = self._take("<u4", 3 * n_keys).reshape(n_keys, 3).T.astype(np.int64)

    def _take(self, kind: str, count: int) -> np.ndarray:
        data = self._in.read_at(count * int(kind[2]), self._at)
        self._at += len(data)
        return np.frombuffer(data, kind)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First document and number of documents of each key; none where it is not stored."""
        slots = self._index.slots(keys)
        known = slots >= 0
        first, count = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        at = slots[known]
        same = self._entries[0, at] == fingerprints(keys[known])
        place = np.flatnonzero(known)[same]
        first[place], count[place] = self._entries[1, at[same]], self._entries[2, at[same]]
        return first, count

    def ids(self, document: int) -> np.ndarray:
        start, end = self.offsets[document : document + 2]
        data = self._in.read_at((end - start) * self.id_bytes, start * self.id_bytes)
        return np.frombuffer(data, f"<u{self.id_bytes}").astype(np.uint32)

    def pieces(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """All ids in order, in pieces of whole documents: first and last document, and the ids."""
        n, start = len(self.keys), 0
        while start < n:
            most = self.offsets[start] + READ_BYTES // self.id_bytes
            end = max(int(np.searchsorted(self.offsets, most, "right")) - 1, start + 1)
            low, high = self.offsets[start], self.offsets[end]
            data = self._in.read_at((high - low) * self.id_bytes, low * self.id_bytes)
            yield start, end, np.frombuffer(data, f"<u{self.id_bytes}")
            start = end

    def of(self, key: int) -> list[np.ndarray]:
        """The ids of every document with that id."""
        (first,), (count,) = self.find(np.array([key], np.int64))
        return [self.ids(document) for document in range(first, first + count)]

    def close(self) -> None:
        self._in.close()


class KeyedShard:
    """A written shard, open for single documents: the footer and the sizes of the levels are read at
    first, then a few places for each key."""

    def __init__(self, path: str) -> None:
        files, target = _files(path)
        self._in = files.open_input_file(target)
        self.reads = 0
        size = self._in.size()
        footer = FOOTER.unpack(self._read(size - FOOTER.size, FOOTER.size))
        self._id_bytes, n, _, n_keys, n_tokens, n_words, n_levels, magic = footer
        if magic != MAGIC:
            raise ValueError(f"{path} is no token shard")
        self._offsets = n_tokens * self._id_bytes
        self._words = self._offsets + 8 * (n + 1) + 8 * n
        sizes = self._words + 16 * n_words
        self._sizes = np.frombuffer(self._read(sizes, 8 * n_levels), "<u8").tolist()
        self._entries = sizes + 8 * n_levels

    def _read(self, at: int, size: int) -> bytes:
        self.reads += 1
        return self._in.read_at(size, at)

    def _slot(self, key: int) -> int | None:
        first = 0
        for level, size in enumerate(self._sizes):
            bit = hash_bit(key, level, 64 * size)
            word, before = np.frombuffer(self._read(self._words + 16 * (first + bit // 64), 16), "<u8").tolist()
            if word >> bit % 64 & 1:
                return before + (word & ((1 << bit % 64) - 1)).bit_count()
            first += size
        return None

    def of(self, key: int) -> list[np.ndarray]:
        """The ids of every document with that id."""
        slot = self._slot(key)
        if slot is None:
            return []
        entry = np.frombuffer(self._read(self._entries + 12 * slot, 12), "<u4").tolist()
        if entry[0] != int(fingerprints(np.array([key], np.int64))[0]):
            return []
        _, first, count = entry
        offsets = np.frombuffer(self._read(self._offsets + 8 * first, 8 * (count + 1)), "<u8").astype(np.int64)
        size = (offsets[-1] - offsets[0]) * self._id_bytes
        ids = np.frombuffer(self._read(offsets[0] * self._id_bytes, size), f"<u{self._id_bytes}")
        cuts = (offsets - offsets[0]).tolist()
        return [ids[a:b].astype(np.uint32) for a, b in zip(cuts, cuts[1:])]

    def close(self) -> None:
        self._in.close()


def lookup(manifest: DataFrame, key: int) -> list[np.ndarray]:
    """The ids of every document with that id, from the shards whose range holds it."""
    near = manifest.where((F.col("first_key") <= key) & (F.col("last_key") >= key))
    found = []
    # Ranges meet at their ends only, so these are few.
    for row in near.orderBy("part", "number").select("path").collect():
        shard = KeyedShard(row.path)
        found += shard.of(key)
        shard.close()
    return found


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int,
    vocabulary: int | None = None,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Write all documents into ``folder``; returns the manifest, to be stored by the caller.

    The shards are written when the manifest is. ``vocabulary`` is the tokenizer's own unless a larger
    one is given.
    """

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        most = max(encoder(tokenizer).vocabulary, vocabulary or 0, end_id + 1)
        id_bytes = 2 if most <= 1 << 16 else 4
        shard: ShardWriter | None = None

        def finished() -> pa.RecordBatch:
            shard.close()
            first, last = shard.key_range
            return pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([part], pa.int32()),
                    "number": pa.array([number], pa.int32()),
                    "path": [shard.path],
                    "n_docs": [shard.n_docs],
                    "n_tokens": [shard.n_tokens],
                    "first_key": pa.array([first], pa.int64()),
                    "last_key": pa.array([last], pa.int64()),
                }
            )

        for rows, texts in slices(batches, "text"):
            if shard is None:
                shard = ShardWriter(f"{folder}/tokens-{part:06d}-{number:05d}.bin", id_bytes)
            ids, lengths = encoder(tokenizer).encode(texts)
            # An end id after every document.
            ends = np.insert(ids, np.cumsum(lengths), end_id)
            shard.add(rows.column("doc_id").to_pylist(), ends, lengths + 1)
            if shard.n_tokens * id_bytes >= shard_bytes or shard.n_docs >= SHARD_DOCS:
                yield finished()
                shard, number = None, number + 1
        if shard is not None:
            yield finished()

    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    ordered = (
        docs.select(F.col("doc_id").cast("bigint"), "text")
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
    )
    return in_arrow(ordered, write, MANIFEST)


def read_back(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files.

    Each document with an id is found through the index. ``start`` counts the ids of all documents
    before it.
    """
    shards = manifest.count()
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.select(
        "path", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base")
    )

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(*(column.to_pylist() for column in batch.columns)):
                shard = Shard(path)
                yield _digest(shard, base)
                shard.close()

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return in_arrow(placed.repartition(max(shards, 1), "path"), read, schema)


def _digest(shard: Shard, base: int) -> pa.RecordBatch:
    n = len(shard.keys)
    documents = np.arange(n)
    keyed = shard.keys[shard.unkeyed :]
    distinct, which = np.unique(keyed, return_inverse=True)
    firsts, count = shard.find(distinct)
    if int(count.sum()) != len(keyed):
        raise ValueError("the index does not cover its shard")
    # Documents of one id follow each other from the first.
    within = np.arange(len(keyed)) - np.searchsorted(keyed, keyed)
    documents[shard.unkeyed :] = firsts[which] + within
    starts, ends = shard.offsets[documents], shard.offsets[documents + 1]
    stored = np.zeros(n, np.int64)
    for first, end, piece in shard.pieces():
        wide = piece.astype("<u4")
        cuts = (shard.offsets[first : end + 1] - shard.offsets[first]).tolist()
        stored[first:end] = [zlib.crc32(wide[a:b].tobytes()) for a, b in zip(cuts, cuts[1:])]
    crcs = stored[documents]
    ids = pa.array(shard.keys, mask=np.arange(n) < shard.unkeyed)
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(base + starts), pa.array(ends - starts), pa.array(crcs, pa.int64())],
        ["doc_id", "start", "n_tokens", "ids_crc32"],
    )
