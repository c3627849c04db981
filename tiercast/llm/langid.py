"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams per language on a bounded sample: about ``sample_docs`` labelled documents
of each language, chosen by a hash of the id, with their whole texts. The counts are summed by
Spark; the matrix of log-probabilities (buckets x languages) is broadcast. Scoring sums the rows of
a text's n-grams in numpy, for many texts at once and in bounded pieces.

Letters are lower-cased, every run of other characters is one space, and texts start and end with
one, so digits and punctuation carry no evidence.

Results for odd input: a missing text, or one without a letter, is ``und`` with score 0; rows
without a language or an id are not learned from; of languages with equal scores the first by code
point wins; with nothing to learn from every text is ``und``; repeated rows are predicted alike; an
empty table gives an empty table; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiercast.llm.common import in_arrow, slices

UNKNOWN = "und"
BUCKETS = 1 << 16
SAMPLE_DOCS = 3000
SMOOTHING = 0.5
LEAST_SCORE = 0.5

# Odd 64-bit constants, one per place in an n-gram, and one to mix.
_PLACES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
_MIX = 0xD6E8FEB86659FD93


class Model(NamedTuple):
    languages: list[str]
    # float64, BUCKETS x languages; and the log share of each language.
    log_probabilities: np.ndarray
    log_priors: np.ndarray


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _prepared(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all texts after another, the text each belongs to, and which have letters."""
    points = [_points(f" {text} ".lower()) for text in texts]
    lengths = np.fromiter(map(len, points), np.int64, len(points))
    owner = np.repeat(np.arange(len(texts)), lengths)
    flat = np.concatenate(points) if points else np.empty(0, np.uint32)
    letter = _letters()[flat]
    flat = np.where(letter, flat, 32)
    before = np.concatenate([[False], letter[:-1]])
    starts = np.cumsum(lengths) - lengths
    before[starts] = True
    kept = letter | before
    lettered = np.zeros(len(texts), bool)
    lettered[owner[letter]] = True
    return flat[kept].astype(np.uint64), owner[kept], lettered


def _buckets(points: np.ndarray, owner: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For n = 1, 2, 3: the bucket of each n-gram within one text, and its text."""
    mixed = [points * np.uint64(place) for place in _PLACES]
    for n in range(1, len(_PLACES) + 1):
        count = len(points) - n + 1
        if count <= 0:
            return
        gram = mixed[0][:count].copy()
        for i in range(1, n):
            gram += mixed[i][i : i + count]
        gram ^= gram >> np.uint64(32)
        gram *= np.uint64(_MIX)
        inside = owner[:count] == owner[n - 1 :]
        yield (gram >> np.uint64(48)).astype(np.int64)[inside], owner[:count][inside]


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bucket counts per language of one task, as one row per bucket in use."""
    totals: dict[str, np.ndarray] = {}
    for part, texts in slices(batches, "text"):
        languages = part.column("lang").to_pylist()
        points, owner, _ = _prepared(texts)
        names = sorted(set(languages))
        of = np.array([names.index(language) for language in languages], np.int64)
        for buckets, owners in _buckets(points, owner):
            counts = np.bincount(of[owners] * BUCKETS + buckets, minlength=len(names) * BUCKETS)
            for i, name in enumerate(names):
                total = totals.setdefault(name, np.zeros(BUCKETS, np.int64))
                total += counts[i * BUCKETS : (i + 1) * BUCKETS]
    for name, total in totals.items():
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict(
            {"lang": [name] * len(used), "bucket": pa.array(used), "n": pa.array(total[used])}
        )


def train(
    docs: DataFrame, sample_docs: int = SAMPLE_DOCS, smoothing: float = SMOOTHING
) -> Model:
    """A model from the rows of ``(doc_id, text, lang)`` with all three present."""
    labelled = docs.select("doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull()
    )
    by_language = labelled.groupBy("lang").agg(F.count("*").alias("n"))
    sizes = {row.lang: row.n for row in by_language.collect()}
    if not sizes:
        return Model([], np.empty((BUCKETS, 0)), np.empty(0))
    # The share of each language that gives about sample_docs documents, in millionths.
    share = F.lit(0)
    for language, n in sizes.items():
        millionths = 1_000_000 if n <= sample_docs else sample_docs * 1_000_000 // n
        share = F.when(F.col("lang") == language, millionths).otherwise(share)
    chosen = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("sample")), 1_000_000) < share
    sample = labelled.where(chosen).select("text", "lang")
    counted = (
        in_arrow(sample, _count, "lang string, bucket long, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        # At most buckets x languages rows.
        .toArrow()
    )
    languages = sorted(set(counted.column("lang").to_pylist()))
    counts = np.zeros((BUCKETS, len(languages)))
    place = {language: i for i, language in enumerate(languages)}
    columns = np.array([place[language] for language in counted.column("lang").to_pylist()], int)
    counts[counted.column("bucket").to_numpy(), columns] = counted.column("n").to_numpy()
    smoothed = counts + smoothing
    sizes_in_order = np.array([sizes[language] for language in languages], float)
    return Model(
        languages,
        np.log(smoothed) - np.log(smoothed.sum(axis=0)),
        np.log(sizes_in_order / sizes_in_order.sum()) if languages else np.empty(0),
    )


def scores(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Posterior probabilities (texts x languages), and which texts have a letter."""
    points, owner, lettered = _prepared(texts)
    total = np.tile(model.log_priors, (len(texts), 1))
    for buckets, owners in _buckets(points, owner):
        # Pieces bound the gathered rows also for one very long text.
        for start in range(0, len(buckets), 1 << 19):
            piece, of = buckets[start : start + (1 << 19)], owners[start : start + (1 << 19)]
            firsts = np.flatnonzero(np.diff(of, prepend=-1))
            sums = np.add.reduceat(model.log_probabilities[piece], firsts, axis=0)
            total[of[firsts]] += sums
    total -= total.max(axis=1, keepdims=True)
    posterior = np.exp(total)
    return posterior / posterior.sum(axis=1, keepdims=True), lettered


def _predictor(
    broadcast, keep: Callable[[pa.RecordBatch, list[str], list[float]], pa.RecordBatch]
) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def predict(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = broadcast.value
        for part, texts in slices(batches, "text"):
            if model.languages:
                posterior, lettered = scores(model, texts)
                best = posterior.argmax(axis=1)
                names = [
                    model.languages[i] if known else UNKNOWN for i, known in zip(best, lettered)
                ]
                score = np.where(lettered, posterior.max(axis=1), 0.0).tolist()
            else:
                names, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
            yield keep(part, names, score)

    return predict


def predict(docs: DataFrame, model: Model, *others: str) -> DataFrame:
    """``doc_id, *others, lang_pred, score`` of every document, from its text alone."""

    def keep(part: pa.RecordBatch, names: list[str], score: list[float]) -> pa.RecordBatch:
        kept = {name: part.column(name) for name in ("doc_id", *others)}
        return pa.RecordBatch.from_pydict(
            {**kept, "lang_pred": pa.array(names, pa.string()), "score": pa.array(score)}
        )

    narrow = docs.select("doc_id", *others, "text")
    schema = narrow.drop("text").schema.add("lang_pred", "string").add("score", "double")
    broadcast = docs.sparkSession.sparkContext.broadcast(model)
    return in_arrow(narrow, _predictor(broadcast, keep), schema)


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``, learned from the documents not held out."""
    out = held_out(F.col("doc_id"))
    model = train(docs.where(~out))
    return predict(docs.select("doc_id", "text", out.alias("held_out")), model, "held_out")


def keep_identified(docs: DataFrame, least_score: float = LEAST_SCORE) -> DataFrame:
    """The documents, all columns, whose language is found with at least that score."""
    model = train(docs.where(~held_out(F.col("doc_id"))))

    def keep(part: pa.RecordBatch, names: list[str], score: list[float]) -> pa.RecordBatch:
        accepted = [name != UNKNOWN and s >= least_score for name, s in zip(names, score)]
        return part.filter(pa.array(accepted, pa.bool_()))

    broadcast = docs.sparkSession.sparkContext.broadcast(model)
    return in_arrow(docs, _predictor(broadcast, keep), docs.schema)
