"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A text's features are the hashed 3- to 5-grams it holds, each at several levels: that it occurs so
often (``COUNT_LEVELS``), and so densely (``RATE_LEVELS``). Each is held or not. With p and q the
smoothed counts of a feature over the toxic and the other training texts, its log-count ratio is
r = log((p / |p|) / (q / |q|)). The ``FEATURES`` features whose ratio stands out most from its
sampling error are kept, scaled by r, and a logistic regression is fitted to them by Spark ML.
Scoring adds the weights of a text's features in numpy.

The model is fitted to a bounded sample: about ``SAMPLE_DOCS`` labelled documents of each class,
chosen by a hash of the id, with their whole texts. Rows are weighted by their class's share, so
scores are probabilities at the labels' own rate whatever the sample's.

Letters are lower-cased, every run of characters other than letters and digits is one space, and
texts start and end with one. Texts of any length are worked through in pieces that overlap by the
longest n-gram but one character, so no n-gram is lost, made up or counted twice.

Results for odd input: a missing or empty text has the score of the intercept; label rows without an
id or a label are not learned from, and of several labels of one id the largest counts; where only
one class is known every score is that class, and 0 where none is; repeated rows are scored alike; an
empty table gives an empty table; other columns do not matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiercast.llm.common import in_arrow, slices
from tiercast.operators.scratch import Scratch

GRAMS = (3, 4, 5)
BUCKET_BITS = 18
BUCKETS = 1 << BUCKET_BITS
# A bucket's features: that it occurs so often, or twice and at least once in so many characters.
COUNT_LEVELS = (1, 2, 4, 8)
RATE_LEVELS = (2048, 1024, 512)
LEVELS = len(COUNT_LEVELS) + len(RATE_LEVELS)
FEATURES = 4096
SAMPLE_DOCS = 4000
LEAST_DOCS = 3
SMOOTHING = 1.0
REGULARISATION, ROUNDS = 3e-3, 100
# Fixed value of the contract.
LEAST_SCORE = 0.3

# Characters of normalised text that numpy arrays hold at a time.
PIECE = 1 << 18
_OTHER = re.compile(r"[\W_]+")
_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class Model(NamedTuple):
    """``weights``: per feature, 0.0 for those left out."""

    weights: np.ndarray
    intercept: float


def normal(text: str) -> str:
    return f" {_OTHER.sub(' ', text.lower()).strip()} "


def hashed_grams(spaced: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The bucket of each n-gram of normalised texts and the number of its text, for pieces of
    bounded size."""
    held, owners, size = [], [], 0
    for i, text in enumerate(spaced):
        for start in range(0, len(text), PIECE):
            piece = text[start : start + PIECE + GRAMS[-1] - 1]
            held.append(np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32))
            owners.append(i)
            size += len(piece)
            if size >= PIECE:
                yield from _hashed(held, owners)
                held, owners, size = [], [], 0
    if held:
        yield from _hashed(held, owners)


def _hashed(pieces: list[np.ndarray], owners: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    piece = np.repeat(np.arange(len(pieces)), lengths)
    # What starts beyond a piece starts in the text's next one, too.
    own = np.arange(len(piece)) - np.repeat(np.cumsum(lengths) - lengths, lengths) < PIECE
    of = np.asarray(owners, np.int64)
    points = np.concatenate(pieces).astype(np.uint64) + np.uint64(1)
    gram = points
    for n in range(2, GRAMS[-1] + 1):
        gram = gram[:-1] * _STEP + points[n - 1 :]
        if n in GRAMS and len(gram):
            mixed = (gram ^ (gram >> np.uint64(29))) * _MIX
            inside = (piece[: len(gram)] == piece[n - 1 :]) & own[: len(gram)]
            buckets = (mixed >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
            yield buckets[inside], of[piece[: len(gram)][inside]]


def held_features(texts: list[str], wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(text, feature)`` of the wanted features each text holds, in order; ``wanted`` tells for
    every feature whether it is."""
    spaced = [normal(text) for text in texts]
    some = wanted.reshape(BUCKETS, LEVELS).any(axis=1)
    keys, counts = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for buckets, owner in hashed_grams(spaced):
        chosen = some[buckets]
        found = np.unique(owner[chosen] * BUCKETS + buckets[chosen], return_counts=True)
        keys.append(found[0])
        counts.append(found[1])
    pairs, places = np.unique(np.concatenate(keys), return_inverse=True)
    times = np.bincount(places, np.concatenate(counts), len(pairs))
    text, bucket = pairs // BUCKETS, pairs % BUCKETS
    sizes = np.fromiter(map(len, spaced), np.int64, len(spaced))
    reached = np.column_stack(
        [times >= n for n in COUNT_LEVELS]
        + [(times > 1) & (times * n >= sizes[text]) for n in RATE_LEVELS]
    )
    row, level = np.nonzero(reached)
    feature = bucket[row] * LEVELS + level
    kept = wanted[feature]
    return text[row][kept], feature[kept]


def _document_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts of a class hold each feature, for one task."""
    size = BUCKETS * LEVELS
    counts = np.zeros((2, size), np.int64)
    every = np.ones(size, bool)
    for part, texts in slices(batches, "text"):
        label = np.array(part.column("toxic").to_pylist(), np.int64)
        text, feature = held_features(texts, every)
        for of in (0, 1):
            counts[of] += np.bincount(feature[label[text] == of], minlength=size)
    used = np.flatnonzero(counts.any(axis=0))
    for start in range(0, len(used), 1 << 16):
        some = used[start : start + (1 << 16)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(some), pa.array(counts[0, some]), pa.array(counts[1, some])],
            ["feature", "others", "toxic"],
        )


def _counted(sample: DataFrame) -> np.ndarray:
    """Texts per class (others, toxic) and feature, of features that ``LEAST_DOCS`` texts hold. The
    collected rows are one per feature at most."""
    kind = "feature long, others long, toxic long"
    rows = (
        in_arrow(sample.select("text", "toxic"), _document_counts, kind)
        .groupBy("feature")
        .agg(F.sum("others").alias("others"), F.sum("toxic").alias("toxic"))
        .where(F.col("others") + F.col("toxic") >= LEAST_DOCS)
        .toArrow()
    )
    counts = np.zeros((2, BUCKETS * LEVELS))
    counts[:, rows["feature"].to_numpy()] = [rows["others"].to_numpy(), rows["toxic"].to_numpy()]
    return counts


def log_count_ratios(counts: np.ndarray, smoothing: float = SMOOTHING) -> np.ndarray:
    """The log-count ratio of every feature, from texts per class (others, toxic) and feature."""
    smoothed = counts + smoothing
    shares = smoothed / smoothed.sum(axis=1, keepdims=True)
    return np.log(shares[1]) - np.log(shares[0])


def chosen_features(counts: np.ndarray, ratios: np.ndarray, features: int) -> np.ndarray:
    """The features whose ratio is largest against its sampling error, in order of their number."""
    error = np.sqrt((1 / (counts + SMOOTHING)).sum(axis=0))
    evidence = np.where(counts.sum(axis=0) >= LEAST_DOCS, np.abs(ratios) / error, 0.0)
    best = np.argsort(-evidence, kind="stable")[:features]
    return np.sort(best[evidence[best] > 0])


def _sampled(docs: DataFrame, labels: DataFrame, sample_docs: int) -> tuple[DataFrame, dict]:
    """``(text, toxic, weight)`` of the sample, and the number of labels per class."""
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .groupBy("doc_id")
        .agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    )
    sizes = {row.toxic: row.n for row in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share, weight = F.lit(0), F.lit(0.0)
    for label, n in sizes.items():
        millionths = 1_000_000 if n <= sample_docs else sample_docs * 1_000_000 // n
        share = F.when(F.col("toxic") == label, millionths).otherwise(share)
        weight = F.when(F.col("toxic") == label, 1_000_000 / millionths).otherwise(weight)
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("toxicity")), 1_000_000)
    chosen = known.where(place < share).select("doc_id", "toxic", weight.alias("weight"))
    # About 2 x sample_docs rows of ids, whatever the size of the tables.
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id").select("text", "toxic", "weight"), sizes


def _features_of(sample: DataFrame, chosen: np.ndarray) -> DataFrame:
    """``(toxic, weight, held)``: the chosen features of each text, as strings."""
    wanted = np.zeros(BUCKETS * LEVELS, bool)
    wanted[chosen] = True

    def hold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, "text"):
            text, feature = held_features(texts, wanted)
            held = np.split(feature, np.searchsorted(text, np.arange(1, len(texts))))
            lists = pa.array([list(map(str, one.tolist())) for one in held], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays(
                [part.column("toxic"), part.column("weight"), lists], ["toxic", "weight", "held"]
            )

    return in_arrow(
        sample.select("text", "toxic", "weight"), hold, "toxic int, weight double, held array<string>"
    )


def train(
    docs: DataFrame, labels: DataFrame, scratch: Scratch, sample_docs: int = SAMPLE_DOCS
) -> Model:
    """A model from the texts of ``docs`` that ``labels`` marks in ``toxic``."""
    sample, sizes = _sampled(docs, labels, sample_docs)
    if len(sizes) < 2:
        return Model(np.zeros(BUCKETS * LEVELS), np.inf if 1 in sizes else -np.inf)
    sample = scratch.stage(sample, "toxicity-sample")
    counts = _counted(sample)
    ratios = log_count_ratios(counts)
    chosen = chosen_features(counts, ratios, FEATURES)
    if not len(chosen):
        return Model(np.zeros(BUCKETS * LEVELS), float(np.log(sizes[1] / sizes[0])))
    vocabulary = CountVectorizerModel.from_vocabulary(
        list(map(str, chosen.tolist())), inputCol="held", outputCol="binary", minTF=1.0
    ).setBinary(True)
    scaled = ElementwiseProduct(
        scalingVec=Vectors.dense(ratios[chosen]), inputCol="binary", outputCol="features"
    )
    held = scratch.stage(_features_of(sample, chosen), "toxicity-features")
    rows = scaled.transform(vocabulary.transform(held)).withColumn("label", F.col("toxic").cast("double"))
    fitted = LogisticRegression(
        weightCol="weight", regParam=REGULARISATION, maxIter=ROUNDS, standardization=False
        # One task: the sample is bounded, and sums are added in the same order in every run.
    ).fit(rows.select("features", "label", "weight").coalesce(1))
    weights = np.zeros(BUCKETS * LEVELS)
    weights[chosen] = fitted.coefficients.toArray() * ratios[chosen]
    return Model(weights, float(fitted.intercept))


def scores(model: Model, texts: list[str]) -> np.ndarray:
    """The probability that each text is toxic."""
    text, feature = held_features(texts, model.weights != 0)
    total = np.bincount(text, model.weights[feature], len(texts)) + model.intercept
    # Exact also far out, where exp() of one sign would overflow.
    small = np.exp(-np.abs(total))
    return np.where(total >= 0, 1 / (1 + small), small / (1 + small))


def predict(docs: DataFrame, model: Model, *others: str) -> DataFrame:
    """``doc_id, *others, score`` of every document, from its text alone."""
    narrow = docs.select("doc_id", *others, "text")
    broadcast = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, "text"):
            kept = {name: part.column(name) for name in ("doc_id", *others)}
            yield pa.RecordBatch.from_pydict(
                {**kept, "score": pa.array(scores(broadcast.value, texts))}
            )

    return in_arrow(narrow, score, narrow.drop("text").schema.add("score", "double"))


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def score_toxicity(
    docs: DataFrame, labels: DataFrame, scratch: Scratch | None = None
) -> DataFrame:
    """``doc_id, held_out, score, predicted``, learned from the labels that are not held out."""
    scratch = scratch or Scratch(docs.sparkSession)
    out = held_out(F.col("doc_id"))
    model = train(docs, labels.where(~out), scratch)
    scored = predict(docs.select("doc_id", "text", out.alias("held_out")), model, "held_out")
    return scored.withColumn("predicted", (F.col("score") >= LEAST_SCORE).cast("int"))
