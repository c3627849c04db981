"""The corpus pipeline: stages applied to the documents one after another.

Each stage reads what the one before it has written. All but the last return the columns of the
documents; the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tiercast.llm.exact_dup import drop_exact_duplicates
from tiercast.llm.langid import keep_identified
from tiercast.llm.mixing import mixed_documents
from tiercast.llm.near_dup import drop_near_duplicates
from tiercast.llm.packing import pack
from tiercast.llm.registry import PACK_END
from tiercast.llm.tokens import WORD_BPE, tokenizer_path
from tiercast.operators.scratch import Scratch


# The folders of staged tables that may still be read, and the application that owns them.
_held: list[tuple[str, Scratch]] = []


def _scratch(spark: SparkSession, docs: DataFrame) -> Scratch:
    """A folder for the tables that a stage stages.

    A stage's result is written before the next stage starts, so the folders of earlier stages go
    then, unless the documents are still read from them. The rest goes with the application.
    """
    owner, files = spark.sparkContext.applicationId, docs.inputFiles()
    for entry in list(_held):
        application, old = entry
        if application != owner or not any(_folder(old.path) in _folder(f) for f in files):
            _held.remove(entry)
            if application == owner:
                old.remove()
    _held.append((owner, Scratch(spark)))
    return _held[-1][1]


def _folder(path: str) -> str:
    """A path without its scheme, which listings may spell differently."""
    return path.split(":", 1)[-1].lstrip("/")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; those without letters or with a low score go."""
    _scratch(spark, docs)
    return keep_identified(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_exact_duplicates(docs, _scratch(spark, docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return drop_near_duplicates(docs, scratch=_scratch(spark, docs))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the target weights of their sources ask for."""
    return mixed_documents(docs, _scratch(spark, docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences, with their token ids."""
    return pack(docs, tokenizer_path(WORD_BPE), PACK_END, scratch=_scratch(spark, docs))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

# Naive Bayes scores and tokenizers are beyond SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written as Parquet and read again."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.stage(stage(spark, docs, sf_dir), name)
    return docs
