"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiercast.llm import oracle
from tiercast.llm.embeddings import near_vectors
from tiercast.llm.exact_dup import exact_groups
from tiercast.llm.html import extract_text
from tiercast.llm.langid import identify
from tiercast.llm.licenses import scan_licenses
from tiercast.llm.mixing import mix_sources
from tiercast.llm.near_dup import near_duplicates
from tiercast.llm.negatives import hard_negatives
from tiercast.llm.packing import pack
from tiercast.llm.ranked_search import ranked_documents
from tiercast.llm.token_files import read_back, write_tokens
from tiercast.llm.tokens import BYTE_BPE, WORD_BPE, tokenizer_path
from tiercast.llm.toxicity import score_toxicity
from tiercast.llm.urls import judge_urls
from tiercast.operators.scratch import Scratch

# Fixed values of the contracts.
PACK_END, FILE_END = 1, 2


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(_table(spark, sf_dir, "documents"))


def op2_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return pack(docs, tokenizer_path(WORD_BPE), PACK_END).drop("ids")


def op3_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_table(spark, sf_dir, "documents"))


def op5_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(_table(spark, sf_dir, "pages"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(_table(spark, sf_dir, "documents"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(_table(spark, sf_dir, "pages"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    docs = _table(spark, sf_dir, "documents")
    written = write_tokens(docs, scratch.path, tokenizer_path(BYTE_BPE), FILE_END)
    return read_back(scratch.stage(written, "manifest"))


def op10_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(_table(spark, sf_dir, "embeddings"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    turned = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    is_anchor = F.col("vec_id") % 100 == 0
    return hard_negatives(vectors.withColumn("label", turned), is_anchor)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_language_id,
        op2_curve_packing,
        op3_dart_minhash,
        op4_license_scan,
        op5_style_tree,
        op6_mixing,
        op7_exact_dedup,
        op8_url_filter,
        op9_token_files,
        op10_vector_dedup,
        op11_toxicity,
        op12_ranked_search,
        op13_hard_negatives,
    )
    return {query.__name__: query for query in found}


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
