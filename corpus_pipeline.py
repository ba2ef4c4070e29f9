"""The corpus pipeline: language, exact copies, near copies, benchmark passages, token ids.

``STAGES`` are applied in order; each stage's rows are written as Parquet and read back as the
next stage's documents.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from claimscope.llm.common import table, written
from claimscope.llm.decontaminate import decontaminate
from claimscope.llm.exact import exact_dedup
from claimscope.llm.langid import keep_identified
from claimscope.llm.plans import ARROW
from claimscope.llm.sentencepiece import encode, load_pieces
from claimscope.llm.simhash import simhash_dedup


def _small_batches(spark: SparkSession) -> None:
    for key, value in ARROW.items():
        spark.conf.set(key, value)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; the model learns from the stage's own input."""
    _small_batches(spark)
    return keep_identified(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of the documents that are equal without white space."""
    return exact_dedup(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked SimHash fingerprints (4-word shingles, 4 bits)."""
    _small_batches(spark)
    return simhash_dedup(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words are in benchmark windows."""
    _small_batches(spark)
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and SentencePiece ids of what is left."""
    _small_batches(spark)
    pieces = load_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    return encode(docs, pieces).select("doc_id", "n_tokens", "ids")


STAGES = [
    ("language ID", language),
    ("exact dedup", exact_copies),
    ("SimHash near-dedup", near_copies),
    ("benchmark decontamination", benchmark_passages),
    ("SentencePiece encoding", token_ids),
]

#: Fingerprints, suffix search and the language model are not SQL: the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
