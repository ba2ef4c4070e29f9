"""Registered queries of the text operators: ``opN_<name>`` over the whole tables, and ``pipeline``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import clustering, collocations, exact, licenses
from .common import table
from .decontaminate import decontamination_report
from .langid import language_report
from .packing import packing_report
from .secrets import secrets_report, vocabulary_words
from .sentencepiece import sentencepiece_report
from .simhash import simhash_report
from .substring import substring_report
from .tokens import tokens_report
from .toxicity import toxicity_report

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


#: Documents may be long: small Arrow batches bound the memory of a task, in the JVM and in Python.
ARROW = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}


def query(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            for key, value in ARROW.items():
                spark.conf.set(key, value)
            return fn(spark, sf_dir)

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@query("op8_benchmark_decontamination")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op9_simhash_near_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_report(table(spark, sf_dir, "documents"))


@query("op4_substring_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_report(table(spark, sf_dir, "documents"))


@query("op5_exact_dedup", exact.ORACLE)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op10_language_id")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_report(table(spark, sf_dir, "documents"))


@query("op7_secret_scan")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = vocabulary_words(public_tokenizers.path("word_bpe_49k.json"))
    return secrets_report(table(spark, sf_dir, "documents"), words)


@query("op3_toxicity")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op2_token_output")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens_report(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op1_sentencepiece")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_report(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op6_license_scan", licenses.ORACLE)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(table(spark, sf_dir, "documents"))


@query("op11_centroid_clustering", clustering.ORACLE)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.clusters_report(table(spark, sf_dir, "embeddings"))


@query("op12_phrase_collocations", collocations.ORACLE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query("op13_best_fit_packing")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing_report(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
