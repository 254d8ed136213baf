"""Thin registered queries, one an operator, over their whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eddy.llm import (bpe, cdc_dedup, embedding_dedup, filter_audit, html_extract, licenses, merkle, mixing, ngram_jaccard,
                       nn_descent, suffix_dedup, toxicity, url_filter)
from eddy.session import read_table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(read_table(spark, sf_dir, "pages"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).withColumn(
        "held_out", F.coalesce(toxicity.fold("doc_id") == toxicity.HELD_OUT, F.lit(False))).select(
        "doc_id", "held_out", "score", "predicted")


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.groups(read_table(spark, sf_dir, "documents"))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_groups(read_table(spark, sf_dir, "embeddings"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(read_table(spark, sf_dir, "documents"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(read_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read_table(spark, sf_dir, "documents")).drop("spans")


def op9_cdc_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc_dedup.digest(read_table(spark, sf_dir, "documents"))


def op10_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.nearest(read_table(spark, sf_dir, "embeddings"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tamper_check(read_table(spark, sf_dir, "documents"))


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read_table(spark, sf_dir, "pages"))


QUERIES = {
    "op1_html_extraction": op1_html_extraction,
    "op2_toxicity": op2_toxicity,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_mixing": op5_mixing,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_bpe": op7_bpe,
    "op8_licenses": op8_licenses,
    "op9_cdc_dedup": op9_cdc_dedup,
    "op10_nn_descent": op10_nn_descent,
    "op11_filter_audit": op11_filter_audit,
    "op12_merkle": op12_merkle,
    "op13_url_filter": op13_url_filter,
}
ORACLE = {
    "op5_mixing": mixing.ORACLE,
    "op11_filter_audit": filter_audit.ORACLE,
    "op12_merkle": merkle.ORACLE,
    "op13_url_filter": url_filter.ORACLE,
}
