"""A training-corpus pipeline of five stages, each one an operator of ``eddy.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each
stage's rows as Parquet in the shared folder and hands them to the next.  All
stages but the last return the columns of ``documents``, further ones and their names
included.  Every stage takes empty tables, which stay empty, and rows with nulls in
any column, empty or very long texts and repeated ids, as its docstring says.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eddy.llm import bpe, mixing, ngram_jaccard, suffix_dedup, toxicity
from eddy.llm.common import written
from eddy.session import read_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go.  It is fitted on the labelled rows
    that are left of ``labels``; without any it rejects nothing.  A null or empty text
    scores by the model's bias alone."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document with the smallest id stays.  Null,
    empty and wordless texts have no copies and stay, as do rows without an id."""
    return ngram_jaccard.keep_first(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes that repeat an earlier string of 100 bytes are cut out; rows stay, null
    texts as null, and a null id comes after all others.  ``n_chars`` is counted anew."""
    out = suffix_dedup.dedup(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it.  A null source is a source; null,
    empty and wordless texts have no words to take and go."""
    out = mixing.mixed(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left; a null text counts as empty."""
    return bpe.digest(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_copies),
    ("suffix_dedup", cut_repeats),
    ("mixing", mix_sources),
    ("bpe", tokenize),
]

# Trained models and hash signatures are beyond SQL; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the whole ``documents`` table."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
