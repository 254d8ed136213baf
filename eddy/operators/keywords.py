"""Keyword extraction as a set-based Spark job.

Plan shape of the term counts (per comment ``id``):

    scan -> posexplode(tokens) -> alpha + stopword filter      (narrow)
         -> groupBy(id, w) count/min(pos)   partial agg, shuffle on (id, w)
         -> row_number over (id) <= k       WindowGroupLimit keeps k rows per id
                                            on the map side, shuffle on id
         -> groupBy(id) collect k rows      reuses the id partitioning

A comment with a huge text spreads over all tasks in the (id, w) shuffle, and
only k rows per id and map task reach the window, so no task ever holds a
whole hot document's vocabulary.  Ties keep the word seen first, like a
stable most-common count.

``extract_keywords`` needs that only for ids that several rows share.  Any other id
has all its words in one text, so they are counted where the text is and only the k
keywords leave the task.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eddy.functions import text
from eddy.functions.text import ALPHA_TOKEN, alpha_words, english_stopwords, plain_tokens, raw_tokens

# Rows up to which a user-supplied stopword table is broadcast; a larger one
# goes through a plain anti-join.
MAX_STOPWORDS = 100_000
# Ids shared by several rows up to which their table is broadcast.
MAX_REPEATED = 100_000
SLICE_WORDS = 1 << 18      # words that a task counts at a time (a longer text by itself)


def token_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All tokens with their 0-based position: (id, pos, token)."""
    # The outer form keeps the optimizer from filtering on the array's size, for which
    # it would tokenize each text again; its row for an empty array goes with the where.
    return (docs.select(id_col, raw_tokens(F.col(text_col)).alias("_tokens"))
            .select(id_col, F.posexplode_outer("_tokens").alias("pos", "token"))
            .where(F.length("token") > 0))


def filter_stopwords(tokens: DataFrame, stopwords: Iterable[str] | DataFrame | None = None,
                     token_col: str = "token") -> DataFrame:
    """Keep alphabetic, non-stopword tokens.

    A word list becomes an ``InSet`` predicate inside the scan's codegen stage
    (no join).  A stopword *table* is broadcast if its size allows.
    """
    alpha = tokens.where(F.col(token_col).rlike(ALPHA_TOKEN))
    if isinstance(stopwords, DataFrame):
        stop = stopwords.select(F.col(stopwords.columns[0]).alias(token_col)).distinct()
        small = stopwords.count() <= MAX_STOPWORDS
        return alpha.join(F.broadcast(stop) if small else stop.hint("merge"), token_col, "left_anti")
    words = list(english_stopwords() if stopwords is None else stopwords)
    return alpha.where(~F.col(token_col).isin(words))


def term_frequencies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     stopwords=None) -> DataFrame:
    """(id, w, n, first_pos): per-comment term counts (T5)."""
    toks = filter_stopwords(token_rows(docs, id_col, text_col), stopwords)
    return (toks.groupBy(id_col, F.col("token").alias("w"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first_pos")))


def top_k_terms(tf: DataFrame, k: int = 3, id_col: str = "doc_id") -> DataFrame:
    """(id, rank, w, n): the k most frequent terms per comment."""
    order = Window.partitionBy(id_col).orderBy(F.desc("n"), F.asc("first_pos"))
    return (tf.withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= k)
            .select(id_col, "rank", "w", "n"))


def keyword_arrays(top: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, keywords array<string>) in rank order (T7).  Only comments with
    at least one keyword appear (P5 is implied by the inner shape)."""
    return (top.groupBy(id_col)
            .agg(F.sort_array(F.collect_list(F.struct("rank", "w"))).alias("_kw"))
            .select(id_col, F.transform("_kw", lambda x: x["w"]).alias("keywords")))


def text_keywords(docs: DataFrame, k: int = 3, id_col: str = "doc_id", text_col: str = "text", stopwords=None) -> DataFrame:
    """(id, keywords) of every row by itself; rows without a keyword are left out."""
    stop = frozenset(english_stopwords() if stopwords is None else stopwords)
    cloudpickle.register_pickle_by_value(text)      # executors need not have this package
    words = docs.select(id_col, alpha_words(F.col(text_col)).alias("keywords"))

    def slices(batches):
        for batch in batches:
            n = np.cumsum(pc.list_value_length(batch.column(1)).fill_null(0).to_numpy())
            cuts = np.unique(np.append(np.searchsorted(n, np.arange(0, n[-1] if len(n) else 0, SLICE_WORDS)), len(n)))
            for a, b in zip(cuts[:-1], cuts[1:]):
                yield batch.slice(a, b - a)

    def run(batches):
        for batch in slices(batches):
            at = np.repeat(np.arange(batch.num_rows), pc.list_value_length(batch.column(1)).fill_null(0).to_numpy())
            if not len(at):
                continue
            word = batch.column(1).flatten().dictionary_encode()
            # What is to be known of a word is found out once for each different one.
            number, terms, size = {}, [], []
            for w in word.dictionary.to_pylist():
                found = [t for t in plain_tokens(w) if t not in stop]
                terms += [number.setdefault(t, len(number)) for t in found]
                size.append(len(found))
            if not number:
                continue
            size, code = np.array(size), word.indices.to_numpy()
            many = size[code]
            at, begin = np.repeat(at, many), np.repeat((np.cumsum(size) - size)[code], many)
            code = np.array(terms)[begin + np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)]
            _, first, n = np.unique(at * len(number) + code, return_index=True, return_counts=True)
            order = np.lexsort((first, -n, at[first]))
            row = at[first[order]]
            kept = np.arange(len(row)) - np.searchsorted(row, row) < k
            rows, held = np.unique(row[kept], return_counts=True)
            top = pa.array(list(number), pa.string()).take(pa.array(code[first[order[kept]]]))
            arrays = pa.ListArray.from_arrays(pa.array(np.append(0, held.cumsum()), pa.int32()), top)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), arrays], names=[id_col, "keywords"])
    return words.mapInArrow(run, T.StructType([docs.schema[id_col], T.StructField("keywords", T.ArrayType(T.StringType()))]))


def extract_keywords(docs: DataFrame, k: int = 3, id_col: str = "doc_id",
                     text_col: str = "text", stopwords=None) -> DataFrame:
    """(id, keywords): the full keyword extractor (T1-T7).  The texts of rows with the
    same id (null is one as well) count as one comment."""
    def shared(rows: DataFrame) -> DataFrame:
        return keyword_arrays(top_k_terms(term_frequencies(rows, id_col, text_col, stopwords), k, id_col), id_col)
    valid = docs.where(F.col(text_col).isNotNull() & (F.length(text_col) > 0))
    if docs.isStreaming or isinstance(stopwords, DataFrame) or k < 1:
        return shared(valid)
    stopwords = None if stopwords is None else list(stopwords)
    repeated = docs.groupBy(F.col(id_col).alias("_id")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_id")
    n = repeated.limit(MAX_REPEATED + 1).count()
    if not n:
        return text_keywords(valid, k, id_col, text_col, stopwords)
    repeated = F.broadcast(repeated) if n <= MAX_REPEATED else repeated.hint("merge")
    same = F.col(id_col).eqNullSafe(F.col("_id"))
    return text_keywords(valid.join(repeated, same, "left_anti"), k, id_col, text_col, stopwords).unionByName(
        shared(valid.join(repeated, same, "left_semi")))
