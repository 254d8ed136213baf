"""The running report: counts by language, sentiment and keyword (A1-A4, L1, L2).

The reference folds one JSON file per message; here the report is a set of
grouped counts over the enriched comments.  Every count is a partial + final
hash aggregate, so a key holding a third of all rows (``en``, ``Positive``, a
very common keyword) costs one row per map task in the shuffle.

Only comments with at least one keyword reach the report (the keyword stage
drops the others before the reporter sees them).

Long form: (dimension, key, n, rank) with rank = 1 for the largest count and
ties broken by key, which is deterministic across partitions.  (The reference's
own tie order depends on message arrival; reproducing it needs every
occurrence offset of a keyword in one list, an unbounded group, so it is not
offered.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eddy.operators.ranking import global_rank
from eddy.session import cut_lineage

TOP_KEYWORDS = 10


def reportable(enriched: DataFrame) -> DataFrame:
    """Rows the reporter counts: at least one keyword (P5)."""
    return enriched.where(F.size("keywords") > 0)


def language_counts(enriched: DataFrame) -> DataFrame:
    """A1: (language, n)."""
    return reportable(enriched).groupBy("language").agg(F.count(F.lit(1)).alias("n"))


def sentiment_counts(enriched: DataFrame) -> DataFrame:
    """A2: (sentiment, n)."""
    return reportable(enriched).groupBy("sentiment").agg(F.count(F.lit(1)).alias("n"))


def keyword_counts(enriched: DataFrame) -> DataFrame:
    """A3: (keyword, n) over the keyword arrays."""
    return (reportable(enriched).select(F.explode("keywords").alias("keyword"))
            .groupBy("keyword").agg(F.count(F.lit(1)).alias("n")))


def rank_counts(counts: DataFrame, key: str) -> DataFrame:
    """L2: add rank by (n desc, key asc), computed without a
    single-partition window (see ``eddy.operators.ranking``)."""
    return global_rank(counts, [F.desc("n"), F.asc(key)])


def rank_small(counts: DataFrame, key: str) -> DataFrame:
    """Rank for dimensions whose key set is bounded by the model (languages
    in the profile, two sentiment labels, a top-k list): one ordered window
    over at most a few hundred aggregated rows."""
    order = Window.orderBy(F.desc("n"), F.asc(key))
    return counts.withColumn("rank", F.row_number().over(order).cast("long"))


def top_keywords(enriched: DataFrame, k: int = TOP_KEYWORDS) -> DataFrame:
    """L1: the k most frequent keywords with rank (TakeOrderedAndProject)."""
    top = keyword_counts(enriched).orderBy(F.desc("n"), F.asc("keyword")).limit(k)
    return rank_small(top, "keyword")


def report_long(enriched: DataFrame, k: int = TOP_KEYWORDS, materialize: bool = True) -> DataFrame:
    """A4: the whole report as (dimension, key, n, rank).

    The enriched input feeds four aggregates; with ``materialize`` its
    reportable rows (id-free: language, sentiment, keywords) are written once
    to the checkpoint folder, as the reference's keyword topic would hold
    them, instead of being recomputed per dimension."""
    if materialize:
        enriched = cut_lineage(reportable(enriched).select("language", "sentiment", "keywords"))

    def dim(ranked: DataFrame, name: str, key: str) -> DataFrame:
        return ranked.select(F.lit(name).alias("dimension"), F.col(key).alias("key"), "n", "rank")
    ranked_kw = rank_counts(keyword_counts(enriched), "keyword")
    return (dim(rank_small(language_counts(enriched), "language"), "languages", "language")
            .unionByName(dim(rank_small(sentiment_counts(enriched), "sentiment"), "sentiments", "sentiment"))
            .unionByName(dim(ranked_kw, "keywords", "keyword"))
            .unionByName(dim(ranked_kw.where(F.col("rank") <= k), "top_keywords", "keyword")))


def report_json(long: DataFrame) -> DataFrame:
    """Render the report as JSON lines, one per (dimension, key).

    The reference writes one nested document; a single document holding the
    whole keyword dimension would be one unbounded value, so each entry is its
    own line and readers order by (dimension, rank).
    """
    return long.select(F.to_json(F.struct("dimension", "key", "n", "rank")).alias("json"))
