"""Keyword ranking with ties in the order of arrival (L3), without a sequential fold.

The running report keeps its keywords sorted by count after every comment, and the
sort is stable.  So of two keywords of equal final count, the one that reached that
count first stands first; if one comment brought both there, the one that reached the
count before it first, and so on back to their first occurrence, where the order in
the comment decides.

Occurrences of all keywords are numbered from the last back by one range sort over all
tasks.  Keywords are then tied only if they have the same count and the same last
comment, so a tie is no larger than the number of keywords of a comment; tied pairs
meet occurrence by occurrence in an equi-join on (keyword, number), and the first
difference from the back is a minimum with a partial aggregate.  The occurrences of a
hot keyword are spread over all tasks throughout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eddy.operators.ranking import global_rank
from eddy.session import scratch_path


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def occurrences(enriched: DataFrame, id_col: str = "doc_id", keywords_col: str = "keywords") -> DataFrame:
    """(keyword, t, place, back): each occurrence with the comment's id, the keyword's
    place in it and its number from the keyword's last occurrence (0) back.  A
    keyword counts once in a comment, at its first place."""
    rows = enriched.select(F.col(id_col).alias("t"), F.posexplode(keywords_col).alias("place", "keyword")).groupBy(
        "keyword", "t").agg(F.min("place").alias("place"))
    ranked = _kept(global_rank(rows, [F.asc("keyword"), F.asc("t")], "i"), "ranking-rows")
    last = ranked.groupBy("keyword").agg(F.max("i").alias("last"))
    return _kept(ranked.join(last.hint("merge"), "keyword").select("keyword", "t", "place", (F.col("last") - F.col("i")).alias("back")),
                 "ranking-occurrences")


def arrival_ranking(enriched: DataFrame, id_col: str = "doc_id", keywords_col: str = "keywords") -> DataFrame:
    """(keyword, n, rank): keywords by count, ties as the running report has them
    when comments arrive in the order of their ids.  Null or empty keyword lists add
    nothing; an empty table gives no rows."""
    occ = occurrences(enriched, id_col, keywords_col)
    key = occ.groupBy("keyword").agg(F.count(F.lit(1)).alias("n"), F.max("t").alias("t"))
    group = key.groupBy("n", "t").agg(F.collect_list("keyword").alias("tied")).where(F.size("tied") > 1)
    # At most as many keywords as one comment has, so few pairs a tie.
    pair = group.select(F.explode("tied").alias("a"), "tied").select("a", F.explode("tied").alias("b")).where("a < b")
    pair = _kept(pair, "ranking-pairs")
    side = occ.select("keyword", "back", "t", "place")
    first = side.toDF("a", "back", "t1", "p1")
    both = pair.join(first, "a").join(side.toDF("b", "back", "t2", "p2"), ["b", "back"])
    # The first difference from the back; without one, the places in the first comment.
    ahead = F.when(F.col("t1") != F.col("t2"), F.col("t1") < F.col("t2")).otherwise(F.col("p1") < F.col("p2"))
    same = (F.col("t1") == F.col("t2")).cast("int")
    won = both.groupBy("a", "b").agg(F.min(F.struct(
        same.alias("same"), F.when(same == 0, F.col("back")).otherwise(-F.col("back")).alias("at"), ahead.alias("ahead"))).alias("m"))
    wins = won.select(F.when(F.col("m.ahead"), F.col("a")).otherwise(F.col("b")).alias("keyword")).groupBy("keyword").agg(
        F.count(F.lit(1)).alias("wins"))
    order = key.join(wins, "keyword", "left").withColumn("wins", F.coalesce("wins", F.lit(0)))
    return global_rank(order, [F.desc("n"), F.asc("t"), F.desc("wins"), F.asc("keyword")], "rank").select("keyword", "n", "rank")
