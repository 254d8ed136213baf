"""The fused enrichment plan: language -> sentiment -> keywords.

The reference chains three services over three topics, each copying the row
and appending one field.  Here the three per-comment results are computed
from one scan and joined on the comment id.  Each result leaves its last
aggregate hash-partitioned on the id, so the joins line up without moving
the text again; only the id and the three new fields travel.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eddy.operators.keywords import extract_keywords
from eddy.operators.language import detect_language
from eddy.operators.sentiment import analyze_sentiment


def enrich(docs: DataFrame, profile: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           k: int = 3, lex: DataFrame | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """(id, keep..., language, compound, sentiment, keywords) for every row.

    ``keywords`` is an empty array for rows without a keyword; such rows are
    not counted by the report.
    """
    lang = detect_language(docs, profile, id_col, text_col)
    sent = analyze_sentiment(docs, id_col, text_col, lex)
    kw = extract_keywords(docs, k, id_col, text_col)
    # Per-comment results, all hash-partitioned on the id: sort-merge joins
    # (never a broadcast of a side that grows with the data).
    base = lang.join(sent.hint("merge"), id_col).join(kw.hint("merge"), id_col, "left")
    if keep:
        base = docs.select(id_col, *keep).join(base.hint("merge"), id_col)
    empty = F.array().cast("array<string>")
    return base.select(id_col, *keep, "language", "compound", "sentiment",
                       F.coalesce(F.col("keywords"), empty).alias("keywords"))


def reportable_enriched(docs: DataFrame, profile: DataFrame, id_col: str = "doc_id",
                        text_col: str = "text", k: int = 3, lex: DataFrame | None = None) -> DataFrame:
    """Only the comments the report counts (>= 1 keyword): the keyword
    result drives the joins, so comments without keywords are never
    carried through them."""
    kw = extract_keywords(docs, k, id_col, text_col)
    lang = detect_language(docs, profile, id_col, text_col)
    sent = analyze_sentiment(docs, id_col, text_col, lex)
    return (kw.join(lang.hint("merge"), id_col).join(sent.hint("merge"), id_col)
            .select(id_col, "language", "sentiment", "keywords"))
