"""Words are counted as they stand before any expression looks at them."""

from eddy.operators import sentences as sn


def test_words_are_counted_before_they_are_looked_at(spark):
    docs = spark.createDataFrame([(1, "Dr. Ben met (Dr. Ben) and ben. The end."), (2, None), (3, " ")], "doc_id long, text string")
    seen = sn.seen_words(sn.words(docs))
    assert sorted((r.word, r.next or "", r.n) for r in seen.collect()) == sorted([
        ("Dr.", "Ben", 1), ("Ben", "", 1), ("met", "", 1), ("(Dr.", "Ben)", 1), ("Ben)", "", 1), ("and", "", 1), ("ben.", "The", 1),
        ("The", "", 1), ("end.", "", 1)])
    got = {r.type: (r.n, r.with_period, r.capital) for r in sn.period_counts(seen).collect()}
    assert got == {"dr": (2, 2, 1), "ben": (3, 1, 1), "met": (1, 0, 0), "and": (1, 0, 0), "the": (1, 0, 1), "end": (1, 1, 0)}
