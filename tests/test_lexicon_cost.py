"""Only pairs that occur often are stored."""

from eddy.operators import lexicon as lx


def test_rare_pairs_are_not_stored(spark, monkeypatch):
    kept = {}
    keep = lx._kept
    monkeypatch.setattr(lx, "_kept", lambda df, name: kept.setdefault(name, keep(df, name)))
    docs = spark.createDataFrame([("good boat",)] * 3 + [("good ship",), ("rare pair",)], "text string")
    edges = lx.word_edges(docs)
    assert [(r.a, r.b, r.n) for r in kept["lexicon-pairs"].collect()] == [("boat", "good", 3)]
    assert {r.a: r.s for r in kept["lexicon-words"].collect()} == {"good": 4, "boat": 3, "ship": 1, "rare": 1, "pair": 1}
    assert {(r.a, r.b, r.n) for r in edges.collect()} == {("boat", "good", 3), ("good", "boat", 3)}
