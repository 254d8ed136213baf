"""Ties of the keyword ranking in the order of arrival, against the running fold."""

import random

from eddy.operators.arrival_ranking import arrival_ranking


def _fold(comments):
    """The running report: count, then sort by count, the sort being stable."""
    counts = {}
    for keywords in comments:
        for k in keywords:
            counts[k] = counts.get(k, 0) + 1
        counts = dict(sorted(counts.items(), key=lambda x: x[1], reverse=True))
    return list(counts.items())


def test_ranking_equals_the_running_fold(spark):
    """2,000 runs at once: each run has keywords and comments of its own."""
    rnd = random.Random(5)
    rows, want = [], {}
    for run in range(2000):
        words = [f"{w}{run}" for w in "abcdef"[: rnd.randint(2, 6)]]
        comments = [rnd.sample(words, rnd.randint(1, min(3, len(words)))) for _ in range(rnd.randint(1, 12))]
        if rnd.random() < 0.3:      # pairs that always come together
            comments = [[*c, f"x{run}", f"y{run}"] for c in comments]
        rows += [(run * 100 + i, c) for i, c in enumerate(comments)]
        want[run] = _fold(comments)
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, keywords array<string>").repartition(6)
    got = {}
    for r in arrival_ranking(df).orderBy("rank").collect():
        got.setdefault(int(r.keyword[1:]), []).append((r.keyword, r.n))
    assert got == want


def test_ranking_edges(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, ["a", "b"]), (4, ["b", "a"])], "doc_id long, keywords array<string>")
    assert [tuple(r) for r in arrival_ranking(df).orderBy("rank").collect()] == [("a", 2, 1), ("b", 2, 2)]
    assert arrival_ranking(df.limit(0)).count() == 0
