"""Induced lexicon against a plain fixed-point iteration."""

import math
import random
from collections import Counter

import pytest

from eddy.operators import lexicon as lx
from eddy.operators.sentiment import sentiment_scores


def _edges(texts):
    n, s = Counter(), Counter()
    for t in texts:
        w = t.split()
        for i, a in enumerate(w):
            for b in w[i + 1:i + 1 + lx.REACH]:
                if a != b:
                    n[min(a, b), max(a, b)] += 1
    for (a, b), c in n.items():
        s[a] += c
        s[b] += c
    total = sum(s.values())
    out = {}
    for (a, b), c in n.items():
        w = math.log(c * total / (s[a] * s[b]))
        if c >= lx.LEAST and w > 0:
            out[a, b] = out[b, a] = w
    return out


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(2)
    good, bad, plain = ([f"{p}{c}" for c in "abcdefgh"] for p in ("joy", "woe", "it"))
    rows = []
    for _ in range(300):
        side = rnd.choice([good, bad])
        rows.append(" ".join(rnd.choice(side if rnd.random() < 0.5 else plain) for _ in range(12)))
    return rows


def test_fixed_point_equals_a_plain_iteration(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    want = _edges(texts)
    got = {(r.a, r.b): r.weight for r in lx.word_edges(df).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-5 for k in want)
    seeds = {"joya": 3.0, "woea": -3.0}
    v = dict(seeds)
    for _ in range(200):
        new = {}
        for w in {a for a, _ in want}:
            near = [(x, v.get(b, 0.0)) for (a, b), x in want.items() if a == w]
            new[w] = lx.DAMPING * sum(x * y for x, y in near) / sum(x for x, _ in near)
        v = new | seeds
    lex = lx.induce(df, spark.createDataFrame(list(seeds.items()), "word string, valence double"))
    got = {r.word: r.valence for r in lex.collect()}
    assert all(abs(got.get(w, 0.0) - x) < 0.06 for w, x in v.items())
    assert all(got[f"joy{c}"] > 0 > got[f"woe{c}"] for c in "abcdefgh")
    # it is a lexicon of the scorer: most texts get a score, and the right sign
    scores = {r.doc_id: r.compound for r in sentiment_scores(df, lex=lex).collect()}
    assert sum(s != 0 for s in scores.values()) > 0.95 * len(texts)
    right = [(scores[i] > 0) == ("joy" in t) for i, t in enumerate(texts) if ("joy" in t) != ("woe" in t)]
    assert sum(right) > 0.95 * len(right)


def test_empty_input(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    seeds = spark.createDataFrame([("a", 1.0)], "word string, valence double")
    assert [tuple(r)[:2] for r in lx.induce(none, seeds).collect()] == [("a", 1.0)]
    assert lx.induce(none, seeds.limit(0)).count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert lx.labelled_seeds(none, labels).count() == 0
