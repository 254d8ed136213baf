"""Rounds over arrays of edges against rounds of joins."""

import random

import numpy as np
import pytest

from eddy.functions import near
from eddy.operators import lexicon as lx


@pytest.fixture(scope="module")
def docs(spark):
    rnd = random.Random(11)
    sides = [[f"{p}{c}" for c in "abcdefghij"] for p in ("joy", "woe", "été")]
    rows = [" ".join(rnd.choice(sides[i % 3] if rnd.random() < 0.8 else rnd.choice(sides)) for _ in range(15)) for i in range(200)]
    return spark.createDataFrame([(t,) for t in rows + rows[:5] + [None, ""]], "text string").repartition(3)


SETTLED = 0.7
SEEDS = [("joya", 3.0), ("joya", -1.0), ("woea", -3.0), ("étéa", None), ("nowhere", 1.0), ("faint", 0.001), (None, 2.0)]


def _rows(df):
    return {r.word: (r.valence, r.scalar, r.negation) for r in df.collect()}


@pytest.mark.parametrize("how", ["plain", "small rows", "too many nodes", "too many words"])
def test_rounds_equal_plain_ones(spark, monkeypatch, docs, how):
    edges = lx.word_edges(docs).collect()
    seeds = SEEDS[:-1] if how == "plain" else SEEDS      # one without a word moves in every round
    given = {"joya": 3.0, "woea": -3.0, "nowhere": 1.0}
    words = sorted({r.a for r in edges})
    at = {w: i for i, w in enumerate(words)}
    m = np.zeros((len(words), len(words)))
    for r in edges:
        m[at[r.a], at[r.b]] = r.weight
    now = np.array([given.get(w, 0.0) for w in words])
    for _ in range(7):         # 3 * 0.8 ** 7 < 0.7
        new = np.round(lx.DAMPING * (m @ now) / m.sum(axis=1), 6)
        for w in ("joya", "woea", "étéa"):
            new[at[w]] = given.get(w, 0.0)
        moved, now = abs(new - now).max(initial=max(abs(v) for w, v in seeds if w is None) if how != "plain" else 0.0), new
        if moved < SETTLED:
            break
    want = {w: v for w, v in zip(words, now) if abs(v) >= lx.FAINT} | {w: v for w, v in seeds if w in ("nowhere", None)}
    if how == "small rows":
        for name, size in (("SLICE_EDGES", 7), ("ROWS", 3)):
            monkeypatch.setattr(near, name, size)
        monkeypatch.setattr(lx, "PART_EDGES", 5)
    elif how == "too many nodes":
        monkeypatch.setattr(lx, "MAX_NODES", 5)
    elif how == "too many words":
        monkeypatch.setattr(near, "MAX_SHARED", 2)
        monkeypatch.setattr(near, "plain_codes", lambda h, bits: h % np.uint64(3))
    got = _rows(lx.induce(docs, spark.createDataFrame(seeds, "word string, valence double"), settled=SETTLED))
    assert got.keys() == want.keys() and all(abs(v - want[w]) < 1e-5 and (x, y) == (0.0, 0) for w, (v, x, y) in got.items())


def test_rounds_do_not_deal_out_the_edges(spark, monkeypatch, docs):
    names, stages = [], []
    keep, one = lx._kept, near.one_round
    monkeypatch.setattr(lx, "_kept", lambda df, name: names.append(name) or keep(df, name))
    monkeypatch.setattr(near, "one_round", lambda *a: stages.append(a) or one(*a))
    lx.induce(docs, spark.createDataFrame(SEEDS[:3], "word string, valence double"))
    assert len(stages) > 5 and "lexicon-graph" in names and "lexicon-round" not in names and "lexicon-edges" not in names


def test_faint_seeds_take_no_round(spark, docs):
    got = _rows(lx.induce(docs, spark.createDataFrame([("joya", 0.009)], "word string, valence double")))
    assert got == {"joya": (0.009, 0.0, 0)}
