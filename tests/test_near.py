"""Words and pairs counted as numbers against the same rules in Spark and in Python."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from eddy.functions import near
from eddy.operators import lexicon as lx

ODD = ["", "  ", "a", "'tis 'a' a' 'ab don't", "The, THE (the) the.\n\tthe", "x1 1x a1b 12 ab1", "«Été» l'été été… ÉTÉ!",
       "Straße straße STRASSE", "İstanbul Σίσυφος ΟΔΟΣ", "no break line sep\u0085ab", "z\x0bvt\x0cff\rcr\x1cfs", "日本 日本語, ab́c ǅa ªº ⅷⅷ ٣ab",
       "-ab- --ab'cd-- ab-cd ab_cd _ab", "𝒜𝒷 𐐀𐐨 😀ab ab😀cd", "''' 'ab' ab''", None]


def _pairs(texts, reach=lx.REACH):
    n = Counter()
    for w in texts:
        for i, a in enumerate(w):
            n.update((min(a, b), max(a, b)) for b in w[i + 1:i + 1 + reach] if a != b)
    return n


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(5)
    words = [f"{a}{b}" for a in "bdéß" for b in "aeiouy'"] + ["1st", "hm,", "(ok)"]
    return [" ".join(rnd.choice(words) for _ in range(rnd.choice([0, 1, 3, 40]))) for _ in range(120)] + [" ".join(words * 9)]


def test_words_are_those_of_the_expression(spark):
    df = spark.createDataFrame(list(enumerate(ODD)), "id int, text string").coalesce(1)
    want = [r.w for r in df.orderBy("id").select(lx._words("text").alias("w")).collect()]
    low = [r.t for r in df.orderBy("id").select(F.lower(F.coalesce("text", F.lit(""))).alias("t")).collect()]
    row, at, words = near.split_words(pa.array(low), near.letter_kinds(spark))
    names = words.to_pylist()
    got = [[] for _ in low]
    for r, k in zip(row, at):
        got[r].append(names[k])
    assert got == want and len(set(names)) == len(names)


def test_borders_hold_exactly_the_letters(spark):
    letters = near._among([chr(c) for c in range(0x3000)], near.letter_kinds(spark)[0])
    asked = spark.createDataFrame([(chr(c),) for c in range(0x3000)], "c string").where(F.col("c").rlike(r"\p{L}")).collect()
    assert letters == {r.c for r in asked}


def test_blocks_keep_keys_and_counts():
    rnd = np.random.default_rng(1)
    for bits in (2, 11, 32):
        keys = np.sort(rnd.integers(0, (1 << 2 * bits) - 1, 5000, dtype=np.uint64, endpoint=True))
        got = [near.unpacked(b) for _, b in near.blocks(keys, bits, 7)]
        want, n = np.unique(keys, return_counts=True)
        assert (np.concatenate([k for k, _ in got]) == want).all() and (np.concatenate([c for _, c in got]) == n).all()
        for part, block in near.blocks(keys, bits, 7):
            assert all(int(k) * 7 >> 2 * bits == part for k in near.unpacked(block)[0])
        x, y = (rnd.integers(0, 1 << bits, 1000, dtype=np.uint64) for _ in range(2))
        a, b = near.key_codes(near.pair_keys(x, y, bits), bits)
        assert (a == np.minimum(x, y)).all() and (b == np.maximum(x, y)).all() and (near.pair_keys(x, y, bits) == near.pair_keys(y, x, bits)).all()
        assert near.pair_keys(x, y, bits).max() < 1 << 2 * bits


@pytest.mark.parametrize("how", ["plain", "small slices", "equal bits", "equal hashes first", "too many words"])
def test_edges_whatever_the_slices_and_codes(spark, monkeypatch, texts, how):
    """Slices of a few words; words that share their bits or, under the first key, their
    whole hash; and more words than codes."""
    if how == "small slices":
        for name, size in (("PIECE_BYTES", 64), ("WINDOW", 5), ("SLICE_PAIRS", 16), ("ROWS", 3)):
            monkeypatch.setattr(near, name, size)
    elif how == "equal bits":
        monkeypatch.setattr(near, "plain_codes", lambda h, bits: h % np.uint64(3))
    elif how == "equal hashes first":
        bad = [True]
        keep = lx._coded

        def coded(words, key, shared, bits):
            if bad:
                bad.pop()
                return words.select("a", "s", F.lit(1).cast("long").alias("hash"), F.lit(5).cast("long").alias("code"))
            return keep(words, key, shared, bits)
        monkeypatch.setattr(lx, "_coded", coded)
    elif how == "too many words":
        monkeypatch.setattr(near, "MAX_SHARED", 2)
        monkeypatch.setattr(near, "plain_codes", lambda h, bits: h % np.uint64(3))
    df = spark.createDataFrame([(t,) for t in texts + [None]], "text string").repartition(3)
    words = [r.w for r in df.select(lx._words("text").alias("w")).collect()]
    want = {p: n for p, n in _pairs(words).items() if n >= lx.LEAST}
    got = lx.word_edges(df).collect()
    assert {(r.a, r.b): r.n for r in got if r.a < r.b}.items() <= want.items()
    s = Counter()
    for (a, b), n in _pairs(words).items():
        s[a] += n
        s[b] += n
    weight = {p: np.log(n * s.total() / (s[p[0]] * s[p[1]])) for p, n in want.items()}
    positive = {p for p, w in weight.items() if round(w, 6) > 0}
    assert {(r.a, r.b) for r in got} == positive | {(b, a) for a, b in positive} and len(got) == 2 * len(positive)
    assert all(abs(r.weight - weight[min(r.a, r.b), max(r.a, r.b)]) < 1e-5 for r in got)


def test_pairs_are_not_rows_before_they_are_counted(spark, monkeypatch, texts):
    plans = {}
    keep = lx._kept
    monkeypatch.setattr(lx, "_kept", lambda df, name: plans.setdefault(name, df._jdf.queryExecution().toString()) and keep(df, name))
    lx.word_edges(spark.createDataFrame([(t,) for t in texts], "text string"))
    assert plans.keys() == {"lexicon-words", "lexicon-pairs"} and not any("Generate" in p for p in plans.values())


def test_seeds_are_counted_by_text(spark, monkeypatch):
    """Counts over pieces of a few texts equal a plain count; ids that come twice, none and
    ids without a label."""
    monkeypatch.setattr(near, "PIECE_BYTES", 40)
    rnd = random.Random(3)
    rows, labels = [], []
    for i in range(200):
        toxic = i % 2
        rows.append((i // 2 if i < 20 else i, " ".join(rnd.choice(["bad", "bad!", "x1", "it"] if toxic else ["good", "it", "Good,"]) for _ in range(6))))
        labels += [(i, 1 - toxic, toxic), (i, None, None)] if i % 5 else []
    docs = spark.createDataFrame(rows + [(None, "bad bad"), (7, None)], "doc_id long, text string").repartition(4)
    got = {r.word: r.valence for r in lx.labelled_seeds(docs, spark.createDataFrame(labels + [(None, 1, 0)], "doc_id long, quality int, toxic int")).collect()}
    known = {i: (t or 0, int(q == 1 and t == 0)) for i, q, t in labels if q is not None}
    held, of = Counter(), Counter()
    for i, text in rows + [(7, "")]:
        if i in known:
            of.update({"n": 1, "bad": known[i][0], "good": known[i][1]})
            for w in {x.strip("!,") for x in text.lower().split()} - {"x1"}:
                held.update({(w, "n"): 1, (w, "bad"): known[i][0], (w, "good"): known[i][1]})

    def odds(w, c):
        return np.log((held[w, c] + 0.5) / (of[c] + 1) / ((held[w, "n"] - held[w, c] + 0.5) / (of["n"] - of[c] + 1)))
    want = {w: -lx.SEED if odds(w, "bad") >= lx.ODDS else lx.SEED if odds(w, "good") >= lx.ODDS else None for w in ("bad", "good", "it")}
    assert got == {w: v for w, v in want.items() if v is not None} and set(got) == {"bad", "good"}


def test_a_step_reads_its_edges_once(spark, monkeypatch):
    edges = spark.createDataFrame([("a", "b", 3, 1.0), ("b", "a", 3, 1.0), ("a", "c", 3, 3.0), ("c", "a", 3, 3.0), ("c", "d", 5, 1.0), ("d", "c", 5, 1.0)],
                                  "a string, b string, n long, weight double")
    seeds = spark.createDataFrame([("b", 2.0), ("zz", -1.0)], "word string, valence double")
    for few in (lx.MAX_FEW, 0):
        monkeypatch.setattr(lx, "MAX_FEW", few)
        # c has no neighbour with a valence, but d; a valence given twice counts twice
        twice = seeds.unionByName(spark.createDataFrame([("d", 1.0), ("d", 1.0)], "word string, valence double"))
        step = lx.spread_once(edges, twice, seeds)
        assert {(r.word, r.valence) for r in step.collect()} == {("a", 0.4), ("c", 0.4), ("b", 2.0), ("zz", -1.0)}
        assert step._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [a#") == 1


def test_texts_are_not_cut_into_rows_for_seeds(spark, monkeypatch):
    plans = {}
    keep = lx._kept
    monkeypatch.setattr(lx, "_kept", lambda df, name: plans.setdefault(name, df._jdf.queryExecution().toString()) and keep(df, name))
    docs = spark.createDataFrame([(1, "bad word")], "doc_id long, text string")
    lx.labelled_seeds(docs, spark.createDataFrame([(1, 0, 1)], "doc_id long, quality int, toxic int"))
    assert "lexicon-labelled" in plans and not any("Generate" in p for p in plans.values())
