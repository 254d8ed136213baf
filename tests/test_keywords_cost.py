"""Ids of one row need no shuffle of their words; words are tokenized as texts are."""

import random

from pyspark.sql import functions as F

from eddy.functions import text as tx
from eddy.operators import keywords as kw

PARTS = ["boat", "Café", "cannot", "gonna.", "'tis", "'twas", "wanna", "can't", "n't", "'s", "it's", "U.S.", "x:y", "a,b", ",,", "..", "--", "(so",
         "end.", "why?", "\u0085", " ", " ", "\x1c", ".", ",", "'", "\"", "5", "d'ye", "more'n", "straße", "ΟΔΟΣ", "\U0001d49c", "😀!"]


def _texts(n=400):
    rnd = random.Random(4)
    return [(i, "".join(rnd.choice(PARTS) + rnd.choice(["", " ", " ", "\n", "\t"]) for _ in range(rnd.randint(0, 12)))) for i in range(n)] + [(n, None)]


def test_pairs_are_those_of_the_rules(spark):
    assert set(tx.PAIRS) == {p for p in tx.PAIR_HINT.split("|") if p.isalpha()}
    df = spark.createDataFrame(list(tx.PAIRS.items()), "w string, p string")
    assert all(r.t == r.p.split() for r in df.select("p", tx.word_tokens(F.col("w"), True).alias("t")).collect())


def test_words_are_tokenized_as_texts_are(spark):
    df = spark.createDataFrame(_texts(), "doc_id long, text string")
    got = df.select("text", tx.alpha_words(F.col("text")).alias("a"), tx.alpha_tokens(F.col("text")).alias("b")).collect()
    assert [r.text for r in got if (r.a and [t for w in r.a for t in tx.plain_tokens(w)]) != (r.b and r.b)] == []


def test_sentiment_words_are_stripped_as_by_the_rule(spark):
    df = spark.createDataFrame(_texts() + [(0, "-'x' (a-b)  c  5) É! ***")], "doc_id long, text string")
    for lower in (True, False):
        t = F.lower("text") if lower else F.col("text")
        got = df.select(tx.sentiment_words(F.col("text"), lower).alias("a"), F.transform(
            F.split(t, tx.WORD_SPLIT), lambda w: F.regexp_replace(w, tx.WORD_STRIP, "")).alias("b")).collect()
        assert all(r.a == r.b for r in got)


def test_keywords_equal_the_counts_over_a_shuffle(spark, monkeypatch):
    rows = [(i, t and t + " river boat river") for i, t in _texts(120)]
    rows += [(7, "river stone stone"), (7, "boat stone"), (None, "one lake"), (None, "lake tree"), (121, ""), (122, "the of"), (123, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(kw, "SLICE_WORDS", 25)
    for docs in (df, df.where("doc_id <> 7")):
        want = {r.doc_id: r.keywords for r in kw.keyword_arrays(kw.top_k_terms(kw.term_frequencies(docs.where("length(text) > 0")), 3)).collect()}
        for most in (100_000, 1):
            monkeypatch.setattr(kw, "MAX_REPEATED", most)
            got = kw.extract_keywords(docs, 3).collect()
            assert {r.doc_id: r.keywords for r in got} == want and len(got) == len(want) > 100
    assert want.get(121) is None and want.get(122) is None


def test_words_of_one_row_are_not_shuffled(spark):
    plan = kw.extract_keywords(spark.createDataFrame(_texts(), "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "keywords" in plan
