"""Tokenizer and keyword extraction on crafted rows (FIXTURES section 3)."""

from pyspark.sql import functions as F

from eddy.functions.text import alpha_tokens, english_stopwords, raw_tokens
from eddy.operators.keywords import extract_keywords, filter_stopwords, token_rows


def _kw(spark, texts, k=3):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    out = {r.doc_id: r.keywords for r in extract_keywords(df, k).collect()}
    return [out.get(i) for i in range(len(texts))]


def test_stopword_list_is_complete():
    sw = english_stopwords()
    assert len(sw) == 179 and len(set(sw)) == 179
    assert "would" not in sw and "really" not in sw and "the" in sw


def test_alpha_tokens(spark):
    df = spark.createDataFrame([("x2 spider-man 42 foo_bar cool",), ("I don't like it",),
                                ("Hello, world... (yes) http://a.b/c",)], "t string")
    got = [r[0] for r in df.select(alpha_tokens(F.col("t"))).collect()]
    assert got[0] == ["cool"]
    assert got[1] == ["i", "do", "like", "it"]
    assert got[2] == ["hello", "world", "yes", "http"]


def test_keywords_ties_keep_first_occurrence(spark):
    assert _kw(spark, ["beta alpha beta alpha gamma"]) == [["beta", "alpha", "gamma"]]


def test_keywords_drop_stopword_only_and_empty(spark):
    assert _kw(spark, ["the of and", "", None, "   ", "cool cool story"]) == [None, None, None, None, ["cool", "story"]]


def test_keywords_top5(spark):
    text = "apple banana cherry date elder fig grape banana cherry date cherry date date"
    assert _kw(spark, [text], 5) == [["date", "cherry", "banana", "apple", "elder"]]
    # single letters "a" and "d" are stopwords; "c" and "b" are not
    assert _kw(spark, ["a b c d b c c d d d"], 5) == [["c", "b"]]


def test_stopword_table_path(spark):
    toks = token_rows(spark.createDataFrame([(1, "apples and pears")], "doc_id long, text string"))
    stop = spark.createDataFrame([("pears",)], "w string")
    assert [r.token for r in filter_stopwords(toks, stop).collect()] == ["apples", "and"]


def test_unicode_spaces_split_tokens(spark):
    df = spark.createDataFrame([("cool\u00a0story\u2028bro\u3000ok",)], "t string")
    got = df.select(raw_tokens(F.col("t")).alias("x")).first().x
    assert got == ["cool", "story", "bro", "ok"]


def test_words_of_two_tokens(spark):
    texts = ["I cannot cannot", "Gonna, gimme lemme gotta (wanna) wanna", "'Tis more'n d'ye know 'twas", "wannabe scannot cannots ücannot"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, t string").orderBy("doc_id")
    got = [r.x for r in df.select(alpha_tokens(F.col("t")).alias("x")).collect()]
    assert got == [["i", "can", "not", "can", "not"], ["gon", "na", "gim", "me", "lem", "me", "got", "ta", "wan", "na", "wan", "na"],
                   ["is", "more", "d", "know", "was"], ["wannabe", "scannot", "cannots", "ücannot"]]
    assert _kw(spark, ["gonna gimme"]) == [["gon", "na", "gim"]]
