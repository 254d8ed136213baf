"""A text is tokenized once, by patterns that match what the SQL's do."""

from pyspark.sql import functions as F

from conftest import SF
from eddy.functions import text as tx
from eddy.plans.catalog import QUERIES

ODD = ["", " ", "It's n't 's ' a' 'll can't don't''s\n's", "they'll we'VE cannot/cannot gimme.", "a b c　d\x1ce\x85f  g",
       "İstanbul ΟΔΟΣ naïve café's x:y 1:2 a,\nb--c...", "!~ \x7f ~!", "'tis 'twas wanna wannabe d'ye more'n"]


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_quick_patterns_equal_the_plain_ones(spark):
    df = spark.createDataFrame([(t,) for t in ODD], "t string")
    plain = tx.TOKEN_RULES[6]
    got = df.select(
        F.split("t", tx.QUICK_SPLIT).alias("a"), F.split("t", tx.TOKEN_SPLIT).alias("b"),
        F.regexp_replace("t", tx._QUICK_RULES[plain[0]], plain[1]).alias("c"), F.regexp_replace("t", *plain).alias("d"),
        tx._hinted(F.col("t")).alias("e"), F.col("t").rlike(tx.PAIR_HINT).alias("f")).collect()
    assert all(r.a == r.b and r.c == r.d and r.e == r.f for r in got)


def test_words_of_one_token(spark):
    words = [w for t in ODD for w in t.split()] + ["cannot", "Gonna", "cannots", "boat", "Café", "_x", "a1"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = df.select("w", tx.is_one_token(F.lower("w")).alias("one"), F.array(F.lower("w")).alias("low"),
                    tx.word_tokens(F.col("w"), True).alias("x"), tx.word_tokens(F.col("w"), False).alias("y")).collect()
    assert all(r.x == r.low == r.y for r in got if r.one) and {"boat", "cannots", "Café"} <= {r.w for r in got if r.one}
    assert not {"cannot", "Gonna", "a1"} & {r.w for r in got if r.one}


def test_a_text_is_tokenized_once(spark):
    p = _plan(QUERIES["term_freq"](spark, SF))
    assert p.count(tx.TOKEN_RULES[0][0]) == 1
