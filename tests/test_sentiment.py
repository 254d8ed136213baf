"""Sentiment rules on crafted rows (FIXTURES section 3)."""

import math

from eddy.operators.sentiment import IDIOMS, analyze_sentiment, sentiment_scores


def _score(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    out = {r.doc_id: (r.compound, r.sentiment) for r in analyze_sentiment(df).collect()}
    return [out[i] for i in range(len(texts))]


def test_published_examples(spark):
    got = _score(spark, ["not good", "very good", "", None, "a table"])
    assert got == [(-0.3412, "Negative"), (0.4927, "Positive"), (0.0, "Positive"), (0.0, "Positive"),
                   (0.0, "Positive")]


def test_contraction_negates(spark):
    (c, s), = _score(spark, ["I don't like it"])
    assert c < 0 and s == "Negative"


def test_but_rule_shifts_weight(spark):
    (a, _), (b, _) = _score(spark, ["good but bad", "bad but good"])
    assert a < 0 < b


def test_exclamation_amplifies_without_sign_change(spark):
    (a, _), (b, _) = _score(spark, ["great", "great!!!"])
    assert 0 < a < b


def test_negation_three_back_and_not_beyond(spark):
    (a, _), (b, _) = _score(spark, ["not a very good", "not x y z good"])
    assert a < 0 and b > 0


def _loud(spark, texts, **options):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    out = {r.doc_id: r.compound for r in sentiment_scores(df, **options).collect()}
    return [out[i] for i in range(len(texts))]


def _compound(valence):
    return round(valence / math.sqrt(valence * valence + 15.0), 4)


def test_capitals_weigh_more_in_mixed_texts(spark):
    got = _loud(spark, ["a good day", "a GOOD day", "A GOOD DAY", "NOT GOOD", "not GOOD", "a VERY good day", "BAD day"], caps=True)
    bad = _loud(spark, ["bad day"])[0]
    assert got[:2] == [_compound(1.9), _compound(1.9 + 0.733)]
    assert got[2] == _compound(1.9)                                    # all in capitals: no emphasis
    assert got[3] == _compound(1.9 * -0.74) and got[4] == _compound((1.9 + 0.733) * -0.74)
    assert got[5] == _compound(1.9 + 0.293 + 0.733) and got[6] < bad < 0
    assert _loud(spark, ["a GOOD day", None, ""]) == [_compound(1.9), 0.0, 0.0]


def test_idioms_count_as_one_word(spark):
    texts = ["it was the kiss of death", "it was not the kiss of death", "good, yeah right", "yeah right yeah", "Kiss of Death kiss of death",
             "to die for", "kiss of", "a good day"]
    got = _loud(spark, texts, idioms=IDIOMS)
    assert got[0] == _compound(-1.5) and got[1] == _compound(-1.5 * -0.74)
    assert got[2] == _compound(1.9 - 2.0) and got[3] == _compound(-2.0) and got[4] == _compound(-3.0)
    assert got[5] == _compound(3.0) and got[6] == 0.0 and got[7] == _compound(1.9)


def test_the_longest_idiom_wins(spark):
    phrases = {"very good": -1.0, "very good day": 2.5, "good day": -2.0, "day off": 1.0}
    got = _loud(spark, ["very good day", "very good day off", "a good day", "very good"], idioms=phrases)
    assert got == [_compound(2.5), _compound(2.5), _compound(-2.0), _compound(-1.0)]
