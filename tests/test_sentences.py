"""Sentence splitter: learnt abbreviations, boundaries and tokens on crafted rows."""

import pytest
from pyspark.sql import functions as F

from eddy.functions.text import raw_tokens
from eddy.operators import sentences as sn

FILLER = [f"The {a} went to the {b} and saw a {c}. It was the {b} that the {a} liked." for a in ("dog", "cat", "fox", "hen")
          for b in ("house", "river", "forest") for c in ("boat", "bridge", "tower", "garden")]
PLAIN = ["Each boat was liked, each bridge was built, each tower left so, each garden grew, and the boat, bridge or tower they liked so much stood there"] * 30
TEXTS = FILLER + PLAIN + ["The U.S. sent Dr. Brown to the U.S. coast etc. with Mr. Green etc. and Mrs. White."] * 6 + \
    ["He came with J. Smith on May 5. he said so. Then J. Smith left."] * 4


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(4)
    return sn.fit(docs)


def _tokens(spark, model, text):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    return [r.token for r in sn.sentence_tokens(docs, model).orderBy("pos", "sub").collect()]


def test_abbreviations_are_learnt(model):
    got = {r.type for r in model.types.where("abbreviation").collect()}
    assert {"u.s", "dr", "mr", "etc"} <= got
    assert not {"boat", "bridge", "liked", "so", "left", "##number##"} & got
    assert {(r.type, r.next_type) for r in model.pairs.where("collocation").collect()} >= {("j", "smith")}


def test_tokens_of_sentences(spark, model):
    assert _tokens(spark, model, "U.S. end. Next") == ["u.s.", "end", ".", "next"]
    assert _tokens(spark, model, "Dr. Brown cannot go etc. now, gimme it!") == [
        "dr.", "brown", "can", "not", "go", "etc.", "now", ",", "gim", "me", "it", "!"]
    assert _tokens(spark, model, "in the U.S.") == ["in", "the", "u.s", "."]         # the text's end closes it
    assert _tokens(spark, model, "He left... then (see below.) \"Yes.\" she said") == [
        "he", "left", "...", "then", "(", "see", "below", ".", ")", '"', "yes", ".", '"', "she", "said"]
    assert _tokens(spark, model, "by J. Smith, no. 5. he") == ["by", "j.", "smith", ",", "no", ".", "5.", "he"]


def test_sentences(spark, model):
    docs = spark.createDataFrame([(1, "Dr. Brown left. Who knows?\n Mr. Green!"), (2, None), (3, " \n"), (4, "one")],
                                 "doc_id long, text string")
    got = sorted((r.doc_id, r.sentence, r.first, r.words) for r in sn.sentences(docs, model).collect())
    assert got == [(1, 0, 0, 3), (1, 1, 3, 2), (1, 2, 5, 2), (4, 0, 0, 1)]


def test_model_is_saved_and_large_models_join_plainly(spark, model, tmp, monkeypatch):
    model.save(f"{tmp}/v1")
    again = sn.SentenceModel.load(spark, f"{tmp}/v1")
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    want = sorted(map(str, sn.boundaries(docs, again).collect()))
    monkeypatch.setattr(sn, "MAX_BROADCAST_ROWS", 0)
    plain = sn.boundaries(docs, again)
    assert "BroadcastHashJoin" not in plain._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert sorted(map(str, plain.collect())) == want


def test_empty_input(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    model = sn.fit(none)
    assert model.types.count() == 0 and sn.sentence_tokens(none, model).count() == 0
    assert _tokens(spark, model, "Dr. Who") == ["dr", ".", "who"]


def test_words_of_two_tokens(spark):
    df = spark.createDataFrame([("cannot/cannot gimme",), ("'tis and 'twas, d'ye",), ("wanna wannabe cannots _cannot",)], "t string")
    got = [[t for t in r[0] if t] for r in df.select(raw_tokens(F.col("t"))).collect()]
    assert got == [["can", "not", "/", "can", "not", "gim", "me"], ["'t", "is", "and", "'t", "was", ",", "d", "'ye"],
                   ["wan", "na", "wannabe", "cannots", "_cannot"]]
