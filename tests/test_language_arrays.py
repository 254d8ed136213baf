"""N-grams as numbers: the counts, scores and languages of n-grams as strings."""

import random

import pytest

from eddy.operators import language as lg

WORDS = ["the", "river", "das", "Haus", "fluss", "le", "fleuve", "a", "é", "straße", "ΟΔΟΣ", "書く", "5", "...", "qqq", "it's", "İz"]


def _rows(n=150, seed=3):
    rnd = random.Random(seed)
    rows = [(rnd.randrange(n // 2) if rnd.random() < 0.9 else None, rnd.choice(["en", "de", "fr", None]),
             " ".join(rnd.choice(WORDS) for _ in range(rnd.randint(0, 9)))) for _ in range(n)]
    return rows + [(1, "en", None), (2, "de", " . "), (3, "fr", "the river " * 400)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(_rows(), "doc_id long, lang string, text string").repartition(3).cache()


@pytest.mark.parametrize("sizes", [(3,), (1, 2, 3), (2, 2), (4,)])
@pytest.mark.parametrize("dense", [1 << 22, 0])
def test_counts_and_languages(docs, monkeypatch, sizes, dense):
    monkeypatch.setattr(lg, "MAX_DENSE", dense)
    for name, size in (("SLICE_BYTES", 300), ("WINDOW", 70)):
        monkeypatch.setattr(lg, name, size)
    src = docs.where("lang is not null and text is not null")
    assert sorted(map(str, lg.label_counts(src, "lang", "text", sizes).collect())) == sorted(
        map(str, lg.trigram_counts(src, "lang", "text", sizes).select("lang", "g", "n").collect()))
    profile = lg.train_profile(src.where("text not like '%qqq%' or lang = 'en'"), sizes=sizes)
    got = {r.doc_id: r.detected for r in lg.detect(docs, profile).collect()}
    best = {}
    for r in lg.candidate_scores(docs, profile).collect():
        best[r.doc_id] = min(best.get(r.doc_id, (1 << 62, "")), (-r.score, r.lang))
    assert got == {i: lang for i, (_, lang) in best.items()} and len(got) > 50


def test_a_comment_is_one_row(docs):
    profile = lg.train_profile(docs)
    for df in (lg.detect(docs, profile), lg.label_counts(docs, "lang", "text")):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "MapInArrow" in plan and "regexp_extract_all" not in plan
