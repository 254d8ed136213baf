"""Language identification: many labels, saved profiles, both join strategies."""

import pytest
from pyspark.sql import functions as F

from eddy.operators import language as lg

TEXTS = [("en", "the house and the river"), ("en", "this is the thing that they had"), ("de", "das haus und der fluss"),
         ("de", "sie haben das nicht gewusst"), ("fr", "la maison et le fleuve"), ("fr", "ils ne savaient pas cela"), (None, "x y z"), ("xx", None)]


@pytest.fixture(scope="module")
def profile(spark):
    return lg.train_profile(spark.createDataFrame(TEXTS, "lang string, text string"))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, "the thing and the river"), (2, "das ist nicht der fluss"), (3, "le fleuve et la maison"), (4, None), (5, " ... "),
            (6, "qqq"), (7, "zzzz the"), (7, "und und und")]
    return spark.createDataFrame(rows, "doc_id long, text string")


def _brute(profile, text):
    """Scores of every language by the definition."""
    letters = "".join(c if c.isalpha() else " " for c in text.lower())
    t = " " + " ".join(letters.split()) + " " if letters.split() else ""
    grams = [t[i:i + 3] for i in range(len(t) - 2)]
    lp = {(r.lang, r.g): r.lp for r in profile.table.collect()}
    floor = {r.lang: r.lp0 for r in profile.languages.collect()}
    known = [g for g in grams if any((lang, g) in lp for lang in floor)]
    return {lang: sum(lp.get((lang, g), floor[lang]) for g in known) for lang in floor} if known else {}


def test_scores_and_posteriors(docs, profile):
    got = {}
    for r in lg.posterior(docs.where("doc_id < 7"), profile).collect():
        got.setdefault(r.doc_id, {})[r.lang] = (r.score, r.posterior)
    texts = {r.doc_id: r.text for r in docs.where("doc_id < 7").collect()}
    for i, text in texts.items():
        want = _brute(profile, text or "")
        assert all(want[lang] == s for lang, (s, _) in got.get(i, {}).items())
        if want:
            assert max(want.values()) == max(s for s, _ in got[i].values())
            assert sum(p for _, p in got[i].values()) == pytest.approx(1, abs=1e-5)
    lang = {r.doc_id: r.language for r in lg.detect_language(docs.where("doc_id < 7"), profile).collect()}
    assert lang == {1: "en", 2: "de", 3: "fr", 4: "unknown", 5: "unknown", 6: "unknown"}


def test_large_profiles_join_plainly(docs, profile, monkeypatch):
    want = sorted(map(str, lg.candidate_scores(docs, profile).collect()))
    monkeypatch.setattr(lg, "MAX_BROADCAST_BYTES", 0)
    monkeypatch.setattr(lg, "MAX_LANGUAGES", 0)
    assert sorted(map(str, lg.candidate_scores(docs, profile).collect())) == want


def test_thousands_of_labels(spark, monkeypatch):
    n = 5000
    rows = spark.range(n).select(F.concat(F.lit("l"), "id").alias("lang"), F.concat(F.lit("common words "), F.translate(
        F.col("id").cast("string"), "0123456789", "abcdefghij"), F.lit(" "), F.translate((F.col("id") * 7919).cast("string"), "0123456789", "klmnopqrst")).alias("text"))
    seen = []

    def counted(f):
        def run(self, *a, **k):
            got = f(self, *a, **k)
            seen.append(len(got))
            return got
        return run
    for name in ("collect", "toPandas", "toArrow"):
        monkeypatch.setattr(type(rows), name, counted(getattr(type(rows), name)))
    p = lg.train_profile(rows)
    assert max(seen) <= 1       # totals of one row
    monkeypatch.undo()
    assert p.languages.count() == n
    probe = rows.where("lang in ('l7', 'l4321', 'l999')").select(F.col("lang").alias("doc_id"), "text")
    got = {r.doc_id: r.detected for r in lg.detect(probe, p).collect()}
    assert got == {"l7": "l7", "l4321": "l4321", "l999": "l999"}


def test_profile_is_fitted_once_for_each_state(spark, tmp, monkeypatch):
    path, root = f"{tmp}/labelled", f"{tmp}/models"
    spark.createDataFrame(TEXTS, "lang string, text string").write.parquet(path)
    fits = []
    train = lg.train_profile
    monkeypatch.setattr(lg, "train_profile", lambda *a, **k: fits.append(1) or train(*a, **k))
    a, b = (lg.saved_profile(spark, path, root=root) for _ in range(2))
    assert len(fits) == 1 and sorted(map(str, a.table.collect())) == sorted(map(str, b.table.collect()))
    assert (a.sizes, a.vocabulary, a.rows) == (b.sizes, b.vocabulary, b.rows)
    lg.saved_profile(spark, path, sizes=(1, 2), root=root)
    assert len(fits) == 2
    spark.createDataFrame([("es", "la casa y el agua")], "lang string, text string").write.mode("append").parquet(path)
    assert "es" in {r.lang for r in lg.saved_profile(spark, path, root=root).languages.collect()} and len(fits) == 3


def test_empty_training(spark, docs):
    p = lg.train_profile(spark.createDataFrame([], "lang string, text string"))
    assert {r.language for r in lg.detect_language(docs, p).collect()} == {"unknown"}
