"""With few languages the broadcast profile has a column for each."""

from eddy.operators import language as lg


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_few_languages_are_columns(spark, monkeypatch):
    rows = [("en", "the house and the river"), ("de", "das haus und der fluss"), ("fr", "la maison et le fleuve")]
    profile = lg.train_profile(spark.createDataFrame(rows, "lang string, text string"))
    docs = spark.createDataFrame([(1, "the thing"), (1, "the river"), (2, "das ist"), (None, "le fleuve"), (3, None), (4, "qqq")], "doc_id long, text string")
    wide = lg.candidate_scores(docs, profile)
    assert "_x0" in _plan(wide) and "lang" not in _plan(wide).split("Generate explode(regexp")[-1].split("Aggregate")[0]
    got = sorted(map(str, wide.collect()))
    monkeypatch.setattr(lg, "MAX_WIDE", 0)
    assert got == sorted(map(str, lg.candidate_scores(docs, profile).collect())) and len(got) >= 5
