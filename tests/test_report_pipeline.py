"""Enrichment + report on the supplied tables: invariants of the saved report
and parity with the DuckDB oracle for a handful of keys at sf0.001."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as se
from conftest import SF
from eddy.operators import report as rp
from eddy.operators.language import train_profile
from eddy.plans.enrich import enrich, reportable_enriched
from eddy.sources import tables as tb


@pytest.fixture(scope="module")
def profile(spark):
    return train_profile(tb.documents(spark, SF, ("text", "lang")))


def test_report_invariants(spark, profile):
    e = reportable_enriched(tb.documents(spark, SF), profile)
    long = rp.report_long(e).collect()
    by = {}
    for r in long:
        by.setdefault(r.dimension, []).append(r)
    n = e.count()
    assert sum(r.n for r in by["languages"]) == n == sum(r.n for r in by["sentiments"])
    assert {r.key for r in by["sentiments"]} <= {"Positive", "Negative"}
    kws = sorted(by["keywords"], key=lambda r: r.rank)
    assert sum(r.n for r in kws) <= 3 * n
    assert all(a.n >= b.n for a, b in zip(kws, kws[1:]))
    top = sorted(by["top_keywords"], key=lambda r: r.rank)
    assert [(r.key, r.n) for r in top] == [(r.key, r.n) for r in kws[:10]]
    assert all(r.key.isalpha() for r in kws)


def test_enrich_keeps_every_row(spark, profile):
    docs = tb.documents(spark, SF)
    e = enrich(docs, profile)
    assert e.count() == docs.count()
    assert e.where(F.col("language").isNull() | F.col("sentiment").isNull()).count() == 0


def test_entry_runs(spark):
    df = se.entry(spark)
    assert df.count() > 0 and df.columns == ["dimension", "key", "n", "rank"]


@pytest.mark.parametrize("key", ["keywords_top3", "sentiment_score", "detect_language", "report",
                                 "latency_report", "epoch_to_iso", "partition_assign"])
def test_oracle_parity_small(spark, key):
    con = duckdb.connect()
    for t in ("documents", "events", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    sdf = se.queries()[key](spark, SF)
    cols = sorted(sdf.columns)
    s = sorted(tuple(str(r[c]) for c in cols) for r in sdf.collect())
    res = con.execute(se.oracle_sql()[key])
    names = [d[0] for d in res.description]
    d = sorted(tuple(str(row[names.index(c)]) for c in cols) for row in res.fetchall())
    assert sorted(names) == cols and s == d
