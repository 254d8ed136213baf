"""Streams: batch = stream, restart from checkpoint, replayed batch id, quiet
interval, and the latency monitor's final flush."""

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF
from eddy.operators.language import train_profile
from eddy.sources import json_codec as jc
from eddy.sources import tables as tb
from eddy.streaming import jobs

WIRE = {"row_index": "Unnamed: 0", "text": "1", "comment_id": "2"}


@pytest.fixture(scope="module")
def profile(spark):
    return train_profile(tb.documents(spark, SF, ("text", "lang")))


@pytest.fixture(scope="module")
def messages(spark):
    c = tb.comments(spark, SF)
    m = jc.encode(c, WIRE).select(
        F.md5("value").alias("key"), "value", F.lit("reddit-comments").alias("topic"),
        (F.col("row_index") % 4).cast("int").alias("partition"), (F.col("row_index") / 4).cast("long").alias("offset"))
    return m.persist()


def _write_parts(messages, path, parts):
    for p in parts:
        messages.where(F.col("partition") == p).coalesce(1).write.mode("append").parquet(path)


def _key(df):
    return sorted((r.partition, r.offset, r.language, r.sentiment, tuple(r.keywords)) for r in df.collect())


def _run_enrich(spark, profile, src, out, ckpt, per_trigger):
    q = jobs.start_enrichment(jobs.file_source(spark, src, per_trigger), profile, out, ckpt)
    q.awaitTermination(300)
    assert q.exception() is None


def test_stream_equals_batch_and_restart(spark, profile, messages, tmp):
    want, _ = jobs.enrich_batch(messages, profile)
    want = _key(want)
    for per in (1, 4):
        src = f"{tmp}/src{per}"
        _write_parts(messages, src, range(4))
        out = jobs.EnrichOutputs(f"{tmp}/enr{per}", f"{tmp}/rej{per}")
        _run_enrich(spark, profile, src, out, f"{tmp}/ck{per}", per)
        assert _key(spark.read.option("recursiveFileLookup", "true").parquet(out.enriched)) == want
    # restart: half the files, stop, the rest arrive, resume from the checkpoint
    src, out = f"{tmp}/srcR", jobs.EnrichOutputs(f"{tmp}/enrR", f"{tmp}/rejR")
    _write_parts(messages, src, [0, 1])
    _run_enrich(spark, profile, src, out, f"{tmp}/ckR", 1)
    _write_parts(messages, src, [2, 3])
    _run_enrich(spark, profile, src, out, f"{tmp}/ckR", 1)
    assert _key(spark.read.option("recursiveFileLookup", "true").parquet(out.enriched)) == want
    # running report from the enriched stream equals the batch counts
    q = jobs.start_report(jobs.enriched_file_source(spark, out.enriched), f"{tmp}/report", f"{tmp}/ckRep")
    q.awaitTermination(300)
    rows, text = jobs.report_snapshot(spark, f"{tmp}/report")
    rows = rows.collect()
    snap = {(r.dimension, r.key): r.n for r in rows}
    top = json.loads(text.collect()[0].value)["top_keywords"]
    words = sorted(((-r.n, r.key, r.rank) for r in rows if r.dimension == "keywords"))
    assert [w[2] for w in words] == list(range(1, len(words) + 1))
    assert list(top) == [w[1] for w in words[:10]]
    enr = spark.read.option("recursiveFileLookup", "true").parquet(out.enriched).where(F.size("keywords") > 0)
    n = enr.count()
    assert sum(v for (d, _), v in snap.items() if d == "languages") == n
    assert sum(v for (d, _), v in snap.items() if d == "sentiments") == n
    kw = {r.k: r.n for r in enr.select(F.explode("keywords").alias("k")).groupBy("k").agg(F.count("*").alias("n")).collect()}
    assert {k: v for (d, k), v in snap.items() if d == "keywords"} == kw


def test_replayed_batch_is_idempotent(spark, profile, messages, tmp):
    out = jobs.EnrichOutputs(f"{tmp}/enr", f"{tmp}/rej")
    run = jobs.enrichment_writer(profile, out)
    run(messages, 0)
    first = spark.read.parquet(f"{tmp}/enr/batch_id=0").count()
    run(messages, 0)
    assert spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp}/enr").count() == first


def test_quiet_interval_writes_nothing(spark, tmp):
    out = jobs.LatencyOutputs(f"{tmp}/rows", f"{tmp}/rep", f"{tmp}/cons")
    empty = tb.processed_records(spark, SF).limit(0)
    jobs.latency_writer(out)(empty, 0)
    assert not os.path.exists(f"{tmp}/rep")


def test_latency_monitor_final_flush(spark, tmp):
    p = tb.processed_records(spark, SF).select("id", "timestamp", "processing_time", "processed_by", "partition")
    p.repartition(3).write.parquet(f"{tmp}/proc")
    out = jobs.LatencyOutputs(f"{tmp}/rows", f"{tmp}/rep", f"{tmp}/cons")
    q = jobs.start_latency_monitor(jobs.processed_file_source(spark, f"{tmp}/proc", 1), out, f"{tmp}/ck", final=True)
    q.awaitTermination(300)
    assert q.exception() is None
    reports = [json.loads(r.value) for r in spark.read.option("recursiveFileLookup", "true").text(out.reports).collect()]
    assert sum(r["total_messages"] for r in reports) == p.count()
    assert all(r["min_latency_ms"] <= r["p95_latency_ms"] <= r["p99_latency_ms"] <= r["max_latency_ms"] for r in reports)
    rows = spark.read.option("recursiveFileLookup", "true").csv(out.rows_csv)
    assert rows.count() == p.count() and len(rows.columns) == 7


def test_conversion_stream(spark, messages, tmp):
    src = f"{tmp}/src"
    bad = messages.limit(3).select("key", F.lit("{}").alias("value"), "topic", "partition",
                                   (F.col("offset") + 10_000).alias("offset"))
    _write_parts(messages.unionByName(bad), src, range(4))
    out = jobs.ConvertOutputs(f"{tmp}/times", f"{tmp}/proc", f"{tmp}/rej")
    q = jobs.start_conversion(jobs.file_source(spark, src, 2), out, f"{tmp}/ck", 4, 2)
    q.awaitTermination(300)
    assert q.exception() is None
    # the comment messages here carry no time field ("5"), so every one is rejected
    rej = spark.read.option("recursiveFileLookup", "true").parquet(out.rejects)
    assert rej.count() == messages.count() + 3
    assert {r.reason for r in rej.select("reason").distinct().collect()} == {"missing time", "empty message"}


def test_conversion_stream_with_times(spark, tmp):
    c = tb.comments_with_time(spark, SF)
    wire = dict(WIRE, created_utc="5")
    m = jc.encode(c, wire).select(
        F.md5("value").alias("key"), "value", F.lit("reddit-comments").alias("topic"),
        (F.col("row_index") % 4).cast("int").alias("partition"), (F.col("row_index") / 4).cast("long").alias("offset"))
    src = f"{tmp}/src"
    _write_parts(m, src, range(4))
    out = jobs.ConvertOutputs(f"{tmp}/times", f"{tmp}/proc", f"{tmp}/rej")
    q = jobs.start_conversion(jobs.file_source(spark, src, 1), out, f"{tmp}/ck", 4, 2)
    q.awaitTermination(300)
    assert q.exception() is None
    times = spark.read.option("header", "true").option("recursiveFileLookup", "true").csv(out.times_csv)
    assert times.columns == ["timestamp", "iso_datetime"] and times.count() == c.count()
    assert times.where(~F.col("iso_datetime").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d{6})?$")).count() == 0
    proc = spark.read.option("recursiveFileLookup", "true").parquet(out.processed)
    assert proc.count() == c.count()
    assert {r.processed_by for r in proc.select("processed_by").distinct().collect()} == {"consumer_0", "consumer_1"}
    assert proc.where(F.col("id") != "unknown").count() == 0


def test_windowed_latency_stream_counts_every_row(spark, tmp):
    p = tb.processed_records(spark, SF).select("id", "timestamp", "processing_time", "processed_by", "partition")
    p.repartition(2).write.parquet(f"{tmp}/proc")
    agg = jobs.windowed_latency_stream(jobs.processed_file_source(spark, f"{tmp}/proc", 1), "1 hour")
    q = (agg.writeStream.outputMode("complete").format("memory").queryName("win_lat")
         .option("checkpointLocation", f"{tmp}/ck").trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = spark.sql("SELECT sum(total_messages) AS n, count(*) AS w FROM win_lat").collect()[0]
    assert got.n == p.count() and got.w > 1


def test_replay_counts_once_through_the_report(spark, profile, messages, tmp):
    out = jobs.EnrichOutputs(f"{tmp}/enr", f"{tmp}/rej")
    run = jobs.enrichment_writer(profile, out)

    def report():
        q = jobs.start_report(jobs.enriched_file_source(spark, out.enriched), f"{tmp}/report", f"{tmp}/ck")
        q.awaitTermination(300)
        assert q.exception() is None
        return {(r.dimension, r.key): r.n for r in jobs.report_snapshot(spark, f"{tmp}/report")[0].collect()}

    run(messages, 0)
    first = report()
    run(messages, 0)      # replayed after its commit was lost
    assert report() == first
    # a batch that failed half-way leaves only hidden files; its replay counts once
    messages.limit(5).write.parquet(f"{out.enriched}/_staging/1-dead")
    more = messages.withColumn("offset", F.col("offset") + 100_000)
    run(more, 1)
    assert report() == {k: 2 * n for k, n in first.items()}


def test_enriched_rows_are_whole_and_bad_ones_set_aside(spark, profile, tmp):
    big = 1 << 40
    rows = [(0, big, '{"1":"good story about a river","2":"a","5":1.5,"more":"kept"}'),
            (1, 0, '{"1":"another story about mountains","2":"b"}'),
            (1, 1, '{"1":123,"2":"c"}'), (1, 2, '{"1":{"x":1},"2":"d"}'), (1, 3, '{"1":true,"2":"e"}'),
            (1, 4, '{"1":NaN,"2":"f"}'), (1, 5, '{"2":"g"}'), (1, 6, '{"1":"12 !!","2":"h"}'), (1, 7, "{}"), (1, 8, "nonsense")]
    m = spark.createDataFrame([(str(i), v, "t", p, o) for i, (p, o, v) in enumerate(rows)],
                              "key string, value string, topic string, partition int, offset long")
    good, bad = jobs.enrich_batch(m, profile)
    good = {r.comment_id: r for r in good.collect()}
    assert set(good) == {"a", "b"}
    assert good["a"].text == "good story about a river" and good["a"].created_utc == 1.5
    assert good["a"].fields["more"] == "kept" and good["a"].offset == big
    assert "river" in good["a"].keywords and "river" not in good["b"].keywords
    got = sorted((r.stage, r.reason) for r in bad.collect())
    assert got == sorted([("sentiment", "text not a string")] * 5 + [("keywords", "no keyword"), ("decode", "empty message"),
                                                                    ("decode", "unparseable message")])


def test_conversion_feeds_the_latency_monitor(spark, tmp):
    rows = [(p, o, t) for p, o, t in [(0, 0, "1.5e9"), (1, 0, "1.6e9"), (3, 0, "1e15"), (2, 1, "0"), (2, 2, "1.7e9")]]
    m = spark.createDataFrame([("k", '{"1":"x","2":"a","5":%s}' % t, "t", p, o) for p, o, t in rows],
                              "key string, value string, topic string, partition int, offset long")
    out = jobs.ConvertOutputs(f"{tmp}/times", f"{tmp}/proc", f"{tmp}/rej")
    jobs.conversion_writer(out, 4, 2)(m, 0)
    lat = jobs.LatencyOutputs(f"{tmp}/rows", f"{tmp}/rep", f"{tmp}/cons")
    q = jobs.start_latency_monitor(jobs.processed_file_source(spark, f"{tmp}/proc/batch_id=0"), lat, f"{tmp}/ck", final=True)
    q.awaitTermination(300)
    assert q.exception() is None
    got = spark.read.option("recursiveFileLookup", "true").csv(lat.rows_csv).collect()
    assert sorted(r._c6 for r in got) == ["0", "1", "2"]
    assert spark.read.parquet(f"{tmp}/rej/batch_id=0").count() == 2


def test_large_word_tables_use_a_plain_join(spark, monkeypatch):
    from eddy.operators import keywords as kw, sentiment as se
    monkeypatch.setattr(kw, "MAX_STOPWORDS", 1)
    monkeypatch.setattr(se, "MAX_LEXICON_ROWS", 1)
    docs = spark.createDataFrame([(1, "the good river")], "doc_id long, text string")
    stop = spark.createDataFrame([("the",), ("good",)], "w string")
    assert [r.w for r in kw.term_frequencies(docs, stopwords=stop).collect()] == ["river"]
    lex = spark.createDataFrame([("good", 1.9, None, 0), ("bad", -2.5, None, 0)], se.LEXICON_SCHEMA)
    assert se.analyze_sentiment(docs, lex=lex).collect()[0].compound > 0
