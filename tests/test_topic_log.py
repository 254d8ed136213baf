"""Keyed, partitioned topic writes with dense offsets."""

import random

import pytest
from pyspark.sql import functions as F

from eddy.sources.topic import produce
from eddy.streaming import history, jobs, topic_log

MESSAGE = "key string, value string, topic string, partition int, offset long"


def _batch(spark, ids, hot=False):
    df = spark.createDataFrame([(i, f"v{i}") for i in ids], "at long, value string")
    return df.withColumn("key", F.lit("same")) if hot else df


def _topic(spark, root):
    return spark.read.option("basePath", root).parquet(root)


def _gapless(rows):
    by = {}
    for r in rows:
        by.setdefault(r.partition, []).append(r.offset)
    return all(sorted(o) == list(range(len(o))) for o in by.values())


def test_offsets_are_dense_over_batches_and_replays(spark, tmp, monkeypatch):
    monkeypatch.setattr(history, "FANOUT", 2)
    rnd = random.Random(1)
    ids = list(range(60))
    for b in range(4):
        part = rnd.sample(ids[b * 15:(b + 1) * 15], 15)
        assert topic_log.append(_batch(spark, part), tmp, b, 3, "t", ["at"])
        assert not topic_log.append(_batch(spark, part), tmp, b, 3, "t", ["at"])
    rows = _topic(spark, tmp).collect()
    assert len(rows) == 60 and _gapless(rows)
    want = {r.value: (r.key, r.partition) for r in produce(_batch(spark, ids), 3).collect()}
    assert {r.value: (r.key, r.partition) for r in rows} == want
    for p in range(3):      # within a batch messages keep their order
        mine = sorted((r.offset, int(r.value[1:])) for r in rows if r.partition == p)
        assert [v for _, v in mine] == sorted(v for _, v in mine)
    ends = {r.partition: r.end_offset for r in topic_log.end_offsets(spark, tmp).collect()}
    assert ends == {p: sum(r.partition == p for r in rows) for p in {r.partition for r in rows}}


def test_a_crash_before_the_end_offsets_is_made_up(spark, tmp, monkeypatch):
    topic_log.append(_batch(spark, range(10), hot=True), tmp, 0, 4, "t", ["at"])
    commit = history.commit
    monkeypatch.setattr(history, "commit", lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt))
    with pytest.raises(KeyboardInterrupt):
        topic_log.append(_batch(spark, range(10, 17), hot=True), tmp, 1, 4, "t", ["at"])
    monkeypatch.setattr(history, "commit", commit)
    assert not topic_log.append(_batch(spark, range(10, 17), hot=True), tmp, 1, 4, "t", ["at"])
    assert topic_log.append(_batch(spark, range(17, 20), hot=True), tmp, 2, 4, "t", ["at"])
    rows = _topic(spark, tmp).collect()
    assert len(rows) == 20 and len({r.partition for r in rows}) == 1 and _gapless(rows)


def test_stream_into_a_topic_and_lag(spark, tmp):
    for ids in (range(5), range(5, 12)):
        df = spark.createDataFrame([(None, f"v{i}", "in", 0, i) for i in ids] + [(None, None, "in", 0, 100 + ids[0])], MESSAGE)
        df.coalesce(1).write.mode("append").parquet(f"{tmp}/in")
    src = jobs.file_source(spark, f"{tmp}/in", 1).drop("key")
    for _ in range(2):
        topic_log.start_topic(src, f"{tmp}/topic", f"{tmp}/ck", 3, "out", ["partition", "offset"]).awaitTermination()
    rows = _topic(spark, f"{tmp}/topic").collect()
    assert len(rows) == 14 and _gapless(rows) and {r.topic for r in rows} == {"out"}
    assert all(r.partition == 0 for r in rows if r.value is None)
    # the topic is a source again; a consumer that has read half of it lags by the rest
    back = jobs.file_source(spark, f"{tmp}/topic").writeStream.format("memory").queryName("back").option(
        "checkpointLocation", f"{tmp}/ck2").trigger(availableNow=True).start()
    back.awaitTermination()
    assert spark.table("back").count() == 14
    seen = spark.table("back").where("offset < 2")
    got = {r.partition: (r.end_offset, r.position, r.lag) for r in topic_log.lag(spark, f"{tmp}/topic", seen.union(seen)).collect()}
    for p, (end, position, behind) in got.items():
        n = sum(r.partition == p for r in rows)
        assert (end, position, behind) == (n, min(2, n), n - min(2, n))
