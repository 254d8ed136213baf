"""Arrival-driven intervals, recorded and live, and exact windows on a stream."""

import random

import pytest
from pyspark.sql import functions as F

from eddy.operators import arrival as ar
from eddy.operators import latency as lt
from eddy.streaming import jobs

RECORD = "id string, timestamp double, processing_time double, processed_by string, partition int"


def _fold(rows, gap):
    """The sequential rule: (closing id, ids of the window)."""
    out, held, last = [], [], None
    for t, i in sorted(rows):
        last = t if last is None else last
        held.append(i)
        if t - last >= gap:
            out.append((i, sorted(held)))
            held, last = [], t
    return out


def test_windows_equal_the_fold(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.choice(["a", "a", "a", "b", "c", None]), float(rnd.randint(0, 400)), "x") for i in range(500)]
    rows += [(900, "d", 5.0, "x"), (901, None, None, "x"), (902, "a", float("nan"), "x")]
    df = spark.createDataFrame(rows, "id long, k string, t double, row string").repartition(7)
    got = {}
    for r in ar.arrival_windows(df, 10.0, "k", "t", "id").collect():
        assert r.row == "x"
        got.setdefault((r.k, r._window, r._closed_at), []).append(r.id)
    closed = sorted((k or "", max(v, key=lambda i: (rows[i][2] if i < 500 else 5.0, i)), sorted(v)) for (k, _, c), v in got.items() if c is not None)
    want = []
    for k in ("a", "b", "c", None, "d"):
        want += [(k or "", i, ids) for i, ids in _fold([(r[2], r[0]) for r in rows if r[1] == k and r[2] is not None and r[2] == r[2]], 10.0)]
    assert closed == sorted(want)
    assert sum(map(len, got.values())) == 501
    assert ar.arrival_windows(df.limit(0), 10.0, "k", "t", "id").count() == 0


def test_one_key_uses_all_tasks(spark):
    df = spark.range(20000).select(F.lit("k").alias("k"), (F.col("id") % 7000).cast("double").alias("t"), "id")
    w = ar.arrival_windows(df, 60.0, "k", "t", "id").where("_closed_at is not null")
    want = _fold([(i % 7000, i) for i in range(20000)], 60.0)
    assert w.select("_closed_at").distinct().count() == len(want)
    assert w.count() == sum(len(ids) for _, ids in want)


def _records(ids, latency=1.0, bad=False):
    return [(str(i), None if bad else 100.0 + i, 100.0 + i + latency * (i + 1), f"consumer_{i % 2}", i % 3) for i in ids]


def _monitor(batches, times, interval):
    """The reference's loop over batches of records that arrive together."""
    out, held, last = [], [], times[0]
    for now, batch in zip(times[1:], batches):
        valid = [r for r in batch if r[1] is not None]
        held += valid
        if valid and now - last >= interval:
            out.append((now, len(held), max(round((r[2] - r[1]) * 1000, 6) for r in held)))
            held, last = [], now
    return out


def test_live_monitor_equals_the_loop(spark, tmp):
    batches = [_records([1, 2]), _records([3]), _records([4], bad=True), _records([5, 6, 7]), _records([8]), _records([9]), _records([10])]
    times = [1000.0, 1010.0, 1059.0, 1100.0, 1101.0, 1150.0, 1400.0, 1459.0]
    out = jobs.ArrivalOutputs(f"{tmp}/rows", f"{tmp}/reports")
    jobs.begin_arrivals(spark, out, lambda: times[0])
    jobs.begin_arrivals(spark, out, lambda: 0.0)        # a restart keeps the first start
    now = iter(times[1:])
    current = [0.0]
    write = jobs.arrival_writer(out, 60.0, lambda: current[0])
    for i, rows in enumerate(batches):
        current[0] = next(now)
        df = spark.createDataFrame(rows, RECORD)
        write(df, i)
        write(df, i)        # a replay changes nothing
    got = [(r.made_at, r.total_messages, round(r.max_latency_ms, 6)) for r in jobs.arrival_reports(spark, out).orderBy("made_at").collect()]
    assert got == _monitor(batches, times, 60.0) and len(got) == 2


def test_live_monitor_as_a_stream(spark, tmp):
    for i, ids in enumerate(([1, 2], [3, 4, 5], [6])):
        spark.createDataFrame(_records(ids), RECORD).coalesce(1).write.mode("append").parquet(f"{tmp}/in")
    out = jobs.ArrivalOutputs(f"{tmp}/rows", f"{tmp}/reports")
    ticks = iter(range(0, 10_000, 61))
    src = jobs.processed_file_source(spark, f"{tmp}/in", 1)
    for _ in range(2):      # the second start finds nothing new and reports nothing
        q = jobs.start_arrival_monitor(src, out, f"{tmp}/ck", trigger={"availableNow": True}, clock=lambda: float(next(ticks)))
        q.awaitTermination()
    got = jobs.arrival_reports(spark, out).collect()
    assert sorted(r.total_messages for r in got) == [1, 2, 3]


def test_exact_windows_on_a_stream(spark, tmp):
    rnd = random.Random(1)
    rows = [(str(i), 1000.0 + i, 1000.0 + i + rnd.choice([0.5, 1.25, rnd.random() * 9]), "c", 0) for i in range(400)]
    late = [("z", 5000.0, 5001.0, "c", 0)]      # moves the watermark past all of them
    for part in (rows[:200], rows[200:], late, [("y", 9000.0, 9001.0, "c", 0)]):
        spark.createDataFrame(part, RECORD).coalesce(1).write.mode("append").parquet(f"{tmp}/in")
    q = jobs.start_window_reports(jobs.processed_file_source(spark, f"{tmp}/in", 1), f"{tmp}/out", f"{tmp}/ck", watermark="1 minute")
    q.awaitTermination()
    got = spark.read.parquet(f"{tmp}/out").drop("batch_id").orderBy("window_start").collect()
    want = lt.tumbling_report(lt.latency_rows(spark.createDataFrame(rows + late, RECORD))).orderBy("window_start").collect()
    assert len(got) == len(want) > 5
    for a, b in zip(got, want):
        assert (a.window_start, a.window_end, a.total_messages) == (b.window_start, b.window_end, b.total_messages)
        for c in ("max_latency_ms", "min_latency_ms", "avg_latency_ms", "p95_latency_ms", "p99_latency_ms"):
            assert a[c] == pytest.approx(b[c], abs=1e-6)
