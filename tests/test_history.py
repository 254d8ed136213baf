"""The published history: commits, replays, merges, crashes, sweeping."""

import os

import pytest
from pyspark.sql import functions as F

from eddy.streaming import history as hs
from eddy.streaming.jobs import latest_counts


def _delta(spark, batch, keys):
    return spark.createDataFrame([("keywords", k, n, batch) for k, n in keys.items()], "dimension string, key string, n long, as_of long") \
        .withColumn("updated_at", F.timestamp_seconds(F.lit(batch)))


def _counts(spark, root):
    return {r.key: r.n for r in latest_counts(hs.read(spark, root)).collect()}


def test_merges_keep_the_latest_counts(spark, tmp, monkeypatch):
    monkeypatch.setattr(hs, "FANOUT", 3)
    want = {}
    for b in range(20):
        keys = {f"k{b % 4}": 10 * b + 1, "all": b}
        want |= keys
        assert hs.commit(_delta(spark, b, keys), tmp, b)
        assert not hs.commit(_delta(spark, b, {"all": 999}), tmp, b)     # a replay
        hs.merge(spark, tmp, latest_counts)
        assert len(hs.live(spark, tmp)) <= 2 * 3                          # FANOUT - 1 of each class
    assert _counts(spark, tmp) == want
    assert hs.read(spark, tmp).count() <= len(hs.live(spark, tmp)) * 5
    assert not hs.commit(_delta(spark, 4, {"all": 999}), tmp, 4)          # a replay of a merged batch
    before = len(os.listdir(f"{tmp}/data"))
    assert hs.sweep(spark, tmp, older_than=3600) == 0
    assert hs.sweep(spark, tmp, older_than=-1) > 0
    assert len(os.listdir(f"{tmp}/data")) < before and _counts(spark, tmp) == want


@pytest.mark.parametrize("step", ["write", "create"])
def test_a_crash_at_each_step_leaves_the_old_or_the_new(spark, tmp, monkeypatch, step):
    monkeypatch.setattr(hs, "FANOUT", 2)
    hs.commit(_delta(spark, 0, {"a": 1}), tmp, 0)
    hs.commit(_delta(spark, 1, {"a": 2}), tmp, 1)
    real = hs._path

    def crash(spark_, path):
        if "_commits/" in path:
            raise KeyboardInterrupt
        return real(spark_, path)
    if step == "create":        # after the data, before the commit file
        monkeypatch.setattr(hs, "_path", crash)
        with pytest.raises(KeyboardInterrupt):
            hs.merge(spark, tmp, latest_counts)
        monkeypatch.setattr(hs, "_path", real)
    else:                       # while the rows are combined
        with pytest.raises(ZeroDivisionError):
            hs.merge(spark, tmp, lambda rows: 1 / 0)
    assert _counts(spark, tmp) == {"a": 2} and len(hs.live(spark, tmp)) == 2
    assert hs.merge(spark, tmp, latest_counts) == 1 and len(hs.live(spark, tmp)) == 1
    hs.sweep(spark, tmp, older_than=-1)
    assert len(os.listdir(f"{tmp}/data")) == 1 and _counts(spark, tmp) == {"a": 2}


def test_two_commits_of_one_batch_count_once(spark, tmp):
    hs.commit(_delta(spark, 0, {"a": 1}), tmp, 0)
    name = hs.live(spark, tmp)[0][2]
    other = "0-0-" + "f" * 32
    _delta(spark, 0, {"a": 1}).write.parquet(f"{tmp}/data/{other}")
    open(f"{tmp}/_commits/{other}", "w").close()
    assert len(hs.live(spark, tmp)) == 1 and hs.read(spark, tmp).count() == 1
    assert hs.live(spark, tmp)[0][2] == min(name, other)
    assert hs.read(spark, f"{tmp}/none") is None
