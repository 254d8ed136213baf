"""Published history as a log-structured table.

A batch's rows are one data folder; an empty commit file of the same name is the
only thing that makes the folder part of the table, and creating it is one step.  So
nothing is renamed, a replayed batch finds its commit and adds nothing, and what a
crash leaves behind is a folder that no commit names, which readers never see and
``sweep`` removes.  Should two drivers commit one batch at once, readers take the
commit of the smaller name, so its rows count once.

Commits cover intervals of batch ids.  ``merge`` combines ``FANOUT`` neighbours of one
size class into one commit of the next, so a reader opens fewer than ``FANOUT``
folders of each class: a logarithm of the number of batches, which hold each key at
most so many times, instead of every batch ever published.  A commit that lies inside
a wider one is superseded.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

FANOUT = 8
COMMITS, DATA = "_commits", "data"


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _entries(spark: SparkSession, path: str) -> list[tuple[str, float]]:
    """(name, age in seconds) of what a folder holds."""
    p, fs = _path(spark, path)
    now = time.time()
    return [(s.getPath().getName(), now - s.getModificationTime() / 1000) for s in fs.listStatus(p)] if fs.exists(p) else []


def commits(spark: SparkSession, root: str) -> list[tuple[int, int, str]]:
    """(first batch, last batch, folder) of every commit, superseded ones included."""
    out = []
    for name, _ in _entries(spark, f"{root.rstrip('/')}/{COMMITS}"):
        lo, hi, _id = name.split("-")
        out.append((int(lo), int(hi), name))
    return sorted(out, key=lambda c: (c[0], -c[1], c[2]))


def live(spark: SparkSession, root: str) -> list[tuple[int, int, str]]:
    """The commits that make up the table: disjoint intervals, the widest ones.
    Merged intervals hold whole ones, so intervals are nested or apart."""
    out: list[tuple[int, int, str]] = []
    for c in commits(spark, root):
        if not out or c[0] > out[-1][1]:
            out.append(c)
    return out


def commit(df: DataFrame, root: str, lo: int, hi: int | None = None) -> bool:
    """Add ``df`` as the rows of batch ``lo`` (or of the batches ``lo`` to ``hi``): False,
    and nothing added, if they are there."""
    spark, hi, root = df.sparkSession, lo if hi is None else hi, root.rstrip("/")
    if any(a <= lo and hi <= b for a, b, _ in commits(spark, root)):
        return False
    name = f"{lo}-{hi}-{uuid.uuid4().hex}"
    df.write.parquet(f"{root}/{DATA}/{name}")
    mark, fs = _path(spark, f"{root}/{COMMITS}/{name}")
    fs.create(mark, False).close()
    return True


def read(spark: SparkSession, root: str, part: list[tuple[int, int, str]] | None = None) -> DataFrame | None:
    """The table's rows (of the commits ``part`` alone); None before the first commit."""
    part = live(spark, root) if part is None else part
    return spark.read.parquet(*[f"{root.rstrip('/')}/{DATA}/{name}" for *_, name in part]) if part else None


def _class(lo: int, hi: int) -> int:
    size, out = hi - lo + 1, 0
    while size >= FANOUT:
        size //= FANOUT
        out += 1
    return out


def merge(spark: SparkSession, root: str, combine: Callable[[DataFrame], DataFrame]) -> int:
    """Merge until no ``FANOUT`` neighbours of one class are left; returns the number
    of merges.  ``combine`` reduces the rows of several commits to those of one.  A
    crash leaves either the old commits or, once the wider one is there, the new."""
    done = 0
    while True:
        now = live(spark, root)
        for at in range(len(now) - FANOUT + 1):
            part = now[at:at + FANOUT]
            if len({_class(lo, hi) for lo, hi, _ in part}) == 1:
                break
        else:
            return done
        commit(combine(read(spark, root, part)), root, part[0][0], part[-1][1])
        done += 1


def sweep(spark: SparkSession, root: str, older_than: float = 3600.0) -> int:
    """Remove data that no live commit names, and superseded commits, if older than so
    many seconds (a reader or a writer may still be at work on younger ones)."""
    root, kept, gone = root.rstrip("/"), {c[2] for c in live(spark, root)}, 0
    for folder in (COMMITS, DATA):   # a commit goes before its data
        for name, age in _entries(spark, f"{root}/{folder}"):
            if name not in kept and age >= older_than:
                p, fs = _path(spark, f"{root}/{folder}/{name}")
                fs.delete(p, True)
                gone += 1
    return gone
