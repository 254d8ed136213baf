"""Arrival-driven intervals on recorded times (W2), without a fold in one task.

A window opens at a key's first row, or where the last one closed, and closes on
the first row that arrives at least ``gap`` seconds later, that row included.
Which rows close windows is a chain: each closing row points to the next.

1. Rows are numbered in order of (key, time, id) by a range sort over all tasks.
2. Every row's successor, the first row ``gap`` later, comes from a second range
   sort of the rows together with their times plus ``gap``: both are in the same
   order, so a place in the merged order less the row's own number counts the rows
   before it.
3. Pointer doubling marks the rows that a key's first row reaches: round by round
   the marked rows mark those they point to, and pointers are joined with
   themselves; rounds grow with the logarithm of the number of windows.
4. A third range sort of rows and closing rows counts the closing rows before each
   row, which names its window.

No step groups by the key alone, so a key with all the rows uses all tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eddy.operators.latency import QUANTILES, latency_report
from eddy.operators.ranking import global_rank
from eddy.session import scratch_path


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def successors(rows: DataFrame, gap: float) -> DataFrame:
    """``rows(i, k, t)``, numbered from 1 in order of (k, t): (i, s), s being the
    first row of the same key with t at least ``gap`` later; rows without one are
    left out."""
    later = rows.select("k", (F.col("t") + F.lit(float(gap))).alias("t"), F.lit(0).alias("kind"), "i")
    both = rows.select("k", "t", F.lit(1).alias("kind"), "i").unionByName(later)
    order = [F.asc_nulls_first("k"), F.asc("t"), F.asc("kind"), F.asc("i")]
    placed = global_rank(both, order, "place").where("kind = 0").select("i", "k", (F.col("place") - F.col("i") + 1).alias("s"))
    found = placed.join(rows.select(F.col("i").alias("s"), F.col("k").alias("of")).hint("merge"), "s")
    return found.where(F.col("k").eqNullSafe(F.col("of"))).select("i", "s")


def reached(starts: DataFrame, pointers: DataFrame) -> DataFrame:
    """(i): the rows that the ``starts(i)`` reach over ``pointers(i, s)`` in one or
    more steps, by pointer doubling."""
    marked = _kept(starts.join(pointers.hint("merge"), "i").select(F.col("s").alias("i")), "arrival-marked")
    jump = pointers
    while not jump.isEmpty():
        new = marked.join(jump.hint("merge"), "i").select(F.col("s").alias("i"))
        marked = _kept(marked.unionByName(new).distinct(), "arrival-marked")
        far = jump.select("i", F.col("s").alias("m")).join(jump.select(F.col("i").alias("m"), "s").hint("merge"), "m")
        jump = _kept(far.select("i", "s"), "arrival-jump")
    return marked


def arrival_windows(rows: DataFrame, gap: float, key_col: str, time_col: str, id_col: str) -> DataFrame:
    """``rows`` with ``_window`` (equal for rows of one window of their key) and
    ``_closed_at`` (the time of the row that closed it; null while it is open).

    Rows without a time are left out; a null key is a key.  Rows that tie in key,
    time and id stand in any order; if one of them closes a window the others
    belong to the next.  An empty table gives no rows.
    """
    timed = rows.where(F.col(time_col).isNotNull() & ~F.isnan(F.col(time_col).cast("double"))).select(
        F.struct("*").alias("row"), F.col(key_col).cast("string").alias("k"), F.col(time_col).cast("double").alias("t"),
        F.col(id_col).alias("id"))
    ranked = _kept(global_rank(timed, [F.asc_nulls_first("k"), F.asc("t"), F.asc_nulls_first("id")], "i"), "arrival-rows")
    slim = ranked.select("i", "k", "t")
    pointers = _kept(successors(slim, gap), "arrival-next")
    starts = slim.groupBy("k").agg(F.min("i").alias("i")).select("i")
    closing = reached(starts, pointers)
    both = slim.select("i", F.lit(0).alias("kind")).unionByName(closing.select("i", F.lit(1).alias("kind")))
    window = global_rank(both, [F.asc("i"), F.asc("kind")], "place").where("kind = 0").select("i", (F.col("place") - F.col("i")).alias("w"))
    ends = closing.join(slim.hint("merge"), "i").join(window.hint("merge"), "i").select("k", "w", F.col("t").alias("closed"))
    out = ranked.join(window.hint("merge"), "i")
    # One row a window: adaptive execution splits a window that holds very many rows.
    ends = _kept(ends, "arrival-ends").withColumnsRenamed({"k": "k2", "w": "w2"})
    out = out.join(ends.hint("merge"), F.col("k").eqNullSafe(F.col("k2")) & (F.col("w") == F.col("w2")), "left")
    return out.select("row.*", F.col("w").alias("_window"), F.col("closed").alias("_closed_at"))


def arrival_report(rows: DataFrame, gap: float, key_col: str, time_col: str, id_col: str, qs=QUANTILES) -> DataFrame:
    """(key, closed_at, report columns) of every closed window of ``rows``, which
    hold ``latency_ms``.  Rows after a key's last closing row are not reported."""
    w = arrival_windows(rows, gap, key_col, time_col, id_col).where("_closed_at is not null")
    groups = [key_col, "_window", "_closed_at"]
    return latency_report(w, groups, qs).withColumnRenamed("_closed_at", "closed_at").drop("_window")
