"""Exact quantiles (linear interpolation) without a sort of the input.

``percentile`` merges all distinct values of a group in one task.  Here

1. one plain aggregate gives each group's size and, from a mergeable sketch,
   two values around each quantile that are sure to enclose it;
2. a second pass counts what lies below the enclosed band in one number, and
   the band's values by value (so equal values collapse before the shuffle);
   the band is cut into ``CELLS`` cells of equal width;
3. running counts over the cells find the one or two that hold the order
   statistics around ``q * (n - 1)``, and only those cells are sorted.

Result equals pandas ``Series.quantile(q)`` (linear).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 10_000   # the sketch's ranks are off by at most n / ACCURACY
MARGIN = 3          # the band reaches so many of these steps to either side
CELLS = 1024


def quantile_name(q: float) -> str:
    return "p" + f"{q * 100:g}".replace(".", "_")


def _join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Null-safe equi-join; the keys are taken from the left side."""
    other = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = reduce(Column.__and__, [left[k].eqNullSafe(other[f"_r_{k}"]) for k in keys])
    return left.join(other, on).drop(*[f"_r_{k}" for k in keys])


def exact_quantiles(df: DataFrame, group_cols: Sequence[str], value_col: str,
                    qs: Sequence[float], extra: dict[str, Column] | None = None) -> DataFrame:
    """(group_cols..., extra..., p<q>...) for each q in ``qs``; nulls are
    ignored.  ``extra`` are more aggregates of ``_v`` (the value) computed in
    the same per-group aggregate (e.g. count, min, max, mean)."""
    groups = list(group_cols)
    extra = extra or {}
    carry = groups + list(extra)
    step = MARGIN / ACCURACY
    vals = df.select(*groups, F.col(value_col).cast("double").alias("_v")).where(F.col("_v").isNotNull())

    around = [min(1.0, max(0.0, q + d)) for q in qs for d in (-step, step)]
    stats = vals.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_min"), F.max("_v").alias("_max"),
        F.percentile_approx("_v", around, ACCURACY).alias("_s"),
        *[c.alias(k) for k, c in extra.items()]).where("_n > 0")
    small = F.col("_n") <= 2 * ACCURACY    # a step is under two rows: all values are the band
    want = []
    for i, q in enumerate(qs):
        pos = F.lit(float(q)) * (F.col("_n") - 1)
        want.append(F.struct(F.lit(quantile_name(q)).alias("_q"),
                             F.floor(pos).cast("long").alias("_r0"), F.ceil(pos).cast("long").alias("_r1"),
                             (pos - F.floor(pos)).alias("_frac"),
                             F.when(small, F.col("_min")).otherwise(F.col("_s")[2 * i]).alias("_lo"),
                             F.when(small, F.col("_max")).otherwise(F.col("_s")[2 * i + 1]).alias("_hi")))
    targets = stats.select(*carry, F.explode(F.array(*want)).alias("_t")).select(*carry, "_t.*")

    # Without groups there is one row for each q.  With groups, adaptive execution
    # broadcasts what it has measured to be small, else splits a skewed group.
    near = _join(vals, targets, groups) if groups else vals.join(F.broadcast(targets), F.col("_v") <= F.col("_hi"))
    cell = F.when(F.col("_v") < F.col("_lo"), 0).when(F.col("_hi") <= F.col("_lo"), 1).otherwise(
        1 + F.least(F.floor((F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * CELLS), F.lit(CELLS - 1)))
    counts = near.where("_v <= _hi").select(
        *carry, "_q", "_r0", "_r1", "_frac", cell.cast("int").alias("_cell"),
        F.when(F.col("_v") >= F.col("_lo"), F.col("_v")).alias("_v"))
    counts = counts.groupBy(*carry, "_q", "_r0", "_r1", "_frac", "_cell", "_v").agg(F.count(F.lit(1)).alias("_c"))

    keys = [*groups, "_q"]
    cells = counts.groupBy(*keys, "_r0", "_r1", "_cell").agg(F.sum("_c").alias("_c"))
    cells = cells.withColumn("_end", F.sum("_c").over(Window.partitionBy(*keys).orderBy("_cell")))
    base = F.when(F.col("_cell") == 0, F.raise_error(F.lit("the sketch's band does not hold the quantile"))) \
        .otherwise(F.col("_end") - F.col("_c"))
    cells = cells.where("_end > _r0 and _end - _c <= _r1").select(*keys, "_cell", base.cast("long").alias("_base"))

    held = _join(counts, cells, [*keys, "_cell"])
    end = F.col("_base") + F.sum("_c").over(Window.partitionBy(*keys, "_cell").orderBy("_v"))
    held = held.withColumn("_end", end).groupBy(*carry, "_q", "_frac").agg(
        F.min(F.when(F.col("_end") > F.col("_r0"), F.col("_v"))).alias("_lo_v"),
        F.min(F.when(F.col("_end") > F.col("_r1"), F.col("_v"))).alias("_hi_v"))
    value = F.col("_lo_v") + (F.col("_hi_v") - F.col("_lo_v")) * F.col("_frac")
    return held.groupBy(*carry).agg(
        *[F.max(F.when(F.col("_q") == quantile_name(q), value)).alias(quantile_name(q)) for q in qs],
        F.count(F.lit(1)).alias("_rows")).where("_rows > 0").drop("_rows")
