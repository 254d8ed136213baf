"""Processing-latency rows and reports.

``processed`` records carry (id, timestamp = comment creation epoch,
processing_time epoch, processed_by, partition).  Latency is
``(processing_time - timestamp) * 1000`` ms; on replayed historic data it is
the comment's age when processed, which is what the reference measures too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddy.functions.fields import with_default
from eddy.functions.time import epoch_to_local, latency_ms
from eddy.operators.quantiles import exact_quantiles, quantile_name

QUANTILES = (0.95, 0.99)


def latency_inputs(processed: DataFrame) -> DataFrame:
    """Both times present (0 is a valid time here)."""
    return processed.where(F.col("timestamp").isNotNull() & F.col("processing_time").isNotNull())


def latency_rows(processed: DataFrame, now: Column | None = None) -> DataFrame:
    """one latency row per processed record (the latency CSV layout).

    ``now`` is the monitor's clock (``current_timestamp()`` in a stream); it
    is left out when None so batch results are reproducible.
    """
    cols = []
    if now is not None:
        cols.append(now.alias("timestamp"))
    cols += [with_default(F.col("id"), "unknown").alias("message_id"),
             latency_ms(F.col("timestamp"), F.col("processing_time")).alias("latency_ms"),
             epoch_to_local(F.col("timestamp")).alias("original_time"),
             epoch_to_local(F.col("processing_time")).alias("processing_time"),
             with_default(F.col("processed_by"), "unknown").alias("processed_by"),
             F.col("partition").cast("int").alias("partition")]
    return latency_inputs(processed).select(*cols)


def latency_report(rows: DataFrame, groups: Sequence[str] = (), qs=QUANTILES) -> DataFrame:
    """A5 + A6: count / max / min / mean and exact p95, p99 per group
    (one row for the whole input when ``groups`` is empty).  The basic
    statistics are computed in the quantile pipeline's own per-group
    aggregate, so nothing is joined back."""
    basic = {"total_messages": F.count(F.lit(1)),
             "max_latency_ms": F.max("_v"),
             "min_latency_ms": F.min("_v"),
             "avg_latency_ms": F.avg("_v")}
    q = exact_quantiles(rows, list(groups), "latency_ms", qs, basic)
    return q.select(*groups, *basic, *[F.col(quantile_name(x)).alias(f"{quantile_name(x)}_latency_ms") for x in qs])


def consumer_stats(rows: DataFrame) -> DataFrame:
    """Per consumer count, mean, min, max (all as double)."""
    return rows.groupBy("processed_by").agg(
        F.count(F.lit(1)).cast("double").alias("count"),
        F.avg("latency_ms").alias("mean"),
        F.min("latency_ms").cast("double").alias("min"),
        F.max("latency_ms").cast("double").alias("max"))


def tumbling_report(rows: DataFrame, interval: str = "60 seconds",
                    time_col: str = "processing_time", qs=QUANTILES) -> DataFrame:
    """The report per clock-aligned interval of processing time.

    Empty intervals produce no row (W5).  Columns: window_start, window_end
    plus the report columns.
    """
    w = rows.withColumn("_w", F.window(F.col(time_col).cast("timestamp"), interval))
    w = w.withColumn("window_start", F.col("_w.start").cast("timestamp_ntz")) \
         .withColumn("window_end", F.col("_w.end").cast("timestamp_ntz")).drop("_w")
    return latency_report(w, ["window_start", "window_end"], qs)
