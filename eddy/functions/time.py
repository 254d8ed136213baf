"""Epoch / timestamp conversions and latency arithmetic.

All conversions work in integer microseconds so that Spark and DuckDB agree
bit for bit; wall-clock strings use the session time zone, fixed to UTC.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def epoch_micros(epoch_seconds: Column) -> Column:
    """seconds (double, may be NaN/inf/text) -> bigint micros, null when
    not representable (no ANSI overflow error)."""
    x = epoch_seconds.try_cast("double")
    ok = x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(9.2e12))
    return F.when(ok, F.round(x * F.lit(1_000_000)).try_cast("long"))


def epoch_to_ts(epoch_seconds: Column) -> Column:
    """epoch seconds -> timestamp (instant)."""
    return F.timestamp_micros(epoch_micros(epoch_seconds))


def epoch_to_local(epoch_seconds: Column) -> Column:
    """F2 as a naive wall-clock value in the session zone (timestamp_ntz)."""
    return epoch_to_ts(epoch_seconds).cast("timestamp_ntz")


def epoch_to_iso(epoch_seconds: Column) -> Column:
    """F1: ``datetime.fromtimestamp(x).isoformat()``: seconds precision,
    plus a 6-digit fraction only when the fraction is non-zero."""
    us = epoch_micros(epoch_seconds)
    ts = F.timestamp_micros(us)
    return F.when(F.pmod(us, F.lit(1_000_000)) != 0, F.date_format(ts, ISO_MICROS)) \
        .otherwise(F.date_format(ts, ISO_SECONDS))


def latency_ms(original_seconds: Column, processing_seconds: Column) -> Column:
    """(processing - original) * 1000."""
    return (processing_seconds.try_cast("double") - original_seconds.try_cast("double")) * F.lit(1000.0)
