"""Row validation: keep good rows, set bad ones aside with a reason.

The reference logs and skips a bad message; here each check is a named
predicate that is true for a *bad* row, the first failing check becomes the
reason, and the rejects keep the raw row as JSON with the stage name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Epoch seconds of 0001-01-01 and of 10000-01-01 (UTC).
MIN_EPOCH, END_EPOCH = -62135596800.0, 253402300800.0


def text_missing(text: Column) -> Column:
    """Text is not a string (null after a typed decode)."""
    return text.isNull()


def text_empty(text: Column) -> Column:
    """Empty text."""
    return F.length(text) == 0


def message_empty(value: Column) -> Column:
    """Null or empty message body."""
    return value.isNull() | F.trim(value).isin("", "{}", "null")


def time_invalid(t: Column) -> Column:
    """Falsy or non-numeric creation time (null, 0, NaN, text), or one
    outside the years 1 to 9999 (infinities included)."""
    x = t.try_cast("double")
    return x.isNull() | (x == 0) | F.isnan(x) | (x < F.lit(MIN_EPOCH)) | (x >= F.lit(END_EPOCH))


def times_missing(original: Column, processing: Column) -> Column:
    """A latency input without one of its times."""
    return original.isNull() | processing.isNull()


def split_valid(df: DataFrame, checks: list[tuple[str, Column]], stage: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejects(row, stage, reason)).

    Both outputs derive from the same input; persist it first when it is
    expensive (stream batches are persisted by the caller)."""
    reason = F.coalesce(*[F.when(bad, F.lit(name)) for name, bad in checks], F.lit(None).cast("string")) \
        if len(checks) > 1 else F.when(checks[0][1], F.lit(checks[0][0]))
    tagged = df.withColumn("_reason", reason)
    good = tagged.where(F.col("_reason").isNull()).drop("_reason")
    rejects = tagged.where(F.col("_reason").isNotNull()).select(
        F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("row"),
        F.lit(stage).alias("stage"), F.col("_reason").alias("reason"))
    return good, rejects


def validation_summary(df: DataFrame, checks: list[tuple[str, Column]], stage: str) -> DataFrame:
    """(stage, status, n): 'ok' or the reject reason, with row counts."""
    reason = F.coalesce(*[F.when(bad, F.lit(name)) for name, bad in checks], F.lit("ok"))
    return (df.select(F.lit(stage).alias("stage"), reason.alias("status"))
            .groupBy("stage", "status").agg(F.count(F.lit(1)).alias("n")))
