"""Bindings from the supplied parquet tables to the comment-stream data model.

The reference consumes a comments CSV and Kafka records; the test data here is
a set of parquet tables.  These functions present those tables in our schema
(see ``eddy.schema``) with the same expressions the DuckDB oracle uses:

- comment text   = ``documents(doc_id, text)``; ``comment_id`` = doc_id
- comment time   = ``events.ts`` (epoch seconds, UTC)
- processed msg  = ``events``: processing time ``ts + value`` seconds,
  ``processed_by = consumer_<event_id % 10>``, topic partition
  ``event_id % 5``, offset = position of the event inside its partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eddy.session import read_table, table_path  # noqa: F401

# Stand-in topic layout for the events table (fixed by the test binding).
EVENT_PARTITIONS = 5
EVENT_CONSUMERS = 10


def spread(df: DataFrame) -> DataFrame:
    """Give a CPU-heavy scan at least one task per core.

    Large inputs are already split by the file source (one task per
    ``spark.sql.files.maxPartitionBytes``) and pass through untouched; a
    small file with a single row group would otherwise run all regex work in
    one task.  The check only plans the scan; it runs no job.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df


def documents(spark: SparkSession, sf_dir: str, columns=("doc_id", "text")) -> DataFrame:
    return spread(read_table(spark, sf_dir, "documents").select(*columns))


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as comment rows: (row_index, comment_id, text)."""
    d = read_table(spark, sf_dir, "documents")
    return spread(d.select(F.col("doc_id").alias("row_index"),
                           F.col("doc_id").cast("string").alias("comment_id"),
                           "text"))


def epoch_seconds(ts_col: str = "ts"):
    """Epoch seconds of a timestamp(_ntz) column read as UTC, as double."""
    return F.unix_micros(F.col(ts_col).cast("timestamp")) / F.lit(1e6)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events")


def processed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as processed-message records with topic metadata.

    (id, timestamp, processing_time, processed_by, partition, offset,
    event_type).  Event ids are dense and increasing, so the position of an
    event inside its partition is ``event_id div P`` (no window needed).
    """
    e = events(spark, sf_dir)
    created = epoch_seconds("ts")
    return e.select(
        F.col("event_id").cast("string").alias("id"),
        created.alias("timestamp"),
        (created + F.col("value")).alias("processing_time"),
        F.concat(F.lit("consumer_"), F.pmod("event_id", F.lit(EVENT_CONSUMERS)).cast("string")).alias("processed_by"),
        F.pmod("event_id", F.lit(EVENT_PARTITIONS)).cast("int").alias("partition"),
        F.floor(F.col("event_id") / EVENT_PARTITIONS).cast("long").alias("offset"),
        "event_type",
    )


def comments_with_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comment rows with a creation time: documents joined to the event
    with the same id (``created_utc`` = that event's epoch seconds)."""
    d = spread(read_table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("row_index"), "text", F.col("doc_id").cast("string").alias("comment_id")))
    e = events(spark, sf_dir).select(F.col("event_id").alias("row_index"), epoch_seconds("ts").alias("created_utc"))
    return d.join(e.hint("merge"), "row_index", "left")


# Faults that the supplied rows lack, by id; the oracle uses the same rules.

def faulty_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """comments whose text is null (id mod 7 = 0) or empty (1)."""
    k = F.pmod("row_index", F.lit(7))
    return comments(spark, sf_dir).withColumn("text", F.when(k == 0, None).when(k == 1, "").otherwise(F.col("text")))


def faulty_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as (row_index, created_utc), the time being 0, NaN, infinite, too
    large or null where the id mod 11 is 0 to 4."""
    k = F.pmod("event_id", F.lit(11))
    t = (F.when(k == 0, 0.0).when(k == 1, float("nan")).when(k == 2, float("inf")).when(k == 3, 1e15)
         .when(k == 4, None).otherwise(epoch_seconds("ts")))
    return events(spark, sf_dir).select(F.col("event_id").alias("row_index"), t.alias("created_utc"))


# Words that the invented prose lacks: abbreviations, initials, numbers with a
# period, and words of two tokens.
SPOKEN = ("Dr. Ana cannot visit the U.S. today, etc. and J. Smith says: gimme no. 5. He's gonna (or gotta) see. Dr. Ben left... "
          "cannot/cannot 'tis so! Wanna go? d'ye know \"more'n\" that. ")


def spoken_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents, those whose id is a multiple of 13 with ``SPOKEN`` before the text."""
    d = documents(spark, sf_dir)
    return d.withColumn("text", F.when(F.pmod("doc_id", F.lit(13)) == 0, F.concat(F.lit(SPOKEN), "text")).otherwise(F.col("text")))
