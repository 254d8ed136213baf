"""A topic as a folder: keyed, partitioned writes with dense offsets.

A message goes to the partition its key names; within a partition offsets are dense
and go on from batch to batch.  Each batch is published as a whole once; the end
offsets of the partitions, one row each, are committed after it to a small history.
If a run dies in between, the replayed batch finds its messages there and only makes
up the end offsets, so no offset is skipped or given twice.

Offsets inside a batch come from a range sort over all tasks, not from a window over
a partition, so a partition that gets most of the messages uses all tasks too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eddy.operators.ranking import global_rank
from eddy.sources.topic import message_key, partition_for_key
from eddy.streaming import history, jobs


def end_offsets(spark: SparkSession, root: str) -> DataFrame | None:
    """(partition, end_offset) of what has been published; None before that."""
    rows = history.read(spark, f"{root.rstrip('/')}/_ends")
    return None if rows is None else _latest(rows).select("partition", "end_offset")


def _latest(rows: DataFrame) -> DataFrame:
    """A partition's latest end offset (a row for each partition of the topic)."""
    return rows.groupBy("partition").agg(F.max("end_offset").alias("end_offset"))


def append(batch: DataFrame, root: str, batch_id: int, partitions: int, topic: str, order: list[str]) -> bool:
    """Append ``batch(value, ...)`` to the topic at ``root``: False, and no message
    added, if the batch is there.

    A ``key`` column is kept, else the key is that of the value (S6); messages stand
    in the order of ``order`` within their partition.  Null values and keys are kept;
    a message without a key goes to partition 0.
    """
    spark, root = batch.sparkSession, root.rstrip("/")
    key = F.col("key") if "key" in batch.columns else message_key(F.col("value"))
    rows = batch.select(key.alias("key"), "value", *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)])
    hashed = F.when(F.col("key").rlike("^[0-9a-f]{32}$"), F.col("key")).otherwise(F.md5("key"))
    rows = rows.withColumn("partition", partition_for_key(hashed, partitions))
    by = [F.asc("partition"), *[F.asc(f"_o{i}") for i in range(len(order))], F.asc("key"), F.asc("value")]
    ranked = global_rank(rows, by, "_r")
    start = ranked.groupBy("partition").agg(F.min("_r").alias("_first"))       # one row a partition
    ends = end_offsets(spark, root)
    start = start.withColumn("_base", F.lit(0).cast("long")) if ends is None else start.join(
        F.broadcast(ends), "partition", "left").withColumn("_base", F.coalesce("end_offset", F.lit(0))).drop("end_offset")
    out = ranked.join(F.broadcast(start), "partition").select(
        "key", "value", F.lit(topic).alias("topic"), "partition", (F.col("_r") - F.col("_first") + F.col("_base")).alias("offset"))
    new = jobs.publish(out, root, batch_id)
    done = spark.read.parquet(f"{root}/batch_id={batch_id}")
    history.commit(done.groupBy("partition").agg((F.max("offset") + 1).alias("end_offset")), f"{root}/_ends", batch_id)
    history.merge(spark, f"{root}/_ends", _latest)
    return new


def start_topic(messages: DataFrame, root: str, checkpoint: str, partitions: int, topic: str, order: list[str],
                trigger: dict | None = None) -> StreamingQuery:
    """A stream of messages into the topic at ``root``."""
    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if not batch.isEmpty():
                append(batch, root, batch_id, partitions, topic, order)
        finally:
            batch.unpersist()
    q = messages.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return q.trigger(**(trigger or {"availableNow": True})).start()


def lag(spark: SparkSession, root: str, consumed: DataFrame) -> DataFrame:
    """(partition, end_offset, position, lag) of a consumer that has published
    ``consumed(partition, offset, ...)``: the first offset it lacks of each partition,
    and how many messages stand behind that.  Rows may repeat."""
    seen = consumed.groupBy("partition", "offset").agg(F.lit(1).alias("one")).groupBy("partition").agg(
        F.count(F.lit(1)).alias("n"), (F.max("offset") + 1).alias("top"))
    whole = F.coalesce(F.when(F.col("n") == F.col("top"), F.col("top")), F.col("n"), F.lit(0))
    ends = end_offsets(spark, root)
    return ends.join(seen, "partition", "left").select(
        "partition", "end_offset", whole.alias("position"), (F.col("end_offset") - whole).alias("lag"))
