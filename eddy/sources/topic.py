"""The message-topic model as DataFrame operations.

A topic is a table of (key, value, partition, offset).  Producing assigns the
key and the partition; consuming reads every partition exactly once (Spark
runs one task per topic partition, or per split of it), so the reference's
static partition ranges are only needed as a label for per-consumer stats.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stride_shard_id(row_index: Column, n: int) -> Column:
    """Producer that owns data row r (0-based): r mod n."""
    return F.pmod(row_index, F.lit(n)).cast("int")


def stride_shard(df: DataFrame, n: int, k: int, row_index: str = "row_index") -> DataFrame:
    """The rows producer ``k`` of ``n`` sends (disjoint, covering)."""
    return df.where(stride_shard_id(F.col(row_index), n) == k)


def message_key(value: Column) -> Column:
    """Content key; null when the value is null or empty.

    The reference keys by the process-salted ``hash()`` of the text, which
    cannot be reproduced; md5 of the UTF-8 value is stable across runs."""
    return F.when(value.isNotNull() & (F.length(value) > 0), F.md5(value))


def partition_for_key(key: Column, num_partitions: int) -> Column:
    """partition = first 32 bits of the key's hex digest mod P; a
    message without a key (empty value) goes to partition 0."""
    bucket = F.conv(F.substring(key, 1, 8), 16, 10).cast("long")
    return F.coalesce(F.pmod(bucket, F.lit(num_partitions)), F.lit(0)).cast("int")


def produce(df: DataFrame, num_partitions: int, value_col: str = "value") -> DataFrame:
    """S6 + S7: add (key, partition) to encoded messages."""
    return (df.withColumn("key", message_key(F.col(value_col)))
            .withColumn("partition", partition_for_key(F.col("key"), num_partitions)))


def partition_counts(messages: DataFrame) -> DataFrame:
    """(partition, n) sent per partition."""
    return messages.groupBy("partition").agg(F.count(F.lit(1)).alias("n"))


def consumer_for_partition(partition: Column, num_partitions: int, num_consumers: int) -> Column:
    """Consumer c owns the contiguous range [c*(P//C), (c+1)*(P//C));
    with fewer partitions than consumers each partition has one owner; the
    partitions left over by the integer division go to the last consumer so
    that every partition is read exactly once."""
    per = max(num_partitions // num_consumers, 1)
    c = F.least(F.floor(partition / F.lit(per)), F.lit(num_consumers - 1)).cast("int")
    return F.concat(F.lit("consumer_"), c.cast("string"))


def consumer_assignment(messages: DataFrame, num_partitions: int, num_consumers: int) -> DataFrame:
    """(partition, consumer, n) over a topic table."""
    return (partition_counts(messages)
            .withColumn("consumer", consumer_for_partition(F.col("partition"), num_partitions, num_consumers))
            .select("partition", "consumer", "n"))


def end_offsets(messages: DataFrame) -> DataFrame:
    """(partition, end_offset) = last offset + 1 per partition."""
    return messages.groupBy("partition").agg((F.max("offset") + 1).alias("end_offset"))
