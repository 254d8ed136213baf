"""Explicit schemas for every record type (never inferred).

Field names on the wire keep the reference's keys (CSV header digits); inside
Spark the columns are renamed once at ingest.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Wire keys of a comment message (the CSV header of the comments file).
KEY_INDEX = "Unnamed: 0"
KEY_TEXT = "1"
KEY_COMMENT_ID = "2"
KEY_CREATED = "5"
KEY_ID = "id"

# Comment as read from CSV: blank header column, then "1", "2", "5".
COMMENT_CSV = T.StructType([
    T.StructField("row_index", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("comment_id", T.StringType()),
    T.StructField("created_utc", T.DoubleType()),
])

# Comment message payload (JSON) with wire names.
COMMENT_MESSAGE = T.StructType([
    T.StructField(KEY_INDEX, T.LongType()),
    T.StructField(KEY_TEXT, T.StringType()),
    T.StructField(KEY_COMMENT_ID, T.StringType()),
    T.StructField(KEY_CREATED, T.DoubleType()),
    T.StructField(KEY_ID, T.StringType()),
])

# Column renames from wire keys to our names.
COMMENT_RENAMES = {KEY_INDEX: "row_index", KEY_TEXT: "text", KEY_COMMENT_ID: "comment_id",
                   KEY_CREATED: "created_utc", KEY_ID: "id"}

# Processed record published by the time-conversion consumer.
PROCESSED = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("timestamp", T.DoubleType()),
    T.StructField("processing_time", T.DoubleType()),
    T.StructField("processed_by", T.StringType()),
])

# Message envelope as a topic/file stream carries it.
MESSAGE = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
])
