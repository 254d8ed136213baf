"""Structured Streaming jobs built from the batch operators.

Every job reads a stream of messages, runs the same ``DataFrame ->
DataFrame`` operators the batch queries use, and publishes through
``foreachBatch`` one folder for each batch id.  A batch is written to a hidden
folder first and renamed when it is complete; a batch id that is already
published is left alone.  So a replayed batch makes no new file, a batch that
failed half-way shows none, and a stream that reads the folders counts each
message once.

Sources: a Kafka topic (``kafka_source``; needs the Kafka connector on the
classpath, which this environment does not have, so it is untested here) or a
folder of message files with the same columns (``file_source``), which is what
the tests drive.  ``maxFilesPerTrigger`` / ``maxOffsetsPerTrigger`` replace the
reference's sleep-based pacing (S17).
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eddy import schema as sc
from eddy.functions.fields import with_default
from eddy.functions.time import epoch_to_iso
from eddy.operators import latency as lt
from eddy.operators.quantiles import quantile_name
from eddy.operators import validate as va
from eddy.operators.language import LanguageProfile
from eddy.operators.ranking import global_rank
from eddy.plans.enrich import enrich
from eddy.sources import json_codec as jc
from eddy.sources.topic import consumer_for_partition
from eddy.streaming import history

# ----------------------------------- sources ----------------------------------


def kafka_source(spark: SparkSession, servers: str, topic: str,
                 max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Read a topic from the earliest offset; resumption comes from the
    query checkpoint (the consumer group of the reference)."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", "earliest"))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    df = r.load()
    return df.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
                     "topic", "partition", "offset")


def file_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                fmt: str = "parquet") -> DataFrame:
    """S9 stand-in: a folder of message files (key, value, topic, partition,
    offset), read as a stream from the first file on."""
    r = spark.readStream.schema(sc.MESSAGE).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def _batch_path(root: str, batch_id: int) -> str:
    return f"{root.rstrip('/')}/batch_id={batch_id}"


def publish(df: DataFrame, root: str, batch_id: int, fmt: str = "parquet", **options: str) -> bool:
    """Publish a batch once: False, and nothing written, if its id is there.

    The rows go to ``_staging`` (which file readers skip) and are renamed as a
    whole, so readers see all of a batch or none of it.
    """
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path
    target = path(_batch_path(root, batch_id))
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(target):
        return False
    staging = f"{root.rstrip('/')}/_staging/{batch_id}-{uuid.uuid4().hex}"
    df.write.format(fmt).options(**options).save(staging)
    if not fs.rename(path(staging), target):
        raise OSError(f"could not publish {target}")
    return True


# ------------------------- comment enrichment (W8, S12) ------------------------

@dataclass
class EnrichOutputs:
    enriched: str   # enriched comments, one folder per batch (next "topic")
    rejects: str    # rows set aside with a reason


def decode_comments(messages: DataFrame) -> DataFrame:
    """S4/S5 + renames: message rows -> comment columns + ``_json_ok``,
    ``_is_text`` and ``fields`` (all fields of the message, as text)."""
    d = jc.decode(messages, sc.COMMENT_MESSAGE)
    value = F.col("value")
    return d.select("key", "partition", "offset", "value", "_json_ok",
                    jc.is_text(value, sc.KEY_TEXT).alias("_is_text"),
                    F.from_json(jc.unwrap_double_encoded(value), "map<string,string>").alias("fields"),
                    *[F.col(k).alias(v) for k, v in sc.COMMENT_RENAMES.items()])


def enrich_batch(batch: DataFrame, profile: LanguageProfile, k: int = 3) -> tuple[DataFrame, DataFrame]:
    """One micro-batch of comment messages -> (enriched rows, rejects).

    Enriched rows carry the whole comment.  As in the reference, a text that is
    no string is set aside before the sentiment, and a comment without a
    keyword after it.
    """
    comments = decode_comments(batch)
    good, bad = va.split_valid(comments, [
        ("empty message", va.message_empty(F.col("value"))),
        ("unparseable message", ~F.col("_json_ok")),
    ], "decode")
    good, no_text = va.split_valid(good, [
        ("text not a string", ~F.col("_is_text") | va.text_missing(F.col("text")))], "sentiment")
    # A message is identified by its partition and offset together.
    good = good.drop("_json_ok", "_is_text", "value").withColumn("msg", F.struct("partition", "offset"))
    keep = [c for c in good.columns if c not in ("msg", "key")]
    out = enrich(good, profile, id_col="msg", k=k, keep=keep).drop("msg")
    out, no_keyword = va.split_valid(out, [("no keyword", F.size("keywords") == 0)], "keywords")
    return out, bad.unionByName(no_text).unionByName(no_keyword)


def enrichment_writer(profile: LanguageProfile, out: EnrichOutputs):
    """The ``foreachBatch`` function of the enrichment stream."""
    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if batch.isEmpty():  # W5: nothing arrived
                return
            enriched, bad = enrich_batch(batch, profile)
            publish(bad, out.rejects, batch_id)
            publish(enriched, out.enriched, batch_id)
        finally:
            batch.unpersist()
    return run


def start_enrichment(source: DataFrame, profile: LanguageProfile, out: EnrichOutputs, checkpoint: str,
                     trigger: dict | None = None) -> StreamingQuery:
    """Language -> sentiment -> keywords over a comment stream; each
    output row keeps its (partition, offset)."""
    w = source.writeStream.foreachBatch(enrichment_writer(profile, out)).option("checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


# --------------------------- running report (W6, S15) --------------------------

def report_counts_stream(enriched_stream: DataFrame) -> DataFrame:
    """Running counts by language, sentiment and keyword, as a streaming
    aggregate (state store holds one row per key)."""
    rep = enriched_stream.where(F.size("keywords") > 0)
    dims = F.array(
        F.struct(F.lit("languages").alias("dimension"), F.col("language").alias("key")),
        F.struct(F.lit("sentiments").alias("dimension"), F.col("sentiment").alias("key")))
    rows = (rep.select(F.explode(dims).alias("d")).select("d.dimension", "d.key")
            .unionByName(rep.select(F.lit("keywords").alias("dimension"), F.explode("keywords").alias("key"))))
    return rows.groupBy("dimension", "key").agg(F.count(F.lit(1)).alias("n"))


def start_report(enriched_stream: DataFrame, out_root: str, checkpoint: str,
                 trigger: dict | None = None) -> StreamingQuery:
    """After each batch, the counts that it changed (update mode) are committed to
    the history at ``out_root``, which is then merged; ``report_snapshot`` reads the
    whole report from it.  Written by the executors, never gathered on the driver."""
    def run(changed: DataFrame, batch_id: int) -> None:
        rows = changed.withColumns({"updated_at": F.current_timestamp(), "as_of": F.lit(batch_id).cast("long")})
        history.commit(rows, out_root, batch_id)
        history.merge(changed.sparkSession, out_root, latest_counts)
    q = (report_counts_stream(enriched_stream).writeStream.outputMode("update")
         .foreachBatch(run).option("checkpointLocation", checkpoint)
         .trigger(**(trigger or {"availableNow": True})))
    return q.start()


def latest_counts(rows: DataFrame) -> DataFrame:
    """The latest count of each key, and the time of the last update of any."""
    last = F.max_by(F.struct("n", "updated_at", "as_of"), "as_of").alias("l")
    return rows.groupBy("dimension", "key").agg(last).select("dimension", "key", "l.*")


def report_snapshot(spark: SparkSession, out_root: str, top: int = 10) -> tuple[DataFrame, DataFrame]:
    """(rows, json) of the running report: ``rows(dimension, key, n,
    rank)`` with the latest count of each key, ranked by count and then key, and
    one JSON line with the languages, the sentiments, the ``top`` keywords and the
    time of the last update.  Reads the merged history, a few rows a key however
    many batches there were.  Keywords are ranked by a range sort, not in one
    task."""
    rows = latest_counts(history.read(spark, out_root))
    last = rows.select("dimension", "key", "n")
    order = Window.partitionBy("dimension").orderBy(F.desc("n"), "key")
    few = last.where("dimension <> 'keywords'").withColumn("rank", F.row_number().over(order).cast("long"))
    words = global_rank(last.where("dimension = 'keywords'"), [F.desc("n"), F.asc("key")])
    ranked = few.unionByName(words)
    best = ranked.where((F.col("dimension") != "keywords") | (F.col("rank") <= top))

    def part(name):
        of = F.sort_array(F.collect_list(F.when(F.col("dimension") == name, F.struct("rank", "key", "n"))))
        return F.map_from_entries(F.transform(of, lambda x: F.struct(x["key"], x["n"])))

    when = rows.agg(F.max("updated_at").alias("updated_at")).select(
        F.lit("when").alias("dimension"), F.lit(None).cast("string").alias("key"), F.lit(None).cast("long").alias("n"),
        F.lit(None).cast("long").alias("rank"), "updated_at")
    report = best.withColumn("updated_at", F.lit(None).cast("timestamp")).unionByName(when).agg(
        part("languages").alias("languages"), part("sentiments").alias("sentiments"), part("keywords").alias("top_keywords"),
        F.date_format(F.max("updated_at"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"))
    return ranked, report.select(F.to_json(F.struct("*")).alias("value"))


# ------------------- time conversion consumer (S13, P6, P7, P10) ----------------

@dataclass
class ConvertOutputs:
    times_csv: str    # (timestamp, iso_datetime) CSV with header, per batch
    processed: str    # processed-message records (next topic), per batch
    rejects: str


def convert_batch(batch: DataFrame, num_partitions: int, num_consumers: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(times rows, processed records, rejects) for one micro-batch."""
    comments = decode_comments(batch)
    good, bad = va.split_valid(comments, [
        ("empty message", va.message_empty(F.col("value"))),
        ("unparseable message", ~F.col("_json_ok")),
        ("missing time", va.time_invalid(F.col("created_utc"))),
    ], "convert")
    times = good.select(F.col("created_utc").alias("timestamp"), epoch_to_iso(F.col("created_utc")).alias("iso_datetime"))
    processed = good.select(
        with_default(F.col("id"), "unknown").alias("id"),
        F.col("created_utc").alias("timestamp"),
        (F.unix_micros(F.current_timestamp()) / F.lit(1e6)).alias("processing_time"),   # F4
        consumer_for_partition(F.col("partition"), num_partitions, num_consumers).alias("processed_by"),
        F.col("partition").cast("int").alias("partition"))   # F7
    return times, processed, bad


def conversion_writer(out: ConvertOutputs, num_partitions: int, num_consumers: int):
    """The ``foreachBatch`` function of the time-conversion consumer."""
    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if batch.isEmpty():
                return
            times, processed, bad = convert_batch(batch, num_partitions, num_consumers)
            publish(times, out.times_csv, batch_id, "csv", header="true")
            publish(bad, out.rejects, batch_id)
            publish(processed, out.processed, batch_id)
        finally:
            batch.unpersist()
    return run


def start_conversion(source: DataFrame, out: ConvertOutputs, checkpoint: str, num_partitions: int,
                     num_consumers: int, trigger: dict | None = None) -> StreamingQuery:
    w = source.writeStream.foreachBatch(conversion_writer(out, num_partitions, num_consumers))
    w = w.option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


# ------------------------ latency monitor (W1, W4, W5, S14, S16) ----------------

@dataclass
class LatencyOutputs:
    rows_csv: str      # latency rows, CSV without header, per batch
    reports: str       # one JSON report line per batch
    consumers: str     # per-consumer statistics per batch


def latency_writer(out: LatencyOutputs):
    """The ``foreachBatch`` function of the latency monitor."""
    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if batch.isEmpty():
                return
            rows = lt.latency_rows(batch, now=F.current_timestamp()).persist()
            publish(rows, out.rows_csv, batch_id, "csv", header="false")
            report = lt.latency_report(rows.drop("timestamp")).select(
                F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"), "*")
            publish(report.select(F.to_json(F.struct("*")).alias("value")), out.reports, batch_id, "text")
            publish(lt.consumer_stats(rows), out.consumers, batch_id)
            rows.unpersist()
        finally:
            batch.unpersist()
    return run


def start_latency_monitor(processed_stream: DataFrame, out: LatencyOutputs, checkpoint: str,
                          interval: str = "60 seconds", final: bool = False) -> StreamingQuery:
    """One report per trigger interval over the records that arrived in
    it (processing-time trigger); ``final=True`` runs once over everything
    available and stops (W4, the flush on shutdown).  An interval without
    records writes nothing (W5)."""
    w = processed_stream.writeStream.foreachBatch(latency_writer(out)).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if final else w.trigger(processingTime=interval)
    return w.start()


def _published(spark: SparkSession, root: str) -> DataFrame | None:
    """What ``publish`` has put under ``root``, with its batch ids; None if nothing."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path) or not any(f.getPath().getName().startswith("batch_id=") for f in fs.listStatus(path)):
        return None
    return spark.read.option("basePath", root).parquet(root)


@dataclass
class ArrivalOutputs:
    rows: str      # latency rows, one folder a batch
    reports: str   # one row a report, with the batches it covers and the time it was made


def arrival_writer(out: ArrivalOutputs, interval: float = 60.0, clock=time.time):
    """The ``foreachBatch`` function of the arrival-driven monitor.

    As in the reference, a report is made when a valid record arrives at least
    ``interval`` seconds after the last report (or the start), and covers all
    records since then, this one included; without records nothing is reported,
    however long it takes (W5).  The records of one batch arrive together, at the
    time ``clock`` gives.  A report is one published folder that also holds the time
    and the batches it covers, so it is the whole state: a replayed batch finds its
    own report and makes no other.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = lt.latency_rows(batch, now=F.current_timestamp())
        publish(rows, out.rows, batch_id)
        arrived = spark.read.parquet(_batch_path(out.rows, batch_id))
        if arrived.isEmpty():
            return
        last = _published(spark, out.reports).where(F.col("batch_id") < batch_id).agg(
            F.max(F.struct("last_batch", "made_at")).alias("m")).first().m
        now = float(clock())
        if now - last.made_at < interval:
            return
        since = spark.read.option("basePath", out.rows).parquet(out.rows).where(
            (F.col("batch_id") > last.last_batch) & (F.col("batch_id") <= batch_id))
        report = lt.latency_report(since.drop("timestamp", "batch_id")).select(
            F.lit(now).alias("made_at"), F.lit(batch_id).cast("long").alias("last_batch"), "*")
        publish(report, out.reports, batch_id)
    return run


def begin_arrivals(spark: SparkSession, out: ArrivalOutputs, clock=time.time) -> None:
    """Publish the time the monitor began, as an empty report of batch -1, unless
    that is there from an earlier start."""
    schema = sc.T.StructType(sc.PROCESSED.fields + [sc.T.StructField("partition", sc.T.IntegerType())])
    columns = lt.latency_report(lt.latency_rows(spark.createDataFrame([], schema))).dtypes
    publish(spark.range(1).select(F.lit(float(clock())).alias("made_at"), F.lit(-1).cast("long").alias("last_batch"),
                                  *[F.lit(None).cast(t).alias(c) for c, t in columns]), out.reports, -1)


def start_arrival_monitor(processed_stream: DataFrame, out: ArrivalOutputs, checkpoint: str, interval: float = 60.0,
                          trigger: dict | None = None, clock=time.time) -> StreamingQuery:
    """The report on the first valid record ``interval`` seconds after the last
    report, or after the first start; restarts go on from the last report."""
    begin_arrivals(processed_stream.sparkSession, out, clock)
    w = processed_stream.writeStream.foreachBatch(arrival_writer(out, interval, clock))
    return w.option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "1 second"})).start()


def arrival_reports(spark: SparkSession, out: ArrivalOutputs) -> DataFrame:
    """The reports made so far, the starting row left out."""
    return _published(spark, out.reports).where("batch_id >= 0")


def value_counts_stream(processed_stream: DataFrame, interval: str = "60 seconds", watermark: str = "10 minutes") -> DataFrame:
    """W3 on a stream, without loss: how often each latency occurs in each window.
    The state holds a row for each distinct value of an open window, spread over all
    tasks; in append mode a window's rows come out together when it closes."""
    rows = lt.latency_rows(processed_stream).withColumn("pt", F.col("processing_time").cast("timestamp"))
    return (rows.withWatermark("pt", watermark).groupBy(F.window("pt", interval).alias("w"), "latency_ms")
            .agg(F.count(F.lit(1)).alias("n")))


def closed_window_report(counts: DataFrame) -> DataFrame:
    """``counts(w, latency_ms, n)`` of closed windows to the columns of
    ``tumbling_report``, p95 and p99 exact."""
    rows = counts.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), F.col("w.end").cast("timestamp_ntz").alias("window_end"),
                         "latency_ms", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("_i")).drop("_i")
    return lt.latency_report(rows, ["window_start", "window_end"])


def start_window_reports(processed_stream: DataFrame, out_root: str, checkpoint: str, interval: str = "60 seconds",
                         watermark: str = "10 minutes", trigger: dict | None = None) -> StreamingQuery:
    """The exact report of each clock-aligned window, published once when the
    watermark passes its end (``batch_id=<id>`` folders).  Records later than that are
    dropped by the watermark, as in any append-mode window."""
    def run(closed: DataFrame, batch_id: int) -> None:
        closed = closed.persist()
        try:
            if not closed.isEmpty():
                publish(closed_window_report(closed), out_root, batch_id)
        finally:
            closed.unpersist()
    q = value_counts_stream(processed_stream, interval, watermark).writeStream.outputMode("append").foreachBatch(run)
    return q.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def windowed_latency_stream(processed_stream: DataFrame, interval: str = "60 seconds",
                            watermark: str = "10 minutes") -> DataFrame:
    """W3 on a stream: event-time tumbling windows of processing time with a
    watermark: count / min / max / mean, and p95 / p99 from a mergeable sketch,
    so that a window's state stays bounded (ranks are off by at most 1/10,000 of
    the window).  For exact ones, take ``start_window_reports``."""
    rows = lt.latency_rows(processed_stream).withColumn("pt", F.col("processing_time").cast("timestamp"))
    return (rows.withWatermark("pt", watermark)
            .groupBy(F.window("pt", interval).alias("w"))
            .agg(F.count(F.lit(1)).alias("total_messages"), F.max("latency_ms").alias("max_latency_ms"),
                 F.min("latency_ms").alias("min_latency_ms"), F.avg("latency_ms").alias("avg_latency_ms"),
                 *[F.percentile_approx("latency_ms", x, 10_000).alias(f"{quantile_name(x)}_latency_ms")
                   for x in lt.QUANTILES]))


def processed_file_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Processed-message records (id, timestamp, processing_time,
    processed_by, partition) as a file stream."""
    schema = sc.T.StructType(sc.PROCESSED.fields + [sc.T.StructField("partition", sc.T.IntegerType())])
    r = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def enriched_file_source(spark: SparkSession, path: str) -> DataFrame:
    """Enriched comments written by the enrichment stream, as a stream."""
    schema = sc.T.StructType([
        sc.T.StructField("partition", sc.T.IntegerType()), sc.T.StructField("offset", sc.T.LongType()),
        sc.T.StructField("row_index", sc.T.LongType()), sc.T.StructField("comment_id", sc.T.StringType()),
        sc.T.StructField("text", sc.T.StringType()), sc.T.StructField("created_utc", sc.T.DoubleType()),
        sc.T.StructField("id", sc.T.StringType()),
        sc.T.StructField("fields", sc.T.MapType(sc.T.StringType(), sc.T.StringType())),
        sc.T.StructField("language", sc.T.StringType()), sc.T.StructField("compound", sc.T.DoubleType()),
        sc.T.StructField("sentiment", sc.T.StringType()),
        sc.T.StructField("keywords", sc.T.ArrayType(sc.T.StringType()))])
    return spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(path)
