"""Registered queries: one per operator of the inventory.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
supplied tables (or data Spark derives from them).  Column names match the
DuckDB statements in ``eddy.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eddy.operators import keywords as kw
from eddy.operators import report as rp
from eddy.sources import tables as tb

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    """Register a query.  Times are defined in UTC, so the wrapper pins the
    session zone before the plan is built (a caller's session may differ)."""
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
                spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


# ------------------------------- keywords -------------------------------------

def _valid_docs(spark, sf_dir):
    return tb.documents(spark, sf_dir).where(F.col("text").isNotNull() & (F.length("text") > 0))


@register("tokens")
def q_tokens(spark, sf_dir):
    return kw.token_rows(_valid_docs(spark, sf_dir))


@register("stopword_filter")
def q_stopword_filter(spark, sf_dir):
    return kw.filter_stopwords(kw.token_rows(_valid_docs(spark, sf_dir)))


@register("term_freq")
def q_term_freq(spark, sf_dir):
    return kw.term_frequencies(_valid_docs(spark, sf_dir))


@register("keywords_top3")
def q_keywords_top3(spark, sf_dir):
    return kw.top_k_terms(kw.term_frequencies(_valid_docs(spark, sf_dir)), 3)


@register("keywords_top5")
def q_keywords_top5(spark, sf_dir):
    return kw.top_k_terms(kw.term_frequencies(_valid_docs(spark, sf_dir)), 5)


@register("keyword_arrays")
def q_keyword_arrays(spark, sf_dir):
    return kw.extract_keywords(tb.documents(spark, sf_dir))


@register("has_keywords")
def q_has_keywords(spark, sf_dir):
    """P5: comments that keep at least one keyword (the others are dropped)."""
    k = kw.extract_keywords(tb.documents(spark, sf_dir))
    return k.where(F.size("keywords") > 0).select("doc_id", F.size("keywords").alias("n_keywords"))


@register("keyword_counts")
def q_keyword_counts(spark, sf_dir):
    return rp.keyword_counts(kw.extract_keywords(tb.documents(spark, sf_dir)))


@register("top10_keywords")
def q_top10_keywords(spark, sf_dir):
    return rp.top_keywords(kw.extract_keywords(tb.documents(spark, sf_dir)))


@register("keyword_ranking")
def q_keyword_ranking(spark, sf_dir):
    return rp.rank_counts(rp.keyword_counts(kw.extract_keywords(tb.documents(spark, sf_dir))), "keyword")


# --------------------------- ingest, codecs, topics ---------------------------

from eddy import schema as sc  # noqa: E402
from eddy.functions.fields import with_default  # noqa: E402
from eddy.operators import validate as va  # noqa: E402
from eddy.session import scratch_path  # noqa: E402
from eddy.sources import files as fs  # noqa: E402
from eddy.sources import json_codec as jc  # noqa: E402
from eddy.sources import topic as tp  # noqa: E402

COMMENT_PARTITIONS = 5     # topic partitions of the comment stream
COMMENT_PRODUCERS = 2      # stride shards of the producer
COMMENT_CONSUMERS = 2      # consumers reading the comment topic
WIRE = {"row_index": sc.KEY_INDEX, "text": sc.KEY_TEXT, "comment_id": sc.KEY_COMMENT_ID}


def _comment_messages(spark, sf_dir):
    c = tb.comments(spark, sf_dir)
    return tp.produce(jc.encode(c, WIRE), COMMENT_PARTITIONS)


@register("scan_comments")
def q_scan_comments(spark, sf_dir):
    path = scratch_path(spark, "comments-csv")
    c = tb.comments_with_time(spark, sf_dir).withColumn("note", F.concat(F.lit("n,"), "comment_id"))
    fs.write_comments_csv(c.select("note", "created_utc", "comment_id", "text", "row_index"), path)
    return tb.spread(fs.read_comments_csv(spark, path))


@register("stride_shard")
def q_stride_shard(spark, sf_dir):
    c = tb.comments(spark, sf_dir)
    return c.select("row_index", tp.stride_shard_id(F.col("row_index"), COMMENT_PRODUCERS).alias("producer_id"))


@register("json_encode")
def q_json_encode(spark, sf_dir):
    return jc.encode(tb.comments(spark, sf_dir), WIRE).select("row_index", "value")


@register("json_decode")
def q_json_decode(spark, sf_dir):
    e = tb.events(spark, sf_dir).select("event_id", F.col("props").alias("value"))
    return jc.decode(e, sc.T.StructType([sc.T.StructField("k", sc.T.LongType())]), keep_value=False).drop("_json_ok")


@register("json_decode_double")
def q_json_decode_double(spark, sf_dir):
    e = tb.events(spark, sf_dir).select("event_id", "props")
    doubled = F.regexp_extract(F.to_json(F.array("props")), r"^\[(.*)\]$", 1)
    both = (e.select("event_id", F.lit("plain").alias("form"), F.col("props").alias("value"))
            .unionByName(e.select("event_id", F.lit("double").alias("form"), doubled.alias("value"))))
    return jc.decode(both, sc.T.StructType([sc.T.StructField("k", sc.T.LongType())]), keep_value=False).drop("_json_ok")


@register("message_key")
def q_message_key(spark, sf_dir):
    return _comment_messages(spark, sf_dir).select("row_index", "key")


@register("partition_assign")
def q_partition_assign(spark, sf_dir):
    return _comment_messages(spark, sf_dir).select("row_index", "key", "partition")


@register("partition_counts")
def q_partition_counts(spark, sf_dir):
    return tp.partition_counts(_comment_messages(spark, sf_dir))


@register("consumer_assign")
def q_consumer_assign(spark, sf_dir):
    return tp.consumer_assignment(_comment_messages(spark, sf_dir), COMMENT_PARTITIONS, COMMENT_CONSUMERS)


@register("end_offsets")
def q_end_offsets(spark, sf_dir):
    return tp.end_offsets(tb.processed_records(spark, sf_dir))


# ------------------------------- validation ----------------------------------

@register("field_default")
def q_field_default(spark, sf_dir):
    """Decode comment messages; absent ``id`` -> 'unknown', absent text -> ''."""
    m = jc.decode(_comment_messages(spark, sf_dir).select("value"), sc.COMMENT_MESSAGE)
    return m.select(F.col(sc.KEY_INDEX).alias("row_index"),
                    with_default(F.col(sc.KEY_ID), "unknown").alias("id"),
                    F.length(with_default(F.col(sc.KEY_TEXT), "")).alias("text_length"))


def _faulty_messages(spark, sf_dir):
    """Messages whose value is an empty object (id mod 5 = 0) or empty (1)."""
    k = F.pmod("row_index", F.lit(5))
    return _comment_messages(spark, sf_dir).withColumn(
        "value", F.when(k == 0, "{}").when(k == 1, "").otherwise(F.col("value")))


def _faulty_processed(spark, sf_dir):
    """Processed records without a processing time where the id mod 13 is 0."""
    return tb.processed_records(spark, sf_dir).withColumn(
        "processing_time", F.when(F.pmod(F.col("id").cast("long"), F.lit(13)) != 0, F.col("processing_time")))


@register("valid_text")
def q_valid_text(spark, sf_dir):
    good, _ = va.split_valid(tb.faulty_texts(spark, sf_dir), [("text not a string", va.text_missing(F.col("text")))], "sentiment")
    return good.select("row_index")


@register("nonempty_text")
def q_nonempty_text(spark, sf_dir):
    c = tb.faulty_texts(spark, sf_dir)
    good, _ = va.split_valid(c, [("no text", va.text_missing(F.col("text")) | va.text_empty(F.col("text")))], "keywords")
    return good.select("row_index")


@register("nonempty_message")
def q_nonempty_message(spark, sf_dir):
    m = _faulty_messages(spark, sf_dir)
    good, _ = va.split_valid(m, [("empty message", va.message_empty(F.col("value")))], "consume")
    return good.select("row_index")


@register("valid_time")
def q_valid_time(spark, sf_dir):
    c = tb.faulty_times(spark, sf_dir)
    good, _ = va.split_valid(c, [("missing time", va.time_invalid(F.col("created_utc")))], "convert")
    return good.select("row_index", "created_utc")


@register("latency_inputs")
def q_latency_inputs(spark, sf_dir):
    p = _faulty_processed(spark, sf_dir)
    good, _ = va.split_valid(p, [("missing time", va.times_missing(F.col("timestamp"), F.col("processing_time")))], "latency")
    return good.select("id")


def _all_checks(spark, sf_dir):
    c, t = tb.faulty_texts(spark, sf_dir), tb.faulty_times(spark, sf_dir)
    m, p = _faulty_messages(spark, sf_dir), _faulty_processed(spark, sf_dir)
    return [
        (c, [("text not a string", va.text_missing(F.col("text"))),
             ("empty text", va.text_empty(F.col("text")))], "text"),
        (t, [("missing time", va.time_invalid(F.col("created_utc")))], "convert"),
        (m, [("empty message", va.message_empty(F.col("value")))], "consume"),
        (p, [("missing time", va.times_missing(F.col("timestamp"), F.col("processing_time")))], "latency"),
    ]


@register("rejects")
def q_rejects(spark, sf_dir):
    """Every rejected row of every stage with its reason."""
    out = None
    for df, checks, stage in _all_checks(spark, sf_dir):
        _, bad = va.split_valid(df, checks, stage)
        out = bad if out is None else out.unionByName(bad)
    key = F.coalesce(F.get_json_object("row", "$.row_index"), F.get_json_object("row", "$.id"))
    return out.select(key.alias("row_key"), "stage", "reason")


@register("validation_summary")
def q_validation_summary(spark, sf_dir):
    out = None
    for df, checks, stage in _all_checks(spark, sf_dir):
        s = va.validation_summary(df, checks, stage)
        out = s if out is None else out.unionByName(s)
    return out


# ------------------------------ time, latency ---------------------------------

from eddy.functions import time as tm  # noqa: E402
from eddy.operators import latency as lt  # noqa: E402


def _r6(df):
    """Round double columns to 6 places (sums and interpolations differ in
    the last bits between engines)."""
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@register("processed_records")
def q_processed_records(spark, sf_dir):
    return tb.processed_records(spark, sf_dir).select("id", "timestamp", "processing_time", "processed_by")


@register("epoch_to_iso")
def q_epoch_to_iso(spark, sf_dir):
    c = tb.events(spark, sf_dir).select(F.col("event_id").alias("row_index"), tb.epoch_seconds("ts").alias("created_utc"))
    return c.select("row_index", "created_utc", tm.epoch_to_iso(F.col("created_utc")).alias("iso_datetime"))


@register("epoch_to_ts")
def q_epoch_to_ts(spark, sf_dir):
    p = tb.processed_records(spark, sf_dir)
    return p.select("id", tm.epoch_to_local(F.col("timestamp")).alias("original_time"))


@register("latency_rows")
def q_latency_rows(spark, sf_dir):
    return lt.latency_rows(tb.processed_records(spark, sf_dir))


@register("latency_report")
def q_latency_report(spark, sf_dir):
    return _r6(lt.latency_report(lt.latency_rows(tb.processed_records(spark, sf_dir))))


@register("latency_percentiles")
def q_latency_percentiles(spark, sf_dir):
    rows = lt.latency_rows(tb.processed_records(spark, sf_dir))
    r = lt.latency_report(rows)
    return _r6(r.select("p95_latency_ms", "p99_latency_ms"))


@register("consumer_stats")
def q_consumer_stats(spark, sf_dir):
    return _r6(lt.consumer_stats(lt.latency_rows(tb.processed_records(spark, sf_dir))))


@register("latency_report_tumbling")
def q_latency_report_tumbling(spark, sf_dir):
    return _r6(lt.tumbling_report(lt.latency_rows(tb.processed_records(spark, sf_dir))))


# --------------------------- sentiment, language ------------------------------

from eddy.operators import language as lg  # noqa: E402
from eddy.operators import sentiment as se  # noqa: E402
from eddy.plans import enrich as en  # noqa: E402


def _profile(spark, sf_dir):
    """Trigram profile of the labelled documents, fitted once and then loaded."""
    return lg.saved_profile(spark, tb.table_path(sf_dir, "documents"))


@register("sentiment_score")
def q_sentiment_score(spark, sf_dir):
    return se.sentiment_scores(tb.documents(spark, sf_dir))


@register("sentiment_label")
def q_sentiment_label(spark, sf_dir):
    return se.analyze_sentiment(tb.documents(spark, sf_dir)).select("doc_id", "sentiment")


@register("language_profile")
def q_language_profile(spark, sf_dir):
    return lg.train_profile(tb.documents(spark, sf_dir, ("text", "lang"))).table


@register("language_posterior")
def q_language_posterior(spark, sf_dir):
    """1- to 3-grams, all candidate languages of every document."""
    profile = lg.saved_profile(spark, tb.table_path(sf_dir, "documents"), sizes=(1, 2, 3))
    return lg.posterior(tb.documents(spark, sf_dir), profile)


@register("detect_language")
def q_detect_language(spark, sf_dir):
    return lg.detect_language(tb.documents(spark, sf_dir), _profile(spark, sf_dir))


@register("lang_unknown")
def q_lang_unknown(spark, sf_dir):
    """P2 on a second text source: conversation turns, blank -> 'unknown'."""
    conv = tb.spread(tb.read_table(spark, sf_dir, "conversations")
                     .select(F.concat_ws(":", "conv_id", "turn").alias("turn_id"),
                             F.when(F.pmod("conv_id", F.lit(5)) == 0, None).when(F.pmod("conv_id", F.lit(5)) == 1, " \n")
                             .otherwise(F.col("text")).alias("text")))
    return lg.detect_language(conv, _profile(spark, sf_dir), "turn_id")


@register("enriched")
def q_enriched(spark, sf_dir):
    docs = tb.documents(spark, sf_dir, ("doc_id", "text", "source"))
    e = en.enrich(docs, _profile(spark, sf_dir), keep=("text", "source"))
    return e.select("doc_id", "text", "source", "language", "compound", "sentiment", "keywords")


def _reportable(spark, sf_dir):
    return en.reportable_enriched(tb.documents(spark, sf_dir), _profile(spark, sf_dir))


@register("language_counts")
def q_language_counts(spark, sf_dir):
    return rp.language_counts(_reportable(spark, sf_dir))


@register("sentiment_counts")
def q_sentiment_counts(spark, sf_dir):
    return rp.sentiment_counts(_reportable(spark, sf_dir))


@register("report")
def q_report(spark, sf_dir):
    return rp.report_long(_reportable(spark, sf_dir))


@register("report_json")
def q_report_json(spark, sf_dir):
    return rp.report_json(rp.report_long(_reportable(spark, sf_dir)))


# ------------------------------- sentences ------------------------------------

from eddy.operators import sentences as sn  # noqa: E402


@register("pair_tokens")
def q_pair_tokens(spark, sf_dir):
    """T2 on texts that hold words of two tokens."""
    return kw.token_rows(tb.spoken_texts(spark, sf_dir).where(F.length("text") > 0))


@register("abbreviation_model")
def q_abbreviation_model(spark, sf_dir):
    return sn.fit(tb.spoken_texts(spark, sf_dir)).types


@register("collocation_model")
def q_collocation_model(spark, sf_dir):
    return sn.fit(tb.spoken_texts(spark, sf_dir)).pairs


@register("sentences")
def q_sentences(spark, sf_dir):
    docs = tb.spoken_texts(spark, sf_dir)
    return sn.sentences(docs, sn.fit(docs))


@register("sentence_tokens")
def q_sentence_tokens(spark, sf_dir):
    docs = tb.spoken_texts(spark, sf_dir)
    return sn.sentence_tokens(docs, sn.fit(docs))


@register("sentence_keywords")
def q_sentence_keywords(spark, sf_dir):
    """T2 to T6 as a whole: sentences, tokens, terms, the top 3 of each comment."""
    docs = tb.spoken_texts(spark, sf_dir)
    return kw.top_k_terms(sn.sentence_terms(docs, sn.fit(docs)), 3)


# ------------------------- arrival-driven intervals ---------------------------

from eddy.operators import arrival as ar  # noqa: E402

ARRIVAL_GAP = 3600.0     # seconds; the reference's 60 s would close a window on nearly every row of the supplied events


def _arrivals(spark, sf_dir):
    p = lt.latency_inputs(tb.processed_records(spark, sf_dir))
    return p.select("event_type", F.col("id").cast("long").alias("id"), "processing_time",
                    tm.latency_ms(F.col("timestamp"), F.col("processing_time")).alias("latency_ms"))


@register("latency_report_arrival")
def q_latency_report_arrival(spark, sf_dir):
    """By event type, windows that close on the first record an hour later."""
    return _r6(ar.arrival_report(_arrivals(spark, sf_dir), ARRIVAL_GAP, "event_type", "processing_time", "id"))


@register("latency_report_arrival_all")
def q_latency_report_arrival_all(spark, sf_dir):
    """W2 as the reference has it: one sequence of all records."""
    rows = _arrivals(spark, sf_dir).withColumn("monitor", F.lit("all"))
    return _r6(ar.arrival_report(rows, ARRIVAL_GAP, "monitor", "processing_time", "id"))


# ------------------------ ranking with ties by arrival ------------------------

from eddy.operators import arrival_ranking as rk  # noqa: E402


@register("keyword_ranking_arrival")
def q_keyword_ranking_arrival(spark, sf_dir):
    """L3: ties as the running report leaves them, comments arriving by id."""
    return rk.arrival_ranking(kw.extract_keywords(tb.documents(spark, sf_dir)))


# ----------------------------- induced lexicon --------------------------------

from eddy.operators import lexicon as lx  # noqa: E402


@register("word_edges")
def q_word_edges(spark, sf_dir):
    return lx.word_edges(tb.documents(spark, sf_dir))


@register("sentiment_seeds")
def q_sentiment_seeds(spark, sf_dir):
    return lx.labelled_seeds(tb.documents(spark, sf_dir), tb.read_table(spark, sf_dir, "labels"))


@register("lexicon_step")
def q_lexicon_step(spark, sf_dir):
    """One round of spreading valences from the labelled seeds."""
    docs = tb.documents(spark, sf_dir)
    seeds = lx.labelled_seeds(docs, tb.read_table(spark, sf_dir, "labels"))
    return lx.spread_once(lx.word_edges(docs), seeds, seeds)


@register("induced_lexicon")
def q_induced_lexicon(spark, sf_dir):
    """All rounds; iterative, so without SQL."""
    docs = tb.documents(spark, sf_dir)
    return lx.induce(docs, lx.labelled_seeds(docs, tb.read_table(spark, sf_dir, "labels")))
