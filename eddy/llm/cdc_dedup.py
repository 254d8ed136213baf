"""Substring dedup by content-defined chunks.

A gear hash rolls over the bytes of a text; a chunk ends where its top bits are
zero, so chunk borders depend on the last bytes only and survive insertions
before them.  Chunks are deduplicated by digest: the first occurrence (smallest
id, then smallest start) stays.  A short chunk may repeat by chance, so later
copies go only where consecutive ones add up to ``MIN_RUN`` bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eddy.llm.common import bounded, byte_texts, in_table, key_table, mix, slices, small_batches, written
from eddy.llm.suffix_dedup import LAST, _cut, merged_lists

MASK_BITS = 5    # a border every 32 bytes on average
LOW = 16         # no chunk is shorter, but a text's last
HIGH = 256       # longer chunks are cut
MIN_RUN = 64     # bytes of consecutive repeated chunks that are removed
REACH = 32       # bytes that the rolling hash sees
SLICE = 1 << 20
_GEAR = (mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


def chunk_ends(text: bytes, bits: int = MASK_BITS, low: int = LOW, high: int = HIGH) -> list[int]:
    """End of each chunk of one text.  The hash of 32 bits forgets a byte after
    ``REACH`` steps, so it is a sum over the last bytes and no loop is needed."""
    if not text:
        return []
    g = _GEAR[np.frombuffer(text, dtype=np.uint8)]
    h, m = g, 1
    while m < REACH:  # h(i) = sum of gear(i - k) << k: windows of 1, 2, 4, ... bytes
        more = h[:-m] << np.uint32(m)
        h = h.copy()
        h[m:] += more
        m *= 2
    ends, at = [], 0
    for e in (np.flatnonzero(h >> np.uint32(32 - bits) == 0) + 1).tolist():
        while e - at > high:
            at += high
            ends.append(at)
        if e - at >= low:
            ends.append(e)
            at = e
    while len(text) - at > high:
        at += high
        ends.append(at)
    if at < len(text):
        ends.append(len(text))
    return ends


def dedup_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` as (doc_id, text, spans): the byte spans to remove, as
    starts and ends in turn; null without any.

    Null text counts as empty, a null id comes after all others, rows with equal
    id and text count as one.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    frame = small_batches(docs).select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn(
        "ord", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))).withColumn("dkey", F.xxhash64("ord", "text"))

    def cut(batches):
        names = ["digest", "more", "ord", "dkey", "at", "end"]
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                rows = []
                for t, o, k in zip(byte_texts(part, "text"), part.column("ord").to_pylist(), part.column("dkey").to_pylist()):
                    at = 0
                    for e in chunk_ends(t):
                        d = hashlib.blake2b(t[at:e], digest_size=16).digest()
                        rows.append((*(int.from_bytes(d[i:i + 8], "little", signed=True) for i in (0, 8)), o, k, at, e))
                        at = e
                cols = zip(*rows) if rows else ((),) * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(cols, [pa.int64()] * 4 + [pa.int32()] * 2)],
                                                 names=names)

    # The digest has 128 bits, in two columns.
    chunks = written(frame.select("text", "ord", "dkey").mapInArrow(
        cut, "digest long, more long, ord long, dkey long, at int, end int"), "cdc-chunks")
    first = (chunks.groupBy("digest", "more").agg(F.min(F.struct("ord", "at")).alias("first"), F.count(F.lit(1)).alias("c"))
             .where("c > 1").select("digest", "more", F.col("first.ord").alias("o"), F.col("first.at").alias("a")))
    first = written(first, "cdc-first")
    table = spark.sparkContext.broadcast(key_table(first, "digest"))

    def sift(batches):
        for batch in batches:
            yield batch.filter(pa.array(in_table(table.value, batch.column(0).to_numpy())))

    later = (chunks.mapInArrow(sift, chunks.schema).join(first, ["digest", "more"]).where("ord > o or ord = o and at > a")
             .select("dkey", "ord", F.col("at").alias("s"), F.col("end").alias("e")))
    spans = merged_lists(later, "cdc-spans", MIN_RUN)
    return frame.join(bounded(spans, "_spans"), (F.col("dkey") == F.col("_dkey")) & (F.col("ord") == F.col("_ord")), "left").select(
        "doc_id", "text", F.col("_spans").alias("spans"))


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
    rows = dedup_spans(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            out = []
            for t, s in zip(byte_texts(batch, "text"), batch.column("spans").to_pylist()):
                s = list(zip(s[::2], s[1::2])) if s else []
                out.append((len(t), sum(b - a for a, b in s), len(s), hashlib.sha256(_cut(t, s)).hexdigest()))
            cols = zip(*out) if out else ((),) * 4
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(
                cols, (pa.int64(), pa.int64(), pa.int64(), pa.string())))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
