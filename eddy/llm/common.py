"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eddy.session import scratch_path

# ASCII A-Z to a-z, every other byte unchanged.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
# As LOWER, and every ASCII byte that is neither a digit nor a letter becomes a
# space; bytes of non-ASCII characters stay.
ALNUM = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in LOWER)


TABLE_BITS = 25           # bits (log2) of a broadcast filter: 4 MB whatever the input
BATCH_BYTES = 2 << 20     # bytes of rows that a Python task gets at a time
BROADCAST_ROWS = 400_000       # rows of a few longs that may be broadcast; beyond, a plain join
BROADCAST_ENTRIES = 4_000_000  # 32-bit entries of their lists, or four bytes of their strings, that may go with them


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble unsigned 64-bit integers (a bijection)."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _spot(keys: np.ndarray) -> np.ndarray:
    return (mix(keys.view(np.uint64)) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def key_table(keys: DataFrame, column: str) -> np.ndarray:
    """Bits set at the hashes of a column of longs: a filter of fixed size that
    lets every one of them through, and few others while it is sparse.  It only
    ever saves work: an exact join follows wherever it is used.

    Every task sets bits of its own; the words they touch are joined by an
    aggregation, so the driver gets each word once, whatever the tasks."""
    def run(batches):
        bits = np.zeros(1 << TABLE_BITS, dtype=bool)
        for batch in batches:
            bits[_spot(batch.column(0).to_numpy())] = True
        words = np.packbits(bits).view(np.int64)
        at = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(words[at])], names=["at", "word"])

    out = np.zeros(1 << (TABLE_BITS - 6), dtype=np.int64)
    found = keys.select(column).mapInArrow(run, "at long, word long").groupBy("at").agg(F.bit_or("word").alias("word")).toArrow()
    out[found["at"].to_numpy()] = found["word"].to_numpy()
    return out.view(np.uint8)


def in_table(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = _spot(keys)
    return (table[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0


def bounded(frame: DataFrame, list_col: str | None = None) -> DataFrame:
    """Broadcast a small table (by its rows, by the entries of its one list
    column and the bytes of its strings); leave a larger one to a plain join."""
    size = F.size(list_col) if list_col else F.lit(0)
    for name, kind in frame.dtypes:
        if kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(name), F.lit(0)) / 4
    entries = F.sum(size)
    n = frame.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(entries, F.lit(0)).alias("entries")).first()
    return F.broadcast(frame) if n.rows <= BROADCAST_ROWS and n.entries <= BROADCAST_ENTRIES else frame


def small_batches(frame: DataFrame) -> DataFrame:
    """Bound the Arrow batches of the session by ``BATCH_BYTES`` (Spark's own
    bound is 64 MB, and a task holds several copies of a batch: one or two in
    the JVM, the bytes and the result in Python).  A lower setting stays."""
    conf, name = frame.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    now = conf.get(name).removesuffix("b")
    if not now.isdigit() or not 0 < int(now) <= BATCH_BYTES:
        conf.set(name, str(BATCH_BYTES))
    return frame


def byte_texts(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """The UTF-8 bytes of a string column; null becomes empty."""
    return [t or b"" for t in batch.column(name).cast(pa.binary()).to_pylist()]


def slices(batch: pa.RecordBatch, name: str, most_bytes: int):
    """Cut a batch into row slices of about ``most_bytes`` of text each (a
    single longer text is a slice of its own)."""
    col = batch.column(name)
    sizes = pc.binary_length(col.cast(pa.binary())).fill_null(0).to_pylist()
    start = held = 0
    for i, n in enumerate(sizes):
        if held and held + n > most_bytes:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield batch.slice(start)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: it cuts lineage, survives lost executors and is computed once."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _fingerprint(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges: their number, sums, and two 64-bit hashes."""
    h = [F.xxhash64("u", "v"), F.xxhash64("v", F.lit(1), "u")]
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.col("u").cast("decimal(38,0)")), F.sum(F.col("v").cast("decimal(38,0)")),
                           *[F.bit_xor(x) for x in h]).first())


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a long, b long)``: (node, root), one row
    for each node that has an edge, root being the smallest node reachable.

    Alternating large-star and small-star steps.  Every step is a group-by with
    a map-side minimum and a join whose skewed side adaptive execution can
    split; each round is written to the shared folder.  Rounds grow with the
    logarithm of the longest path.  Null ids and self loops are ignored.
    """
    e = (edges.where("a is not null and b is not null and a <> b")
         .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    e = written(e, "edges")
    seen = _fingerprint(e)
    while True:
        # Large star: every neighbour above a node hangs on the node's minimum.
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        large = written(large, "star")
        # Small star: a node and its smaller neighbours hang on their minimum.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = (joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        new = written(small, "star")
        now = _fingerprint(new)
        if now == seen:
            break
        e, seen = new, now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
