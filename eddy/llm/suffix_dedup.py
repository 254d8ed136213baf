"""Suffix-array dedup: remove later copies of repeated byte strings.

A byte goes if it is covered by a string of ``LENGTH`` bytes that also starts
earlier (smaller id, or earlier in the same document).  Matches don't cross
documents.

How the work is split.  Each window of ``LENGTH`` bytes belongs to an *anchor*:
of the 16-byte strings in it, the leftmost with the smallest hash.  Equal
windows have equal anchors at the same offset, so they meet under one key, and
consecutive windows mostly share an anchor, so a document has few of them.
Anchors that occur once are done with; for the others the windows' bytes are
sent to the key.  There a suffix array over the window starts is built (rank
doubling, to the depth of a window) with the common prefixes of neighbours.  For
every start, the previous and the next start in suffix order that are earlier in
the corpus are found; the longer of the common prefixes with these two is its
longest previous factor, and windows whose factor reaches ``LENGTH`` go.

An anchor that very many windows hold would be one group in one task.  Windows
of such anchors get a second, longer content-chosen string as part of their key:
equal windows still meet, others around the same anchor go elsewhere.

Whole copies of a text need none of this: all but the first id go at once.  And
runs of windows that a task has sent before, byte for byte, are not sent again,
so a passage that very many documents share costs a few rows a task.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eddy.llm.common import bounded, byte_texts, in_table, key_table, mix, slices, small_batches, written

LENGTH = 100
GRAM = 16
LONG_GRAM = 64    # of the second string
HOT = 2000        # occurrences beyond which an anchor's windows are dealt by a second string
LAST = 2**63 - 1  # stands for a null id: after all others
TILE = 1 << 18    # bytes of contexts in one suffix array, but for a larger group
_BYTE = mix(np.arange(1, 257, dtype=np.uint64))


def _gram_hash(buf: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes (a power of two) from each position."""
    h, m = _BYTE[buf], 1
    while m < gram:
        h = h[:-m] * np.uint64(pow(0x9E3779B97F4A7C15, m, 1 << 64)) + h[m:]
        m *= 2
    return mix(h)


def anchors(texts: list[bytes], length: int = LENGTH, gram: int = GRAM):
    """(text number, first window, last window, anchor hash) of every run of
    windows with one anchor of ``gram`` bytes, window starts counted in their
    text."""
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    buf = np.frombuffer(b"".join(texts), dtype=np.uint8)
    empty = np.empty(0, dtype=np.int64)
    if len(buf) < length:
        return empty, empty, empty, empty
    val = _gram_hash(buf, gram)
    low, at, span, wide = val, np.arange(len(val)), 1, length - gram + 1
    while span < wide:
        step = min(span, wide - span)
        right = low[step:] < low[:-step]
        at = np.where(right, at[step:], at[:-step])
        low = np.where(right, low[step:], low[:-step])
        span += step
    begin = np.cumsum(sizes) - sizes
    doc = np.repeat(np.arange(len(texts)), sizes)[:len(at)]
    ok = np.flatnonzero(np.arange(len(at)) + length <= (begin + sizes)[doc])
    if not len(ok):
        return empty, empty, empty, empty
    doc, at = doc[ok], at[ok]
    new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])]))
    last = np.concatenate([new[1:] - 1, [len(ok) - 1]])
    d = doc[new]
    return d, ok[new] - begin[d], ok[last] - begin[d], val[at[new]].view(np.int64)


def _ranks(buf: np.ndarray, length: int) -> dict[int, np.ndarray]:
    """For widths 8, 16, 32, ... up to ``length``: rank of the bytes from each
    position among all strings of that width.  8 holds the bytes themselves."""
    word = np.zeros(len(buf) - 7, dtype=np.uint64)
    for i in range(8):
        word = (word << np.uint64(8)) | buf[i:len(buf) - 7 + i]
    out, width = {8: word}, 8
    rank = np.unique(word, return_inverse=True)[1].astype(np.int64)
    while 2 * width <= length:
        rank = np.unique((rank[:-width] << 32) | rank[width:], return_inverse=True)[1].astype(np.int64)
        width *= 2
        out[width] = rank
    return out


def _common(ranks: dict[int, np.ndarray], p: np.ndarray, q: np.ndarray, length: int) -> np.ndarray:
    """Length of the common prefix of the strings at p and q, ``length`` at most."""
    got = np.zeros(len(p), dtype=np.int64)
    for width in sorted(ranks, reverse=True):
        at = np.flatnonzero(got + width <= length)
        same = ranks[width][p[at] + got[at]] == ranks[width][q[at] + got[at]]
        got[at[same]] += width
    # Fewer than 8 bytes further they differ or end.
    word, last = ranks[8], len(ranks[8]) - 1
    back = np.maximum(0, np.maximum(p, q) + got - last)     # read the last word there is, shifted
    x = (word[p + got - back] << (back * 8).astype(np.uint64)) ^ (word[q + got - back] << (back * 8).astype(np.uint64))
    zeros = np.zeros(len(p), dtype=np.int64)
    for bits in (32, 16, 8):
        clear = (x >> np.uint64(64 - bits)) == 0
        zeros += np.where(clear, bits // 8, 0)
        x = np.where(clear, x << np.uint64(bits), x)
    return np.minimum(length, got + np.minimum(zeros, 8 - back))


def _smaller_before(place: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each i the nearest j < i with a smaller place (-1 if none), and the
    least ``lcp`` on the way (lcp[i] is that of i-1 and i), 0 if none."""
    at, low = np.arange(-1, len(place) - 1), lcp.copy()
    todo = np.flatnonzero(low > 0)      # without a common prefix there is nothing to find
    while len(todo):
        # Everything between at[i] and i is no smaller than i; so is at[i], here.
        todo = todo[place[at[todo]] >= place[todo]]
        via = at[todo]
        low[todo], at[todo] = np.minimum(low[todo], low[via]), at[via]
        todo = todo[(at[todo] >= 0) & (low[todo] > 0)]
    low[at < 0] = 0
    return at, low


def previous_factors(contexts: list[bytes], doc: np.ndarray, start: np.ndarray, length: int = LENGTH,
                     least: int = 0) -> list[np.ndarray]:
    """Longest previous factor of every window start of every context, capped at
    ``length``: the longest string there that also starts at a smaller (doc,
    start).  Context i starts at byte ``start[i]`` of document ``doc[i]``.  Factors
    shorter than ``least`` may be given as 0: starts whose first or last bytes stand
    nowhere else are then left out of the suffix array."""
    sizes = np.fromiter(map(len, contexts), dtype=np.int64, count=len(contexts))
    ranks = _ranks(np.frombuffer(b"".join(contexts), dtype=np.uint8), length)
    width = max(ranks)
    number = sizes - length + 1
    of = np.repeat(np.arange(len(contexts)), number)
    off = np.arange(len(of)) - np.repeat(np.cumsum(number) - number, number)
    at = (np.cumsum(sizes) - sizes)[of] + off
    rank = ranks[width].astype(np.int64) if width > 8 else np.unique(ranks[8], return_inverse=True)[1].astype(np.int64)
    head, tail = rank[at], rank[at + length - width]
    if least >= length:
        some = np.flatnonzero((np.bincount(head)[head] > 1) & (np.bincount(tail)[tail] > 1))
    else:
        some = np.arange(len(at))
    order = some[np.argsort((head[some] << 32) | tail[some], kind="stable")]     # the suffix array
    # Position of each window in the order of (doc, start); equal ones are equal.
    place = (np.unique(doc, return_inverse=True)[1].astype(np.int64)[of] << 32) | (start[of] + off)
    place = place[order]
    sa = at[order]
    if least >= length:     # the common prefixes that matter, the others as 0
        near = np.where((head[order][1:] == head[order][:-1]) & (tail[order][1:] == tail[order][:-1]), length, 0)
    else:
        near = _common(ranks, sa[:-1], sa[1:], length)
    lcp = np.concatenate([[0], near])[:len(sa)]
    before = _smaller_before(place, lcp)[1]
    after = _smaller_before(place[::-1], np.concatenate([[0], lcp[:0:-1]]))[1][::-1]
    lpf = np.zeros(len(of), dtype=np.int64)
    lpf[order] = np.maximum(before, after)
    return np.split(lpf, np.cumsum(number)[:-1])


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def merged(spans) -> list[tuple[int, int]]:
    """Union of (start, end) spans as maximal runs."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def _prepared(docs: DataFrame, id_col: str, text_col: str, *others) -> DataFrame:
    """ord (id, null last), text, dkey (a hash; with ord it names the document), low
    (smallest ord that has the text, where more than one has), and ``others``.
    All columns are the operator's own, whatever those of ``docs`` are called."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    frame = small_batches(docs).select(text.alias("_text"), F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("_ord"), *others)
    frame = frame.withColumn("_dkey", F.xxhash64("_ord", "_text")).withColumn("_md5", F.unhex(F.md5(F.col("_text").cast("binary"))))
    same = frame.groupBy("_md5").agg(F.min("_ord").alias("_low"), F.max("_ord").alias("_high")).where("_low <> _high")
    return frame.join(bounded(written(same.select("_md5", "_low"), "suffix-copies")), "_md5", "left")


def _spans(prepared: DataFrame, length: int) -> DataFrame:
    """(_dkey, _ord, _spans): removed spans of the texts' first copies."""
    first = prepared.where("_low is null or _low = _ord").select("_dkey", "_ord", "_text")
    spark = prepared.sparkSession

    def find(batches):
        for batch in batches:
            for part in slices(batch, "_text", TILE):
                d, lo, hi, key = anchors(byte_texts(part, "_text"), length)
                of = pa.array(d)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), part.column("_dkey").take(of), part.column("_ord").take(of), pa.array(lo.astype(np.int32)),
                     pa.array(hi.astype(np.int32))], names=["key", "dkey", "ord", "lo", "hi"])

    found = written(first.mapInArrow(find, "key long, dkey long, ord long, lo int, hi int"), "suffix-anchors")
    shared = written(found.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
                     .select("key", (F.col("c") > HOT).alias("hot")), "suffix-shared")
    table = spark.sparkContext.broadcast(key_table(shared, "key"))

    def sift(batches):
        for batch in batches:
            yield batch.filter(pa.array(in_table(table.value, batch.column(0).to_numpy())))

    kept = found.mapInArrow(sift, found.schema).join(shared, "key")
    lists = written(kept.groupBy("dkey", "ord").agg(F.collect_list(F.struct("lo", "hi", "key", "hot")).alias("at")), "suffix-lists")
    lists = lists.withColumnsRenamed({"dkey": "_dkey", "ord": "_ord"})
    owners = first.join(bounded(lists.select("_dkey", "_ord")), ["_dkey", "_ord"], "left_semi")
    work = owners.join(lists, ["_dkey", "_ord"]).sortWithinPartitions("_ord")

    def contexts(batches):
        names = ["key", "dkey", "ord", "lo", "n", "bytes"]
        long = max(GRAM, min(LONG_GRAM, 1 << ((3 * length // 4).bit_length() - 1)))
        sent: dict[bytes, tuple[int, int]] = {}
        for batch in batches:
            for part in slices(batch, "_text", TILE):
                rows, hot = [], []
                for t, k, o, at in zip(byte_texts(part, "_text"), part.column("_dkey").to_pylist(), part.column("_ord").to_pylist(),
                                       part.column("at").to_pylist()):
                    for x in at:
                        lo, hi = x["lo"], x["hi"]
                        c = t[lo:hi + length]
                        if sent.get(c, (LAST + 1, 0)) < (o, lo):  # a repeat of what this task has sent
                            rows.append((k, k, o, lo, hi - lo + 1, None))
                        else:
                            sent[c] = (o, lo)
                            (hot if x["hot"] else rows).append((x["key"], k, o, lo, hi - lo + 1, c))
                if hot:
                    number, lo, hi, second = anchors([r[5] for r in hot], length, long)
                    for i, a, b, s in zip(number.tolist(), lo.tolist(), hi.tolist(), second.tolist()):
                        key, k, o, at, _, c = hot[i]
                        rows.append((key ^ s, k, o, at + a, b - a + 1, c[a:b + length]))
                if len(sent) > 100_000:
                    sent.clear()
                if rows:
                    cols = list(zip(*rows))
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols[:5]] + [pa.array(cols[5], pa.binary())],
                                                     names=names)

    sent = work.mapInArrow(contexts, "key long, dkey long, ord long, lo long, n long, bytes binary")
    dealt = sent.repartition("key").sortWithinPartitions("key")

    def solve(rows):
        """Spans of a list of contexts, whole keys together."""
        out, best, keys = [], {}, {}
        for r in rows:
            x = (r[0], r[5])
            if x not in best or (r[2], r[3]) < best[x]:
                best[x] = (r[2], r[3])
        for k, _ in best:
            keys[k] = keys.get(k, 0) + 1
        left = []
        for r in rows:
            if best[r[0], r[5]] < (r[2], r[3]):
                out.append((r[1], r[2], r[3], r[3] + r[4] - 1 + length))
            elif keys[r[0]] > 1:
                left.append(r)
        if left:
            factors = previous_factors([r[5] for r in left], np.array([r[2] for r in left]), np.array([r[3] for r in left]), length, length)
            for r, f in zip(left, factors):
                out += [(r[1], r[2], r[3] + a, r[3] + b - 1 + length) for a, b in _runs(f >= length)]
        return out

    def cover(batches):
        def batch_of(out):
            cols = zip(*out) if out else ((),) * 4
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["dkey", "ord", "s", "e"])

        held, size = [], 0
        for batch in batches:
            out = []
            for r in zip(*(c.to_pylist() for c in batch.columns)):
                if r[5] is None:
                    out.append((r[1], r[2], r[3], r[3] + r[4] - 1 + length))
                    continue
                if size > TILE and r[0] != held[-1][0]:
                    out += solve(held)
                    held, size = [], 0
                held.append(r)
                size += len(r[5])
            yield batch_of(out)
        yield batch_of(solve(held))

    return merged_lists(dealt.mapInArrow(cover, "dkey long, ord long, s long, e long"), "suffix-spans")


def merged_lists(spans: DataFrame, name: str, least: int = 1) -> DataFrame:
    """``spans(dkey, ord, s, e)`` to (_dkey, _ord, _spans): maximal runs of at
    least ``least`` bytes as one list of starts and ends in turn."""
    def run(batches):
        for batch in batches:
            out = []
            for x in batch.column("at").to_pylist():
                out.append([v for s, e in merged((y["s"], y["e"]) for y in x) if e - s >= least for v in (s, e)])
            yield pa.RecordBatch.from_arrays([batch.column("_dkey"), batch.column("_ord"), pa.array(out, pa.list_(pa.int32()))],
                                             names=["_dkey", "_ord", "_spans"])

    lists = spans.groupBy(F.col("dkey").alias("_dkey"), F.col("ord").alias("_ord")).agg(F.collect_list(F.struct("s", "e")).alias("at"))
    return written(lists.mapInArrow(run, "_dkey long, _ord long, _spans array<int>").where("size(_spans) > 0"), name)


def _marked(docs: DataFrame, id_col: str, text_col: str, length: int, *others) -> DataFrame:
    prepared = _prepared(docs, id_col, text_col, *others)
    spans = _spans(prepared.drop("_row", "_doc_id"), length)
    return prepared.join(bounded(spans, "_spans"), ["_dkey", "_ord"], "left").withColumn(
        "_later", F.coalesce(F.col("_ord") > F.col("_low"), F.lit(False)))


def _row_spans(text: bytes, later: bool, spans, length: int) -> list[tuple[int, int]]:
    if later:
        return [(0, len(text))] if len(text) >= length else []
    return list(zip(spans[::2], spans[1::2])) if spans else []


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row.

    Null text counts as empty.  Rows with equal ids count as one document's
    position order: equal starts in them are not earlier than each other.  A
    null id comes after all ids.  Ids are whole numbers, or strings of such.  An
    empty table gives no rows.
    """
    rows = _marked(docs, id_col, text_col, length, F.col(id_col).alias("_doc_id")).select(
        F.col("_doc_id").alias("doc_id"), "_text", "_later", F.when(~F.col("_later"), F.col("_spans")).alias("_spans"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            out = []
            for t, later, s in zip(byte_texts(batch, "_text"), batch.column("_later").to_pylist(), batch.column("_spans").to_pylist()):
                runs = _row_spans(t, later, s, length)
                out.append((len(t), sum(b - a for a, b in runs), len(runs), hashlib.sha256(_cut(t, runs)).hexdigest()))
            cols = zip(*out) if out else ((),) * 4
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(
                cols, (pa.int64(), pa.int64(), pa.int64(), pa.string())))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def _cut(text: bytes, runs) -> bytes:
    parts, at = [], 0
    for a, b in runs:
        parts.append(text[at:a])
        at = b
    return b"".join([*parts, text[at:]])


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` with the repeated bytes taken out of their texts (a character
    cut in part is dropped whole); all other columns and rows stay, whatever
    their names.  Null texts stay null; an empty table gives no rows."""
    columns, schema = docs.columns, docs.schema
    rows = _marked(docs, id_col, text_col, length, F.struct("*").alias("_row"))
    rows = rows.select("_row", "_later", F.when(~F.col("_later"), F.col("_spans")).alias("_spans"))

    def run(batches):
        for batch in batches:
            fields = batch.column("_row").flatten()
            texts = fields[columns.index(text_col)]
            out = []
            for t, later, s in zip(texts.cast(pa.binary()).to_pylist(), batch.column("_later").to_pylist(),
                                   batch.column("_spans").to_pylist()):
                out.append(None if t is None else _cut(t, _row_spans(t, later, s, length)).decode(errors="ignore"))
            fields[columns.index(text_col)] = pa.array(out, texts.type)
            yield pa.RecordBatch.from_arrays(fields, names=columns)

    return rows.mapInArrow(run, schema)
