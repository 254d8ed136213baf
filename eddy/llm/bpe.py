"""Byte-level BPE encoding and decoding with given merge ranks.

Texts are cut into pieces by the tokenizer's pattern.  A piece that is itself a
token is one id.  The others are merged together, many at a time: pieces of
similar length form a padded matrix, and in each round every row merges its
leftmost pair of smallest rank.  Pair ranks come from an open-addressing hash
table in numpy; finished rows leave the matrix (compaction).  A round only looks
up the two pairs that a merge creates.

A matrix row of length n takes up to n rounds, so pieces over ``LONG`` bytes
would cost n squared; they are merged with a heap over a linked list, which
makes the same merges in the same order in n log n.
"""

from __future__ import annotations

import base64
import hashlib
import heapq

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from eddy.llm.common import slices, small_batches

LONG = 512
NONE = np.int32(2**31 - 1)
CACHE = 300_000


class Ranks:
    """Vocabulary, pair table and piece cache of one rank file."""

    def __init__(self, raw: bytes, pattern: str):
        self.rank = {base64.b64decode(a): int(b) for a, b in (x.split() for x in raw.splitlines() if x)}
        self.token = {i: t for t, i in self.rank.items()}
        self.find = regex.compile(pattern).findall
        self.byte = np.array([self.rank[bytes([b])] for b in range(256)], dtype=np.int32)
        pairs = {}
        for t, i in self.rank.items():
            for k in range(1, len(t)):
                a, b = self.rank.get(t[:k]), self.rank.get(t[k:])
                if a is not None and b is not None:
                    pairs[(a << 32) | b] = i
        self._build(pairs)
        self.reset()

    def _build(self, pairs: dict[int, int]) -> None:
        """Open addressing with linear probing; at most half full."""
        bits = max(4, (2 * len(pairs)).bit_length())
        self.mask, self.shift = (1 << bits) - 1, 64 - bits
        self.keys = np.full(1 << bits, -1, dtype=np.int64)
        self.values = np.full(1 << bits, NONE, dtype=np.int32)
        keys = np.fromiter(pairs, dtype=np.int64, count=len(pairs))
        vals = np.fromiter(pairs.values(), dtype=np.int32, count=len(pairs))
        slot = self._slot(keys)
        while len(keys):
            free = self.keys[slot] == -1
            _, first = np.unique(slot[free], return_index=True)
            put = np.flatnonzero(free)[first]
            self.keys[slot[put]], self.values[slot[put]] = keys[put], vals[put]
            rest = np.ones(len(keys), dtype=bool)
            rest[put] = False
            keys, vals, slot = keys[rest], vals[rest], (slot[rest] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(self.shift)).astype(np.int64)

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, NONE where they don't merge (or pad < 0)."""
        keys = (a.astype(np.int64) << 32) | b.astype(np.int64)
        keys[(a < 0) | (b < 0)] = -2
        out = np.full(keys.shape, NONE, dtype=np.int32)
        at = np.flatnonzero(keys.ravel() >= 0)
        k = keys.ravel()[at]
        slot, flat = self._slot(k), out.ravel()
        while len(at):
            held = self.keys[slot]
            hit = held == k
            flat[at[hit]] = self.values[slot[hit]]
            go = ~hit & (held != -1)
            at, k, slot = at[go], k[go], (slot[go] + 1) & self.mask
        return flat.reshape(keys.shape)

    def merge(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece, whatever its length."""
        out: list[np.ndarray | None] = [None] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            if (r := self.rank.get(p)) is not None:
                out[i] = np.array([r], dtype=np.int32)
            elif len(p) > LONG:
                out[i] = self._heap(p)
            elif p:
                buckets.setdefault(1 << (len(p) - 1).bit_length(), []).append(i)
            else:
                out[i] = np.empty(0, dtype=np.int32)
        for width, rows in buckets.items():
            step = max(1, (1 << 20) // width)
            for k in range(0, len(rows), step):
                self._matrix(pieces, rows[k:k + step], width, out)
        return out

    def _matrix(self, pieces, rows, width, out) -> None:
        m = np.full((len(rows), width + 1), -1, dtype=np.int32)
        sizes = np.fromiter((len(pieces[i]) for i in rows), dtype=np.int64, count=len(rows))
        m[:, :width][np.arange(width) < sizes[:, None]] = self.byte[
            np.frombuffer(b"".join(pieces[i] for i in rows), dtype=np.uint8)]
        ids = np.array(rows)
        p = self.pair(m[:, :-1], m[:, 1:])
        while len(ids):
            j = p.argmin(axis=1)
            best = p[np.arange(len(ids)), j]
            done = best == NONE
            if done.any():  # compaction: finished rows leave
                for r in np.flatnonzero(done):
                    out[ids[r]] = m[r, :sizes[r]].copy()
                go = ~done
                m, p, j, best, ids, sizes = m[go], p[go], j[go], best[go], ids[go], sizes[go]
                if not len(ids):
                    return
                if (keep := int(sizes.max())) + 1 < m.shape[1]:
                    m, p = m[:, :keep + 1], p[:, :keep]
            r = np.arange(len(ids))
            m[r, j] = best
            col = np.arange(m.shape[1] - 1)
            m[:, :-1] = np.take_along_axis(m, col + (col > j[:, None]), axis=1)
            m[:, -1] = -1
            col = col[:-1]
            p[:, :-1] = np.take_along_axis(p, col + (col >= j[:, None]), axis=1)
            p[:, -1] = NONE
            p[r, j] = self.pair(m[r, j], m[r, j + 1])
            left = np.flatnonzero(j > 0)
            p[left, j[left] - 1] = self.pair(m[left, j[left] - 1], m[left, j[left]])
            sizes = sizes - 1

    def _heap(self, piece: bytes) -> np.ndarray:
        ids = self.byte[np.frombuffer(piece, dtype=np.uint8)].tolist()
        n, token, rank = len(ids), self.token, self.rank
        nxt, prv, live = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n

        def of(i):
            k = nxt[i]
            return rank.get(token[ids[i]] + token[ids[k]]) if k < n else None

        heap = [(r, i) for i in range(n - 1) if (r := of(i)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            if not live[i] or of(i) != r:
                continue
            k = nxt[i]
            ids[i], live[k], nxt[i] = r, False, nxt[k]
            if nxt[i] < n:
                prv[nxt[i]] = i
            for at in (prv[i], i):
                if at >= 0 and (x := of(at)) is not None:
                    heapq.heappush(heap, (x, at))
        return np.array([x for x, on in zip(ids, live) if on], dtype=np.int32)

    def reset(self) -> None:
        self.known = Known()
        self.start = np.empty(0, dtype=np.int64)
        self.size = np.empty(0, dtype=np.int64)
        self.flat = np.empty(0, dtype=np.int32)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of whole texts; pieces met before are looked up."""
        if len(self.known) > CACHE:
            self.reset()
        place = self.known.__getitem__
        spots = [np.fromiter(map(place, self.find(t)), dtype=np.int64) for t in texts]
        if new := self.known.new:
            got = self.merge([p.encode() for p in new])
            sizes = np.fromiter(map(len, got), dtype=np.int64, count=len(got))
            ends = np.cumsum(sizes) + len(self.flat)
            self.start = np.concatenate([self.start, ends - sizes])
            self.size = np.concatenate([self.size, sizes])
            self.flat = np.concatenate([self.flat, *got])
            self.known.new = []
        out = []
        for s in spots:
            n = self.size[s]
            total = int(n.sum())
            at = np.repeat(self.start[s] - (np.cumsum(n) - n), n) + np.arange(total)
            out.append(self.flat[at])
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.token.__getitem__, ids.tolist()))


class Known(dict):
    """Piece -> its number; a new piece gets the next number."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        n = self[piece] = len(self)
        self.new.append(piece)
        return n


_LOADED: dict[bytes, Ranks] = {}


def _ranks(raw: bytes, pattern: str) -> Ranks:
    key = hashlib.sha256(raw + pattern.encode()).digest()
    if key not in _LOADED:
        _LOADED[key] = Ranks(raw, pattern)
    return _LOADED[key]


def vocabulary(path: str) -> bytes:
    """Read a rank file on the driver (its size does not depend on the data)."""
    with open(path, "rb") as f:
        return f.read()


def _coded(docs: DataFrame, id_col: str, text_col: str, path: str, pattern: str, columns: dict, row) -> DataFrame:
    """The id and what ``row`` makes of each text's ids; ``columns`` maps a name to
    its Spark and its Arrow type."""
    raw = docs.sparkSession.sparkContext.broadcast(vocabulary(path))
    frame = small_batches(docs).select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    kind = frame.schema["doc_id"].dataType.simpleString()

    def run(batches):
        coder = _ranks(raw.value, pattern)
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                texts = [t or "" for t in part.column("text").to_pylist()]
                rows = [row(coder, ids) for ids in coder.encode(texts)]
                cols = [pa.array(c, a) for c, (_, a) in zip(zip(*rows), columns.values())]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *cols], names=names)

    names = ["doc_id", *columns]
    return frame.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{n} {t}" for n, (t, _) in columns.items()))


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of every row; null text counts as empty (no
    ids).  Rows keep their own id, null or repeated."""
    return _coded(docs, id_col, text_col, path, pattern, {"ids": ("array<int>", pa.list_(pa.int32()))}, lambda c, ids: (ids.tolist(),))


def digest(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row: the ids as
    little-endian unsigned 32-bit integers, and the bytes decoded from them.
    Null text counts as empty; an empty table gives no rows."""
    def row(coder, ids):
        return (len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(),
                hashlib.sha256(coder.decode(ids)).hexdigest())

    return _coded(docs, id_col, text_col, path, pattern, {
        "n_tokens": ("long", pa.int64()), "ids_sha256": ("string", pa.string()), "decoded_sha256": ("string", pa.string())}, row)
