"""Sentiment words of texts, and pairs of words near each other, as numbers (numpy, Arrow).

A task splits its texts piece by piece, and looks at each different word of a piece
once.  Words are the ``sentiment_words`` that are letters and apostrophes only; what
letters and digits are is asked of Spark's regular expressions.

A word's code has some bits of its hash, a few more than it takes to number the words.
Words of the input that share those bits are few; they are given (``shared``, their
sorted 64-bit hashes) and have codes of their own, so that two words never have one
code and a pair is exactly one key.  The keys of a task are sorted and counted; blocks
of them, cut by value, go to the task that adds them up.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pandas.util import hash_array
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

PIECE_BYTES = 4 << 20      # bytes of text that a task splits at a time (a longer text by itself)
WINDOW = 1 << 19           # words whose pairs are made at a time
SLICE_PAIRS = 1 << 23      # pairs that a task sorts at a time
SLICE_EDGES = 1 << 20      # frequent pairs that a task looks at a time
MAX_SHARED = 1 << 22       # words that share the bits of others
MAX_BITS = 32              # of a word's code; two go into a key
ROWS = 1 << 17             # rows that a task hands over at a time
MARKS = "".join(c for c in map(chr, range(128)) if not c.isalnum() and c != "'")
PLANES = 0x40000           # code points from here on are no letters
_ODD = np.uint64(0x9E3779B1)
_kinds: list = []


def letter_kinds(spark: SparkSession) -> tuple[np.ndarray, np.ndarray]:
    """The borders of the ranges of letters, and of those of digits."""
    if not _kinds:
        blocks = [[chr(c) for c in range(k, k + 4096) if not 0xD800 <= c < 0xE000] for k in range(0, PLANES, 4096)]
        table = spark.createDataFrame([("".join(b),) for b in blocks if b], "t string")
        for rest in (r"[^\p{L}]+", r"[^\p{N}]+"):
            found = "".join(r.t for r in table.select(F.regexp_replace("t", rest, "").alias("t")).collect())
            flag = np.zeros(PLANES + 1, dtype=np.int8)
            flag[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = 1
            _kinds.append(np.flatnonzero(np.diff(flag, prepend=np.int8(0))))
    return _kinds[0], _kinds[1]


def _among(chars: list[str], borders: np.ndarray) -> set[str]:
    inside = np.searchsorted(borders, np.array([ord(c) for c in chars], dtype=np.int64), "right") % 2 == 1
    return {c for c, x in zip(chars, inside) if x}


def _stripped(words: list[str], kinds) -> list[str | None]:
    """Words without the marks around them; null for those that are not letters and
    apostrophes, a letter first, of two characters or more."""
    chars = sorted(set().union(*map(set, words)))
    letters = _among(chars, kinds[0])
    outer = "".join(set(chars) - letters - _among(chars, kinds[1]) - {"'"})
    inner = letters | {"'"}
    bare = [w.strip(outer) for w in words]
    return [w if len(w) > 1 and w[0] != "'" and inner.issuperset(w) else None for w in bare]


def split_words(texts: pa.Array, kinds) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(row, at, words) of lower-cased texts: for each word its text and its place among
    the different ``words``."""
    lists = pc.ascii_split_whitespace(texts)
    row = np.repeat(np.arange(len(texts), dtype=np.int32), pc.list_value_length(lists).fill_null(0).to_numpy())
    raw = lists.flatten().dictionary_encode()
    # Marks in ASCII go first; most words are the same as others then, and plain.
    bare = pc.ascii_trim(raw.dictionary, characters=MARKS).dictionary_encode()
    odd = pc.invert(pc.match_substring_regex(bare.dictionary, "^[a-z][a-z]+$"))
    found = pa.array(_stripped(bare.dictionary.filter(odd).to_pylist(), kinds), bare.dictionary.type)
    words = pc.replace_with_mask(bare.dictionary, odd, found).dictionary_encode()
    at = words.indices.fill_null(-1).to_numpy(zero_copy_only=False)[bare.indices.to_numpy()][raw.indices.to_numpy()]
    kept = at >= 0
    return row[kept], at[kept], words.dictionary


def pieces(batches, most: int) -> Iterator[pa.RecordBatch]:
    """The rows of the batches, as many at a time as have ``most`` bytes in column 0."""
    for batch in batches:
        n = np.cumsum(pc.binary_length(batch.column(0)).fill_null(0).to_numpy().astype(np.int64))
        cuts = np.unique(np.append(np.searchsorted(n, np.arange(0, n[-1] + 1 if len(n) else 0, most)), len(n)))
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield batch.slice(a, b - a)
    pa.default_memory_pool().release_unused()


def neighbours(row: np.ndarray, word: np.ndarray, reach: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Two arrays with the different words that stand up to ``reach`` places apart."""
    for a in range(0, len(word), WINDOW):
        r, w = row[a:a + WINDOW + reach], word[a:a + WINDOW + reach]
        for k in range(1, reach + 1):
            n = max(0, min(WINDOW, len(w) - k))
            near = (r[:n] == r[k:k + n]) & (w[:n] != w[k:k + n])
            yield w[:n][near], w[k:k + n][near]


def word_hashes(words: pa.Array, key: str) -> np.ndarray:
    return hash_array(np.array(words.to_pylist(), dtype=object), hash_key=key, categorize=False)


def plain_codes(hashes: np.ndarray, bits: int) -> np.ndarray:
    return hashes % np.uint64(3 << bits - 2)


def word_codes(hashes: np.ndarray, shared: np.ndarray, bits: int) -> np.ndarray:
    """Codes of so many bits: the hash's, and in the last quarter those of ``shared``."""
    code = plain_codes(hashes, bits)
    if len(shared):
        at = np.minimum(np.searchsorted(shared, hashes), len(shared) - 1)
        code = np.where(shared[at] == hashes, at.astype(np.uint64) + np.uint64(3 << bits - 2), code)
    return code


def pair_keys(x: np.ndarray, y: np.ndarray, bits: int) -> np.ndarray:
    """One key for two codes in either order.  Its high half depends on both, so the
    pairs of a frequent word lie apart."""
    low, high = np.minimum(x, y), np.maximum(x, y)
    return ((low + high * _ODD) & np.uint64((1 << bits) - 1)) << np.uint64(bits) | high


def key_codes(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << bits) - 1)
    high = keys & mask
    return ((keys >> np.uint64(bits)) - high * _ODD) & mask, high


def summed(keys: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The different ones of sorted keys, and how often they occur (``n`` times each)."""
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, dtype=np.int64)
    many = np.diff(np.append(first, len(keys))) if n is None else np.add.reduceat(n, first) if len(n) else n
    return keys[first], many


def _bytes(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit numbers as rows of as many bytes as the largest needs, lowest first."""
    wide = max(1, (int(x.max()).bit_length() + 7) // 8)
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :wide]


def _numbers(columns: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((columns[0].shape[0], 8), dtype=np.uint8)
    at = 0
    for c in columns:
        out[:, at:at + c.shape[1]] = c
        at += c.shape[1]
    return out.view("<u8").ravel()


def packed(keys: np.ndarray, n: np.ndarray) -> bytes:
    """Sorted different keys (one or more) and their counts.  The steps' highest bytes and
    the counts take few values; they are Huffman coded."""
    step, many = _bytes(np.diff(keys, prepend=keys[:1])), _bytes(n.astype(np.uint64))
    code = zlib.compressobj(1, zlib.DEFLATED, -15, 9, zlib.Z_HUFFMAN_ONLY)
    few = code.compress(step[:, -1].tobytes() + many.tobytes()) + code.flush()
    return np.array([len(keys), step.shape[1], many.shape[1], keys[0]], "<u8").tobytes() + step[:, :-1].tobytes() + few


def unpacked(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    size, wk, wn, first = (int(x) for x in np.frombuffer(block, "<u8", 4))
    data, end = memoryview(block), 32 + size * (wk - 1)
    few = np.frombuffer(zlib.decompress(data[end:], -15), np.uint8)
    step = _numbers([np.frombuffer(data[32:end], np.uint8).reshape(size, wk - 1), few[:size].reshape(size, 1)])
    return np.cumsum(step, dtype=np.uint64) + np.uint64(first), _numbers([few[size:].reshape(size, wn)]).astype(np.int64)


def blocks(keys: np.ndarray, bits: int, parts: int) -> Iterator[tuple[int, bytes]]:
    """Sorted keys of ``bits`` for each word, counted, in ``parts`` ranges of equal width,
    empty ones left out."""
    ends = [-(-(k << 2 * bits) // parts) for k in range(1, parts)]
    cuts = [0, *np.searchsorted(keys, np.array(ends, dtype=np.uint64)), len(keys)]
    for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
        if a < b:
            yield k, packed(*summed(keys[a:b]))


def rows_of(names: list[str], columns: list) -> Iterator[pa.RecordBatch]:
    for a in range(0, len(columns[0]), ROWS):
        yield pa.RecordBatch.from_arrays([pa.array(c[a:a + ROWS]) for c in columns], names=names)


# ------------------------- steps of mapInArrow --------------------------------

def count_sides(kinds, reach: int):
    """Lower-cased texts to (a, s): the words of a piece and the pairs they stand in."""
    def run(batches):
        for piece in pieces(batches, PIECE_BYTES):
            row, at, words = split_words(piece.column(0), kinds)
            s = np.zeros(len(words), dtype=np.int64)
            for x, y in neighbours(row, at, reach):
                s += np.bincount(x, minlength=len(s)) + np.bincount(y, minlength=len(s))
            found = np.flatnonzero(s)
            yield from rows_of(["a", "s"], [words.take(pa.array(found)), s[found]])
    return run


def count_pairs(kinds, reach: int, key: str, shared: np.ndarray, bits: int, parts: int):
    """Lower-cased texts to (part, block): the pairs of a slice, counted."""
    def handed(out):
        return pa.RecordBatch.from_arrays([pa.array([p for p, _ in out], pa.int32()), pa.array([b for _, b in out], pa.binary())], names=["part", "block"])

    def flushed(keys):
        keys.sort()
        out, size = [], 0
        for part, block in blocks(keys, bits, parts):
            out.append((part, block))
            size += len(block)
            if size > PIECE_BYTES:
                yield handed(out)
                out, size = [], 0
        if out:
            yield handed(out)

    def run(batches):
        held, size = np.empty(SLICE_PAIRS, dtype=np.uint64), 0
        for piece in pieces(batches, PIECE_BYTES):
            row, at, words = split_words(piece.column(0), kinds)
            if not len(words):
                continue
            code = word_codes(word_hashes(words, key), shared, bits)[at]
            del at, words
            for x, y in neighbours(row, code, reach):
                if size + len(x) > SLICE_PAIRS:
                    yield from flushed(held[:size])
                    size = 0
                held[size:size + len(x)] = pair_keys(x, y, bits)
                size += len(x)
        if size:
            yield from flushed(held[:size])
    return run


def add_pairs(bits: int, least: int):
    """(part, block), sorted by part, to (x, y, n): the codes of pairs that occur often."""
    def added(held):
        keys, n = (np.concatenate(c) for c in zip(*held))
        order = np.argsort(keys, kind="stable")
        keys, n = summed(keys[order], n[order])
        often = n >= least
        yield from rows_of(["x", "y", "n"], [*(c.astype(np.int64) for c in key_codes(keys[often], bits)), n[often]])

    def run(batches):
        now, held = None, []
        for batch in batches:
            for part, block in zip(batch.column(0).to_pylist(), batch.column(1)):
                if part != now and held:
                    yield from added(held)
                    held = []
                now = part
                held.append(unpacked(block.as_buffer()))
        if held:
            yield from added(held)
    return run


def count_labelled(kinds):
    """(text, bad, good), texts lower-cased, to (word, n, bad, good): how many texts of a
    piece hold a word, and how many with either label."""
    def run(batches):
        for piece in pieces(batches, PIECE_BYTES):
            row, at, words = split_words(piece.column(0), kinds)
            keys = row.astype(np.int64) * max(1, len(words)) + at
            keys.sort()
            row, at = np.divmod(summed(keys)[0], max(1, len(words)))
            counts = [np.bincount(at, minlength=len(words))]
            for c in (1, 2):
                label = piece.column(c).to_numpy(zero_copy_only=False)[row]
                counts.append(np.bincount(at[label > 0], minlength=len(words)))
            yield from rows_of(["word", "n", "bad", "good"], [words, *counts])
    return run


def add_codes(key: str, shared: np.ndarray, bits: int):
    """(a, s) to (a, s, hash, code)."""
    def run(batches):
        for batch in batches:
            h = word_hashes(batch.column(0), key) if batch.num_rows else np.zeros(0, dtype=np.uint64)
            columns = [*batch.columns, pa.array(h.view(np.int64)), pa.array(word_codes(h, shared, bits).astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "s", "hash", "code"])
    return run


# ------------------- frequent pairs as edges between nodes --------------------

def _slices(batches) -> Iterator[list[np.ndarray]]:
    """The columns of many batches at a time."""
    held, size = [], 0
    for batch in batches:
        held.append([c.to_numpy() for c in batch.columns])
        size += batch.num_rows
        if size >= SLICE_EDGES:
            yield [np.concatenate(c) for c in zip(*held)]
            held, size = [], 0
    if size:
        yield [np.concatenate(c) for c in zip(*held)]


def each_code():
    """(x, y, n) to (code): every code in a slice once."""
    def run(batches):
        for x, y, _ in _slices(batches):
            yield from rows_of(["code"], [np.unique(np.append(x, y))])
    return run


def link(shared, total: int, parts: int):
    """(x, y, n) to (part, block): both directions of each pair with a positive weight, by
    ranges of nodes.  A node is a place in the sorted codes; ``shared`` are those and their
    words' numbers of pairs.  Weights are in millionths."""
    def run(batches):
        codes, s = shared.value
        for x, y, n in _slices(batches):
            i, j = np.searchsorted(codes, x.astype(codes.dtype)), np.searchsorted(codes, y.astype(codes.dtype))
            w = np.rint(np.log(n.astype(np.float64) * float(total) / (s[i] * s[j])) * 1e6).astype(np.int32)
            i, j, w = i[w > 0].astype(np.int32), j[w > 0].astype(np.int32), w[w > 0]
            a, b, w = np.append(i, j), np.append(j, i), np.append(w, w)
            part = a.astype(np.int64) * parts // max(1, len(codes))
            order = np.argsort(part, kind="stable")
            cuts = np.append(np.flatnonzero(np.diff(part[order], prepend=-1)), len(a))
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                at = order[lo:hi]
                block = np.stack([a[at], b[at], w[at]]).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([part[at[0]]], pa.int32()), pa.array([block], pa.binary())], names=["part", "block"])
    return run


def gather():
    """(part, block), sorted by part, to (nodes, starts, near, weights): a row a part, the
    nodes in order and for each where its neighbours start."""
    def gathered(held):
        a, b, w = np.concatenate(held, axis=1)
        order = np.argsort(a, kind="stable")
        a, b, w = a[order], b[order], w[order]
        starts = np.flatnonzero(np.diff(a, prepend=-1)).astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in (a[starts], starts, b, w)], names=["nodes", "starts", "near", "weights"])

    def run(batches):
        now, held = None, []
        for batch in batches:
            for part, block in zip(batch.column(0).to_pylist(), batch.column(1)):
                if part != now and held:
                    yield gathered(held)
                    held = []
                now = part
                held.append(np.frombuffer(block.as_buffer(), np.int32).reshape(3, -1))
        if held:
            yield gathered(held)
    return run


def one_round(shared, damping: float):
    """Rows of ``gather`` to (nodes, valences): the damped mean of the neighbours' valences,
    ``shared``, by node."""
    def run(batches):
        now = shared.value
        for batch in batches:
            for row in zip(*batch.columns):
                nodes, starts, near, weights = (np.frombuffer(c.as_buffer(), np.int32) for c in row)
                w = weights / 1e6
                new = damping * np.add.reduceat(w * now[near], starts) / np.add.reduceat(w, starts)
                yield pa.RecordBatch.from_arrays([pa.array([nodes.tobytes()], pa.binary()), pa.array([np.round(new, 6).tobytes()], pa.binary())], names=["nodes", "valences"])
    return run


def named_valences(shared, least: float):
    """(code, a, s) to (word, valence) of ``least`` or more either side of zero; ``shared``
    are the sorted codes and their valences."""
    def run(batches):
        codes, valences = shared.value
        for batch in batches:
            v = valences[np.searchsorted(codes, batch.column(0).to_numpy().astype(codes.dtype))]
            found = pa.array(np.flatnonzero(np.abs(v) >= least))
            yield pa.RecordBatch.from_arrays([batch.column(1).take(found), pa.array(v).take(found)], names=["word", "valence"])
    return run
