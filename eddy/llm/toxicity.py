"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word is the bag of its character n-grams (with word boundaries) and itself,
each hashed to a row of an embedding table.  A document is the mean of all its
bags' rows; a linear softmax scores it.  Table and softmax are trained jointly
in numpy, in one Spark task, from a bounded sample of labelled rows; only the
buckets that training kept come back to the driver.  A word
never seen in training still shares n-gram rows with the words it resembles.

Training bound (parameters of ``fit``): at most ``per_class`` rows of each
label, in the order of a hash of the id, with texts of up to ``max_chars``
characters.  Clean texts are learnt by two short excerpts each as well, since a
few words of a clean text are clean too; without them short texts score by the
chance of their few n-grams.  Scoring runs over whole texts in Spark tasks; since the model is
linear, a word's contribution is one number, kept by word.
"""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eddy.llm.common import ALNUM, byte_texts, small_batches

FOLDS, HELD_OUT = 5, 0
CACHE = 400_000
BITS = 20         # buckets (log2)
SMOOTH = 30      # empty n-grams that every bag holds: short texts lean on the bias
MIN_DOCS = 3      # sampled documents that a bucket must occur in to get an embedding
EXCERPTS = ((1, 4), (4, 16))  # words of the excerpts that clean texts are learnt by as well
MAX_STEP = 10.0   # longest gradient step of a round
SLICE = 1 << 19   # bucket places that training sums at a time


def fold(id_col: str):
    """crc32 of the id as text, modulo ``FOLDS``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS


def words(text: bytes) -> list[bytes]:
    return text.decode().lower().encode().translate(ALNUM).split()


def grams(word: bytes, low: int = 3, high: int = 6) -> list[int]:
    """Hashes of a word's bag: the word itself and its character n-grams."""
    w = "<" + word.decode() + ">"
    crc = zlib.crc32
    bag = [crc(w.encode())]
    for n in range(low, high + 1):
        for i in range(len(w) - n + 1):
            bag.append(crc(b"%d" % n + w[i:i + n].encode()))
    return bag


def bag(text: bytes, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text's words and n-grams, and their shares."""
    known: dict[bytes, list[int]] = {}
    all_: list[int] = []
    for w in words(text):
        if w not in known:
            known[w] = grams(w)
        all_ += known[w]
    at, times = np.unique(np.array(all_, dtype=np.uint32) & np.uint32((1 << bits) - 1), return_counts=True)
    return at.astype(np.int32), (times / (len(all_) + SMOOTH)).astype(np.float32)


def excerpts(text: bytes) -> list[bytes]:
    """Runs of a few words, at places that depend on the text only."""
    w = text.split()
    rng = random.Random(zlib.crc32(text))
    out = []
    for low, high in EXCERPTS:
        n = rng.randint(low, high)
        at = rng.randrange(max(1, len(w) - n + 1))
        out.append(b" ".join(w[at:at + n]))
    return out


class Model:
    """Logits (embedding row times softmax difference) of the used buckets, 0 of
    the others, and a bias.  Pickled it holds the used buckets only."""

    def __init__(self, used: np.ndarray, logit: np.ndarray, bias: float, bits: int = BITS):
        self.used, self.values, self.bias, self.bits = used.astype(np.int32), logit, bias, (1 << bits) - 1
        self.logit = None
        self._clear()

    def __getstate__(self):
        return self.used, self.values, self.bias, self.bits.bit_length()

    def __setstate__(self, s):
        self.__init__(*s)

    def _clear(self):
        self.seen: dict[bytes, int] = {}
        self.total, self.count = np.zeros(1024), np.zeros(1024)

    def _place(self, w: bytes) -> int:
        n = len(self.seen)
        if n >= len(self.total):
            self.total = np.concatenate([self.total, np.zeros(n)])
            self.count = np.concatenate([self.count, np.zeros(n)])
        bag = grams(w)
        logit, bits = self.logit, self.bits
        self.total[n] = sum(logit[h & bits] for h in bag)
        self.count[n] = len(bag)
        self.seen[w] = n
        return n

    def score(self, text: bytes) -> float:
        if len(self.seen) > CACHE:
            self._clear()
        if self.logit is None:
            self.logit = np.zeros(self.bits + 1)
            self.logit[self.used] = self.values
        seen, place = self.seen, self._place
        at = np.fromiter((seen[w] if w in seen else place(w) for w in words(text)), dtype=np.int64)
        mean = self.total[at].sum() / (self.count[at].sum() + SMOOTH) if len(at) else 0.0
        return float(1 / (1 + np.exp(-np.clip(mean + self.bias, -500, 500))))


class Packed:
    """All bags in three flat arrays (document, place of the bucket, share),
    without the buckets of too few documents; ``used`` are the buckets left."""

    def __init__(self, bags: list[tuple[np.ndarray, np.ndarray]], bits: int = BITS):
        self.bits = bits
        docs = np.zeros(1 << bits, dtype=np.int32)
        for b, _ in bags:
            docs[b] += 1
        self.used = np.flatnonzero(docs >= MIN_DOCS)
        place = np.full(1 << bits, -1, dtype=np.int32)
        place[self.used] = np.arange(len(self.used), dtype=np.int32)
        size = int(docs[self.used].sum())
        self.doc, self.feat = np.empty(size, dtype=np.int32), np.empty(size, dtype=np.int32)
        self.val = np.empty(size, dtype=np.float32)
        end = 0
        for i, (b, v) in enumerate(bags):
            at = place[b]
            keep = at >= 0
            start, end = end, end + int(keep.sum())
            self.doc[start:end], self.feat[start:end], self.val[start:end] = i, at[keep], v[keep]

    def gather(self, rows: np.ndarray, groups: np.ndarray, x: np.ndarray, m: int) -> np.ndarray:
        """Sum of val * x[rows] by group, a slice and a column at a time."""
        out = np.zeros((m, x.shape[1]))
        for a in range(0, len(rows), SLICE):
            s = slice(a, a + SLICE)
            at = groups[s].astype(np.int64)
            for k in range(x.shape[1]):
                out[:, k] += np.bincount(at, self.val[s] * x[rows[s], k], m)
        return out.astype(np.float32)


def train(data: Packed, labels: np.ndarray, dim: int = 4, rounds: int = 60, rate: float = 2500.0, share: float = 0.5,
          seed: int = 5) -> Model:
    """Joint full-batch gradient descent with momentum on embedding table and
    softmax.  Label 1 weighs ``share`` of the loss whatever its number of rows.
    Without both labels the model says the only label there is (0 without rows)."""
    if not len(labels) or labels.min() == labels.max():
        return Model(np.zeros(0, dtype=np.int32), np.zeros(0), 30.0 if len(labels) and labels[0] else -30.0, data.bits)
    doc, feat, buckets = data.doc, data.feat, len(data.used)
    n, y = len(labels), labels
    weight = np.where(y == 1, share / (y == 1).sum(), (1 - share) / (y == 0).sum()).astype(np.float32)
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.1, (buckets, dim)).astype(np.float32)
    out = rng.normal(0, 1, (dim, 2)).astype(np.float32)
    off = np.zeros(2, dtype=np.float32)
    move = [np.zeros_like(emb), np.zeros_like(out), np.zeros_like(off)]

    for _ in range(rounds):
        bag = data.gather(feat, doc, emb, n)
        z = bag @ out + off
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(n), y] -= 1
        p *= weight[:, None]
        steps = [rate * data.gather(doc, feat, p @ out.T, buckets), 0.1 * bag.T @ p, 0.1 * p.sum(0)]
        for q, v, g in zip((emb, out, off), move, steps):
            v *= 0.9
            v += g * min(1.0, MAX_STEP / (float(np.sqrt((g * g).sum())) + 1e-12))
            q -= v
    return Model(data.used, (emb @ (out[:, 1] - out[:, 0])).astype(np.float64), float(off[1] - off[0]), data.bits)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 2000, max_chars: int = 10_000, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "toxic", **options) -> Model:
    """Train on a bounded sample of the labelled rows outside the held-out fold.

    Rows with a null id, text or label are not learnt from.  The sampled labels
    (at most twice ``per_class``) are small and are broadcast to the texts.  An
    id that several rows hold is learnt from once, by the text whose hash is
    smallest, so that the bound holds for rows as well as for labels.  Without
    any such row the model says 0.
    """
    known = (labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y"))
             .where("_id is not null and _y in (0, 1)").withColumn("_f", fold("_id")).where(f"_f <> {HELD_OUT}"))
    order = [F.xxhash64("_id"), F.col("_id")]
    sample = known.where("_y = 1").orderBy(*order).limit(per_class).union(
        known.where("_y = 0").orderBy(*order).limit(per_class)).select("_id", "_y").distinct()
    picked = (docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
              .where(F.length("_text") <= max_chars).join(F.broadcast(sample), "_id")
              .groupBy("_id", "_y").agg(F.min_by("_text", F.struct(F.xxhash64("_text"), F.col("_text"))).alias("_text")))

    def bags(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                part = batch.slice(k, 64)
                label = part.column("_y").to_pylist()
                got = [(i, n, bag(x)) for i, t in enumerate(byte_texts(part, "_text"))
                       for n, x in enumerate([t] if label[i] else [t, *excerpts(t)])]
                of = pa.array([i for i, *_ in got], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id").take(of), part.column("_y").take(of), pa.array([n for _, n, _ in got], pa.int32()),
                     *(pa.array([x[i].tobytes() for *_, x in got], pa.binary()) for i in (0, 1))],
                    names=["_id", "_y", "part", "at", "share"])

    def learn(batches):
        """The one task that sees the whole sample."""
        rows = [(i, y, n, np.frombuffer(a, dtype=np.int32), np.frombuffer(v, dtype=np.float32))
                for b in batches for i, y, n, a, v in zip(*(c.to_pylist() for c in b.columns))]
        rows.sort(key=lambda r: r[:3])
        m = train(Packed([r[3:] for r in rows]), np.array([r[1] for r in rows], dtype=np.int64), **options)
        yield pa.RecordBatch.from_arrays([pa.array([m.used.tobytes()], pa.binary()), pa.array([m.values.tobytes()], pa.binary()),
                                          pa.array([m.bias], pa.float64())], names=["used", "logit", "bias"])

    kind = picked.schema["_id"].dataType.simpleString()
    rows = small_batches(picked).mapInArrow(bags, f"_id {kind}, _y int, part int, at binary, share binary")
    got = rows.repartition(1).mapInArrow(learn, "used binary, logit binary, bias double").first()
    if got is None:  # no rows, so no task
        return train(Packed([]), np.empty(0, dtype=np.int64))
    return Model(np.frombuffer(got.used, dtype=np.int32), np.frombuffer(got.logit, dtype=np.float64), got.bias)


def _scored(frame: DataFrame, text_col: str, model: Model, schema: str, row) -> DataFrame:
    shared = frame.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            scores = [shared.value.score(t) for t in byte_texts(batch, text_col)]
            yield row(batch, pa.array(scores, pa.float64()))

    return small_batches(frame).mapInArrow(run, schema)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted): every row, over its whole text; null and
    empty texts get the model's bias alone.  Ids may be null or repeated."""
    frame = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = frame.schema["doc_id"].dataType.simpleString()
    got = _scored(frame, "text", model, f"doc_id {kind}, score double", lambda b, s: pa.RecordBatch.from_arrays(
        [b.column("doc_id"), s], names=["doc_id", "score"]))
    return got.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows that the model doesn't reject, with all their columns."""
    import pyarrow.compute as pc

    return _scored(docs, text_col, model, docs.schema, lambda b, s: b.filter(pc.less(s, 0.5)))
