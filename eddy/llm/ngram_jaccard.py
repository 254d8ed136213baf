"""N-gram Jaccard join: pairs of texts whose word-shingle sets are alike.

A text's set holds 64-bit hashes of its distinct 5-word shingles.  Equal sets
(by a 128-bit digest) are one class, named by the number of its first row.  The
search is exact but for two shingles of one pair of texts that share a hash:

1. *Prefixes.*  Two sets of similarity t share a member of their prefixes: the
   first ``n - ceil(t n) + 1`` members in any order that all sets agree on.  The
   order puts frequent shingles last, so common passages hardly ever are in a
   prefix.  Which are frequent is learnt from a sample; it changes the order
   only, never the result.
2. *Stars.*  Classes that share a min-hash are compared with one of them, the
   one with the largest share of frequent shingles: in a group of edited copies
   that is the original, which is nearer to each copy than they are to another.  What is linked that way forms groups early on, so that the next
   step needs no pairs within a group.
3. *Tiles.*  Classes of different groups that share a prefix member meet: by an
   equi-join if few hold the member, else in a tile of one member and one size
   band, whose pairs are bounded in numpy without being emitted.  A large tile
   is cut into blocks that Spark deals out by pairs; a group that fills blocks of
   its own never meets itself.
4. Every pair must pass the bitmap bound: a signature has one bit for each
   hashed shingle, so bits of one set that the other lacks are shingles it
   lacks, and the count bounds the overlap from above.
5. What is left is compared exactly as sorted arrays.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eddy.llm.common import LOWER, bounded, byte_texts, components, key_table, in_table, mix, small_batches, written

STARS = 6           # min-hashes that a class looks for a group by
FEW = 128           # groups that may meet by a join at one prefix member
SAMPLE = 16         # one text in so many counts for the order of shingles
BLOCK = 1024        # classes in one block of a tile
FREQUENT = 3        # sampled texts from which on a shingle is frequent
_MULT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD,
                  0xC4CEB9FE1A85EC53], dtype=np.uint64)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def shingles(text: bytes, known: dict, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the ``size``-word shingles (A-Z lower-cased,
    words split at ASCII white space); a shorter text is one shingle."""
    words = text.translate(LOWER).split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
    k = min(size, len(h))
    total = np.full(len(h) - k + 1, k, dtype=np.uint64)
    for i in range(k):
        total += mix(h[i:len(h) - k + 1 + i] + np.uint64(i)) * _MULT[i % 5] * np.uint64(2 * (i // 5) + 1)
    return np.unique(mix(total))


def bitmap(members: np.ndarray) -> bytes:
    """One bit a member, in 8 to 16 bits a member (a power of two, 64 at least):
    few members share a bit, so the bound is tight near the threshold."""
    width = max(64, 1 << (8 * len(members) - 1).bit_length())
    bits = np.zeros(width, dtype=np.uint8)
    bits[(members & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def folded(bits: bytes, size: int) -> bytes:
    """A bitmap of ``size`` bytes for the same set (sizes are powers of two)."""
    a = np.frombuffer(bits, dtype=np.uint8).reshape(-1, size)
    return np.bitwise_or.reduce(a, axis=0).tobytes()


def may_link(n1: int, bits1: bytes, n2: int, bits2: bytes, percent: int) -> bool:
    """False only if the sizes or the bitmaps rule a link out."""
    size = min(len(bits1), len(bits2))
    a = int.from_bytes(bits1 if len(bits1) == size else folded(bits1, size), "little")
    b = int.from_bytes(bits2 if len(bits2) == size else folded(bits2, size), "little")
    most = min(n1 - (a & ~b).bit_count(), n2 - (b & ~a).bit_count())
    return 100 * most >= percent * (n1 + n2 - most)


def _text_key(text):
    return F.unhex(F.md5(text.cast("binary")))


def _frequent(texts: DataFrame, words: int) -> np.ndarray:
    def run(batches):
        known = _Words()
        for batch in batches:
            for t in byte_texts(batch, "text"):
                yield pa.RecordBatch.from_arrays([pa.array(shingles(t, known, words).view(np.int64))], names=["h"])

    part = texts.where(F.pmod(F.xxhash64("tkey"), F.lit(SAMPLE)) == 0).dropDuplicates(["tkey"]).select("text")
    counts = part.mapInArrow(run, "h long").groupBy("h").count()
    return key_table(counts.where(f"count >= {FREQUENT}"), "h")


def _signatures(texts: DataFrame, words: int, percent: int, frequent) -> DataFrame:
    kind = texts.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "tkey", "n", "digest", "bits", "stars", "prefix", "share"]

    def run(batches):
        known = _Words()
        table = frequent.value
        for batch in batches:
            for k in range(0, batch.num_rows, 1000):
                part = batch.slice(k, 1000)
                n, ids, bits, stars, prefix, share = [], [], [], [], [], []
                for t in byte_texts(part, "text"):
                    s = shingles(t, known, words)
                    n.append(len(s))
                    if not len(s):
                        for col in (ids, bits, stars, prefix, share):
                            col.append(None)
                        continue
                    ids.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    bits.append(bitmap(s))
                    stars.append([int((s * m).min().view(np.int64)) for m in _MULT[:STARS]])
                    late = in_table(table, s)
                    share.append(float(late.mean()))
                    first = len(s) - -(-percent * len(s) // 100) + 1
                    prefix.append(np.concatenate([s[~late], s[late]])[:first].view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("tkey"), pa.array(n, pa.int64()), pa.array(ids, pa.binary()),
                     pa.array(bits, pa.binary()), pa.array(stars, pa.list_(pa.int64())),
                     pa.array(prefix, pa.list_(pa.int64())), pa.array(share, pa.float64())], names=names)

    return texts.mapInArrow(run, f"doc_id {kind}, tkey binary, n long, digest binary, bits binary, stars array<long>, "
                                 "prefix array<long>, share double")


def _passing(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that sizes and bitmaps don't rule out."""
    side = classes.select("set_id", "n", "bits")
    rows = (pairs.join(side.toDF("a", "n1", "bits1"), "a").join(side.toDF("b", "n2", "bits2"), "b")
            .where(f"100 * least(n1, n2) >= {percent} * greatest(n1, n2)"))

    def run(batches):
        for batch in batches:
            d = batch.to_pydict()
            ok = [may_link(*x, percent) for x in zip(d["n1"], d["bits1"], d["n2"], d["bits2"])]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return rows.mapInArrow(run, "a long, b long")


def _linked(pairs: DataFrame, classes: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs that link, by exact intersection of their sorted arrays."""
    pairs = written(pairs, "jaccard-pairs")
    need = pairs.select(F.col("a").alias("set_id")).union(pairs.select("b")).distinct()
    keys = bounded(written(need.join(classes.select("set_id", "tkey"), "set_id"), "jaccard-keys"))

    def sets(batches):
        known = _Words()
        for batch in batches:
            rows = [shingles(t, known, words).tobytes() for t in byte_texts(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column("set_id"), pa.array(rows, pa.binary())], names=["id", "s"])

    arrays = (texts.join(keys, "tkey").select("text", "set_id").mapInArrow(sets, "id long, s binary")
              .dropDuplicates(["id"]))
    arrays = written(arrays, "jaccard-sets")
    rows = pairs.join(arrays.toDF("a", "s1"), "a").join(arrays.toDF("b", "s2"), "b")

    def run(batches):
        for batch in batches:
            d = batch.to_pydict()
            ok = []
            for x, y in zip(d["s1"], d["s2"]):
                x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return written(rows.mapInArrow(run, "a long, b long"), "jaccard-links")


def _blocks(rows: DataFrame) -> DataFrame:
    """``rows(token, band, root, set_id, ...)`` with own block and the block pair
    (i, j) they go to: all pairs of the tile's blocks, but for two of one group.
    A tile of up to ``BLOCK`` rows is one block."""
    count = rows.groupBy("token", "band", "root").agg(F.count(F.lit(1)).alias("c"))
    tile = count.groupBy("token", "band").agg(
        F.sum("c").alias("c"), F.coalesce(F.sum(F.when(F.col("c") <= BLOCK, F.col("c"))), F.lit(0)).alias("light")).where(f"c > {BLOCK}")
    tile = written(tile.select("token", "band", F.ceil(F.col("light") / BLOCK).alias("lights")), "jaccard-tiles")
    # Groups with blocks of their own: at most c / BLOCK a tile.
    own = count.where(f"c > {BLOCK}").join(bounded(tile), ["token", "band"]).withColumn("own", F.ceil(F.col("c") / BLOCK))
    order = Window.partitionBy("token", "band").orderBy("root")
    own = own.withColumn("first", F.col("lights") + F.sum("own").over(order) - F.col("own"))
    own = written(own.select("token", "band", "root", "own", "first"), "jaccard-own")
    total = own.groupBy("token", "band").agg(F.sum("own").alias("heavy"))
    tile = written(tile.join(total, ["token", "band"], "left").select(
        "token", "band", "lights", (F.col("lights") + F.coalesce("heavy", F.lit(0))).alias("blocks")), "jaccard-blocks")
    put = rows.join(bounded(tile), ["token", "band"], "left").join(bounded(own), ["token", "band", "root"], "left")
    put = put.withColumn("b", F.when(F.col("blocks").isNull(), F.lit(0)).otherwise(F.coalesce(
        F.col("first") + F.pmod(F.xxhash64("set_id"), F.col("own")), F.pmod(F.xxhash64("set_id"), F.greatest("lights", F.lit(1))))))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("blocks", F.lit(1)) - 1))
    put = put.withColumn("p", other).where("own is null or p < first or p >= first + own")
    return put.withColumns({"i": F.least("b", "p"), "j": F.greatest("b", "p")}).drop("p", "own", "first", "lights", "blocks")


def _tiles(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different groups in tiles of one prefix member and one
    size band.  A band spans one ratio of sizes that can still link, so partners
    are in the same band or the next; a class goes to its own band (as ``home``)
    and to the one above."""
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(float(np.log(100 / percent)))).cast("int")
    both = rows.withColumn("band", band).select(
        "token", "root", "set_id", "n", "bits",
        F.explode(F.array(F.struct(F.col("band").alias("band"), F.lit(True).alias("home")),
                          F.struct((F.col("band") + 1).alias("band"), F.lit(False).alias("home")))).alias("t"))
    both = _blocks(both.select("token", "t.band", "t.home", "root", "set_id", "n", "bits"))
    key = ["token", "band", "i", "j"]
    tiles = both.select(*key, "b", "home", "root", "set_id", "n", "bits").repartition(*key).sortWithinPartitions(*key)

    def pairs(tile):
        home, root, ids, n, b = (np.array(x) for x in zip(*((r["home"], r["root"], r["set_id"], r["n"], r["b"]) for r in tile)))
        across = tile[0]["i"] < tile[0]["j"]   # two blocks: each has met itself elsewhere
        if not home.any() or root.min() == root.max():
            return
        size = min(len(r["bits"]) for r in tile)
        bits = np.frombuffer(b"".join(folded(r["bits"], size) for r in tile), dtype=np.uint64).reshape(len(tile), -1)
        order = np.flatnonzero(home)
        for i in order.tolist():
            # Partners: this band's later members and the band below.
            with_ = np.flatnonzero((root != root[i]) & (~home | (ids > ids[i])) & ((b != b[i]) | (not across))
                                   & (100 * np.minimum(n, n[i]) >= percent * np.maximum(n, n[i])))
            if not len(with_):
                continue
            x, y = bits[i], bits[with_]
            most = np.minimum(n[i] - np.bitwise_count(x & ~y).sum(1, dtype=np.int64),
                              n[with_] - np.bitwise_count(y & ~x).sum(1, dtype=np.int64))
            for j in with_[100 * most >= percent * (n[i] + n[with_] - most)].tolist():
                yield (ids[i], ids[j]) if ids[i] < ids[j] else (ids[j], ids[i])

    def run(batches):
        tile, key = [], None
        for batch in batches:
            out = set()
            for r in batch.to_pylist():
                if (now := (r["token"], r["band"], r["i"], r["j"])) != key:
                    if tile:
                        out.update(pairs(tile))
                    tile, key = [], now
                tile.append(r)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([int(x[k]) for x in out], pa.int64()) for k in (0, 1)], names=["a", "b"])
        out = set(pairs(tile)) if tile else ()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([int(x[k]) for x in out], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return tiles.mapInArrow(run, "a long, b long")


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
         percent: int = 75) -> tuple[DataFrame, DataFrame]:
    """(members, links): ``members(doc_id, tkey, n, set_id)`` has every row of
    ``docs`` with a hash of its text and its class; ``links(a, b)`` pairs of classes that link, enough
    of them to connect every class with all it can reach.

    Null and empty texts have an empty set, a null class and no link.
    """
    spark = docs.sparkSession
    texts = small_batches(docs).select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn(
        "tkey", _text_key(F.col("text")))
    frequent = spark.sparkContext.broadcast(_frequent(texts, words))
    sig = written(_signatures(texts, words, percent, frequent).withColumn("rid", F.monotonically_increasing_id()), "jaccard-sig")
    full = sig.where("digest is not null")
    first = full.groupBy("digest").agg(F.min("rid").alias("set_id"), F.count(F.lit(1)).alias("c")).where("c > 1")
    first = bounded(written(first.select("digest", "set_id"), "jaccard-first"))
    copies = bounded(written(full.join(first, "digest").where("rid <> set_id").select("rid", "set_id"), "jaccard-copies"))
    classes = full.join(copies, "rid", "left_anti").withColumn("set_id", F.col("rid"))

    star = classes.select("set_id", "share", F.explode("stars").alias("star"))
    lead = (star.groupBy("star").agg(F.max(F.struct("share", "set_id")).alias("m"), F.min("set_id").alias("lo"),
                                     F.max("set_id").alias("hi")).where("lo <> hi").select("star", F.col("m.set_id").alias("a")))
    pairs = star.join(lead, "star").where("a <> set_id").select("a", F.col("set_id").alias("b")).distinct()
    early = _linked(_passing(pairs, classes, percent), classes, texts, words, percent)

    group = written(components(spark, early), "jaccard-groups")
    member = classes.select("set_id", "n", "prefix").join(group.withColumnRenamed("node", "set_id"), "set_id", "left").select(
        "set_id", "n", F.coalesce("root", "set_id").alias("root"), "prefix")
    token = member.select(F.explode("prefix").alias("token"), "root").groupBy("token").agg(
        F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("token")
    token = written(token, "jaccard-tokens")
    table = spark.sparkContext.broadcast(key_table(token, "token"))

    def shared(batches):
        for batch in batches:
            lists = batch.column("prefix")
            flat = lists.flatten().to_numpy()
            row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
            on = in_table(table.value, flat)
            at = pa.array(row[on])
            yield pa.RecordBatch.from_arrays([pa.array(flat[on]), batch.column("root").take(at), batch.column("set_id").take(at),
                                              batch.column("n").take(at)], names=["token", "root", "set_id", "n"])

    rows = member.mapInArrow(shared, "token long, root long, set_id long, n long").join(token, "token")
    rows = written(rows, "jaccard-rows")
    # How many groups a member meets: an upper bound, the number of classes.
    many = rows.groupBy("token").count().where(f"count > {FEW}").select("token")
    many = written(many, "jaccard-many")
    few = rows.join(bounded(many), "token", "left_anti")
    x = few.select("token", F.col("root").alias("r1"), F.col("set_id").alias("s1"), F.col("n").alias("n1"))
    y = few.select("token", F.col("root").alias("r2"), F.col("set_id").alias("s2"), F.col("n").alias("n2"))
    near = (x.join(y, "token").where(f"r1 <> r2 and s1 < s2 and 100 * least(n1, n2) >= {percent} * greatest(n1, n2)")
            .select(F.col("s1").alias("a"), F.col("s2").alias("b")).distinct())
    big = rows.join(bounded(many), "token", "left_semi").join(classes.select("set_id", "bits"), "set_id")
    late = _linked(_passing(near, classes, percent).union(_tiles(big, percent)).distinct(), classes, texts, words, percent)
    members = sig.select("doc_id", "tkey", "n", "rid", F.col("digest").isNotNull().alias("any")).join(copies, "rid", "left")
    return members.select("doc_id", "tkey", "n", F.when(F.col("any"), F.coalesce("set_id", "rid")).alias("set_id")), early.union(late)


def _labelled(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> DataFrame:
    """(doc_id, tkey, n_shingles, component_id)."""
    members, links = join(docs, id_col, text_col, words, percent)
    low = members.where("set_id is not null").groupBy("set_id").agg(F.min("doc_id").alias("low"))
    root = components(docs.sparkSession, links).withColumnRenamed("node", "set_id")
    named = low.join(root, "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
    name = named.groupBy("root").agg(F.min("low").alias("component_id"))
    label = written(named.join(name, "root").select(F.col("set_id").alias("_set"), "component_id"), "jaccard-labels")
    return members.join(bounded(label), F.col("set_id") == F.col("_set"), "left").select(
        "doc_id", "tkey", F.col("n").alias("n_shingles"),
        F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 75) -> DataFrame:
    """(doc_id, n_shingles, component_id): every row with the size of its set
    and the smallest id reachable by links, its own included.

    Equal texts are linked.  Null, empty and wordless texts are linked with
    nothing (their component is their own id).  A null id names no component;
    such a row takes the smallest other id it reaches, else null.  Rows may
    repeat ids.  An empty table gives no rows.
    """
    return _labelled(docs, id_col, text_col, words, percent).drop("tkey")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 75) -> DataFrame:
    """The rows of ``docs`` whose id is their component's, all columns kept,
    whatever their names: one document of each group.  Rows without an id stay,
    and so do rows that repeat the id that stays.  An empty table gives no rows."""
    gone = (_labelled(docs, id_col, text_col, words, percent).where("doc_id <> component_id")
            .select(F.col("doc_id").alias("gone_id"), F.col("tkey").alias("gone_key")).distinct())
    gone = bounded(written(gone, "jaccard-gone"))
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), _text_key(F.coalesce(F.col(text_col), F.lit(""))).alias("key"))
    return rows.join(gone, F.expr("id = gone_id and key = gone_key"), "left_anti").select("row.*")
