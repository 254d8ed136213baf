"""Sentiment lexicon from the texts themselves (for T9).

The reference downloads a lexicon of thousands of scored words.  Here a few seed words
with a valence, or seeds taken from labelled documents, spread over the words that
stand near each other: an edge joins two words that occur within ``REACH`` words of
each other more often than by chance, weighted by the positive pointwise mutual
information.  A word's valence is a damped mean of its neighbours', seeds keep theirs,
and the only fixed point of that is reached by rounds of one join and one sum over the
edges; the damping bounds the rounds.

Pairs are counted with partial sums on the map side.  Only words and pairs that occur
``LEAST`` times or more take part, whatever the size of the input.
"""

from __future__ import annotations

import math
import uuid
from contextlib import contextmanager
from typing import NamedTuple

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eddy.functions import near
from eddy.functions.text import sentiment_words
from eddy.session import scratch_path

REACH = 4          # words to either side
LEAST = 3          # occurrences of a word, and of a pair
DAMPING = 0.8
SETTLED = 0.01     # largest change of a valence when the rounds end
SEED = 2.0         # valence of a seed word from labelled documents, either sign
ODDS = 1.5         # log odds from which on a word is a seed
WORD = r"^\p{L}[\p{L}']+$"
FAINT = 0.005      # valences below are left out of the lexicon
MAX_KNOWN = 2_000_000      # labels (an id and two bits) up to which they are broadcast
MAX_FEW = 200_000          # words up to which their valences are broadcast
MAX_NODES = 1 << 23        # words of frequent pairs up to which their valences are one array
PART_EDGES = 1 << 19       # edges in a row of arrays
PART_PAIRS = 1 << 22       # pairs that a task adds up at a time
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


class Counted(NamedTuple):
    """Words (a, s) with their number of pairs, the sum of these, and how words are coded."""
    words: DataFrame
    total: int
    key: str
    shared: np.ndarray | None
    bits: int


@contextmanager
def _small_batches(spark):
    """Within, Python tasks get no more bytes of rows at a time than they work on (Spark's
    own bound is 64 MB, of which a task holds several copies)."""
    now = spark.conf.get(BATCH)
    if not now.removesuffix("b").isdigit() or not 0 < int(now.removesuffix("b")) <= near.PIECE_BYTES:
        spark.conf.set(BATCH, str(near.PIECE_BYTES))
    try:
        yield
    finally:
        spark.conf.set(BATCH, now)


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    with _small_batches(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _words(text_col: str):
    return F.filter(sentiment_words(F.coalesce(F.col(text_col), F.lit(""))), lambda w: w.rlike(WORD))


def _few(words: DataFrame) -> DataFrame:
    """A table of words, broadcast if its size allows."""
    return F.broadcast(words) if words.limit(MAX_FEW + 1).count() <= MAX_FEW else words


def _texts(docs: DataFrame, text_col: str, *others) -> DataFrame:
    """Lower-cased texts, for the steps of ``near``."""
    cloudpickle.register_pickle_by_value(near)      # executors need not have this package
    return docs.select(F.lower(F.coalesce(F.col(text_col), F.lit(""))).alias("_t"), *others)


def _coded(words: DataFrame, key: str, shared: np.ndarray, bits: int) -> DataFrame:
    return words.mapInArrow(near.add_codes(key, shared, bits), "a string, s long, hash long, code long")


def _hash_key(words: DataFrame) -> tuple[str, np.ndarray | None, int]:
    """A key under which no two words have one 64-bit hash, the sorted hashes of the words
    whose code others would have too (null if these are too many), and a code's bits."""
    bits = min(near.MAX_BITS, max(1, words.count()).bit_length() + 5)
    while True:
        key = uuid.uuid4().hex[:16]
        coded = _coded(words, key, np.zeros(0, dtype=np.uint64), bits).select("hash", "code")
        twice = coded.groupBy("code").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("code")
        found = coded.join(twice, "code", "left_semi").select("hash").limit(near.MAX_SHARED + 1).toArrow()["hash"].to_numpy()
        if len(found) > near.MAX_SHARED:
            return key, None, bits
        shared = np.sort(found.view(np.uint64))
        if len(shared) <= 1 << bits - 2 and not (shared[1:] == shared[:-1]).any():
            return key, shared, bits


def _coded_pairs(docs: DataFrame, counted: Counted, text_col: str, reach: int, least: int) -> DataFrame:
    """(x, y, n): the codes of the pairs that occur ``least`` times or more."""
    spark = docs.sparkSession
    parts = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(counted.total / 2 / PART_PAIRS))
    count = near.count_pairs(near.letter_kinds(spark), reach, counted.key, counted.shared, counted.bits, parts)
    blocks = _texts(docs, text_col).mapInArrow(count, "part int, block binary")
    return blocks.repartition("part").sortWithinPartitions("part").mapInArrow(near.add_pairs(counted.bits, least), "x long, y long, n long")


def _string_pairs(docs: DataFrame, words: DataFrame, text_col: str, reach: int, least: int) -> DataFrame:
    """(a, sa, b, sb, n) of such pairs, for more different words than have codes."""
    rows = docs.select(_words(text_col).alias("w")).where(F.size("w") > 1)
    # A word with the up to ``reach`` words after it.  A pair is one string (words hold no space).
    at = rows.select("w", F.posexplode("w").alias("i", "a")).select("a", F.explode(F.slice("w", F.col("i") + 2, F.lit(reach))).alias("b"))
    pairs = at.where("a <> b").select(F.concat(F.least("a", "b"), F.lit(" "), F.greatest("a", "b")).alias("p")).groupBy("p").agg(
        F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    pairs = pairs.select(F.substring_index("p", " ", 1).alias("a"), F.substring_index("p", " ", -1).alias("b"), "n")
    frequent = words.where(F.col("s") >= least)
    return pairs.join(frequent.withColumnRenamed("s", "sa"), "a").join(
        frequent.select(F.col("a").alias("b"), F.col("s").alias("sb")), "b").select("a", "sa", "b", "sb", "n")


def _count(docs: DataFrame, text_col: str, reach: int) -> Counted:
    kinds = near.letter_kinds(docs.sparkSession)
    # A word's number of pairs is counted from the texts, so that of the pairs only
    # those that occur often are stored.
    side = _texts(docs, text_col).mapInArrow(near.count_sides(kinds, reach), "a string, s long")
    words = _kept(side.groupBy("a").agg(F.sum("s").alias("s")), "lexicon-words")
    return Counted(words, words.agg(F.sum("s")).first()[0] or 1, *_hash_key(words))       # one row


def _names(pairs: DataFrame, counted: Counted, least: int) -> DataFrame:
    """(a, sa, b, sb, n) of pairs of codes."""
    # The words' side of the joins is the small one: it is hashed, the pairs are not sorted.
    named = _coded(counted.words.where(F.col("s") >= least), counted.key, counted.shared, counted.bits)
    x, y = (named.select(F.col("code").alias(c), F.col("a").alias(f"w{c}"), F.col("s").alias(f"s{c}")).hint("shuffle_hash") for c in "xy")
    return pairs.join(x, "x").join(y, "y").select(
        F.least("wx", "wy").alias("a"), F.col("sx").alias("sa"), F.greatest("wx", "wy").alias("b"), F.col("sy").alias("sb"), "n")


def _weighed(pairs: DataFrame, total: int) -> DataFrame:
    """(a, b, n, weight): both directions of the pairs that occur more often than by chance."""
    pmi = F.log(F.col("n").cast("double") * F.lit(float(total)) / (F.col("sa").cast("double") * F.col("sb").cast("double")))
    pairs = _kept(pairs.select("a", "b", "n", F.round(pmi, 6).alias("weight")), "lexicon-pairs").where("weight > 0")
    return pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "n", "weight"))


def word_edges(docs: DataFrame, text_col: str = "text", reach: int = REACH, least: int = LEAST) -> DataFrame:
    """(a, b, n, weight): both directions of every pair of different words that occur
    near each other ``least`` times or more and more often than by chance; weight is
    the PMI over all pairs."""
    counted = _count(docs, text_col, reach)
    if counted.shared is None:
        return _weighed(_string_pairs(docs, counted.words, text_col, reach, least), counted.total)
    return _weighed(_names(_coded_pairs(docs, counted, text_col, reach, least), counted, least), counted.total)


def labelled_seeds(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """(word, valence): words that toxic documents hold far more often than others are
    negative, those of good, harmless documents as against all others positive."""
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias(id_col)).agg(
        F.max((F.col("toxic") == 1).cast("int")).alias("bad"),
        F.max(((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("int")).alias("good")).na.fill(0)
    known = _kept(known, "lexicon-labels")
    known = F.broadcast(known) if known.limit(MAX_KNOWN + 1).count() <= MAX_KNOWN else known
    size = docs.select(id_col).join(known, id_col).agg(F.count(F.lit(1)).alias("n"), F.sum("bad").alias("bad"), F.sum("good").alias("good")).first()
    n, bad, good = size.n or 0, size.bad or 0, size.good or 0
    # Texts meet their labels whole; a word is a row for each piece of the texts that holds it.
    rows = _texts(docs.join(known, id_col), text_col, "bad", "good").mapInArrow(
        near.count_labelled(near.letter_kinds(docs.sparkSession)), "word string, n long, bad long, good long")
    w = rows.groupBy("word").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.sum("good").alias("good")).where(F.col("n") >= least)

    def odds(hit: str, of: int):
        # Of documents with and without the label, the share that holds the word.
        yes = (F.col(hit) + 0.5) / F.lit(of + 1.0)
        no = (F.col("n") - F.col(hit) + 0.5) / F.lit(n - of + 1.0)
        return F.round(F.log(yes / no), 6)
    value = F.when(odds("bad", bad) >= ODDS, -SEED).when(odds("good", good) >= ODDS, SEED)
    return _kept(w.select("word", value.alias("valence")).where("valence is not null"), "lexicon-labelled")


def spread_once(edges: DataFrame, valences: DataFrame, seeds: DataFrame, damping: float = DAMPING) -> DataFrame:
    """(word, valence) after one round: seeds keep theirs, every other word takes the
    damped mean of its neighbours'; words with no valence near are left out."""
    known = valences.groupBy(F.col("word").alias("b")).agg(F.sum("valence").alias("valence"))
    rows = edges.join(_few(known.withColumn("known", F.lit(1))), "b", "left")
    got = rows.groupBy("a").agg(F.sum("weight").alias("all"), F.sum(F.col("weight") * F.col("valence")).alias("v"), F.count("known").alias("near"))
    got = got.where("near > 0").select(F.col("a").alias("word"), F.round(F.lit(damping) * F.col("v") / F.col("all"), 6).alias("valence"))
    return got.join(_few(seeds.select("word")), "word", "left_anti").unionByName(seeds.select("word", "valence"))


def _nodes(pairs: DataFrame, counted: Counted, least: int) -> DataFrame:
    """(code, a, s): the words of the pairs."""
    codes = pairs.mapInArrow(near.each_code(), "code long").distinct()
    words = _coded(counted.words.where(F.col("s") >= least), counted.key, counted.shared, counted.bits)
    return _kept(words.select("code", "a", "s").join(codes, "code", "left_semi"), "lexicon-nodes")


def _array_rounds(pairs: DataFrame, nodes: DataFrame, total: int, seeds: DataFrame, rounds: int, damping: float, settled: float) -> DataFrame:
    """(word, valence) after the rounds.  The edges are arrays in rows by ranges of nodes;
    the valences are one array that each round gets and gives back in parts."""
    spark = pairs.sparkSession
    table = nodes.select("code", "s").toArrow()
    codes, s = table["code"].to_numpy().astype(np.uint32), table["s"].to_numpy().astype(np.float64)
    order = np.argsort(codes)
    codes, s = codes[order], s[order]
    parts = max(4 * spark.sparkContext.defaultParallelism, math.ceil(2 * pairs.count() / PART_EDGES))
    shared = spark.sparkContext.broadcast((codes, s))
    blocks = pairs.mapInArrow(near.link(shared, total, parts), "part int, block binary").repartition("part").sortWithinPartitions("part")
    graph = _kept(blocks.mapInArrow(near.gather(), "nodes binary, starts binary, near binary, weights binary"), "lexicon-graph")
    shared.unpersist()
    given = seeds.join(nodes, seeds["word"] == nodes["a"]).select("code", F.coalesce("valence", F.lit(0.0)).alias("valence")).toArrow()
    fixed = np.searchsorted(codes, given["code"].to_numpy().astype(np.uint32))
    now = np.zeros(len(codes))
    now[fixed] = given["valence"].to_numpy()
    # A seed without a word counts as moved in every round, as in a join.
    restless = seeds.where("word is null").agg(F.max(F.abs("valence"))).first()[0] or 0.0
    for _ in range(rounds):
        shared, new = spark.sparkContext.broadcast(now), np.zeros(len(codes))
        with _small_batches(spark):
            got = graph.mapInArrow(near.one_round(shared, damping), "nodes binary, valences binary").toArrow()
        for node, valence in zip(*got.columns):
            new[np.frombuffer(node.as_buffer(), np.int32)] = np.frombuffer(valence.as_buffer(), np.float64)
        shared.unpersist()
        new[fixed] = now[fixed]
        moved, now = np.abs(new - now).max(initial=restless), new
        if moved < settled:
            break
    now[fixed] = 0.0        # the seeds come from their table, as some are in no pair
    found = nodes.mapInArrow(near.named_valences(spark.sparkContext.broadcast((codes, now)), FAINT), "word string, valence double")
    return found.unionByName(seeds.select("word", "valence"))


def _joined_rounds(edges: DataFrame, seeds: DataFrame, rounds: int, damping: float, settled: float) -> DataFrame:
    """The same with valences as a table, for more words than such an array may have."""
    now = seeds
    for _ in range(rounds):
        new = _kept(spread_once(edges, now, seeds, damping), "lexicon-round")
        moved = new.alias("x").join(now.alias("y"), "word", "left").agg(
            F.max(F.abs(F.col("x.valence") - F.coalesce("y.valence", F.lit(0.0))))).first()[0] or 0.0
        now = new
        if moved < settled:
            break
    return now


def induce(docs: DataFrame, seeds: DataFrame, text_col: str = "text", damping: float = DAMPING, settled: float = SETTLED) -> DataFrame:
    """The lexicon (word, valence, scalar, negation), as ``sentiment_scores`` takes it,
    of all words that the ``seeds(word, valence)`` reach with ``FAINT`` or more."""
    counted = _count(docs, text_col, REACH)
    seeds = _kept(seeds.groupBy("word").agg(F.max("valence").alias("valence")), "lexicon-seeds")
    high = seeds.agg(F.max(F.abs("valence"))).first()[0] or 0.0
    rounds = max(0, math.ceil(math.log(settled / max(high, settled)) / math.log(damping)))
    if counted.shared is None:
        pairs, nodes = _string_pairs(docs, counted.words, text_col, REACH, LEAST), None
    else:
        coded = _kept(_coded_pairs(docs, counted, text_col, REACH, LEAST), "lexicon-coded")
        pairs, nodes = _names(coded, counted, LEAST), _nodes(coded, counted, LEAST)
    if nodes is not None and nodes.count() <= MAX_NODES:
        now = _array_rounds(coded, nodes, counted.total, seeds, rounds, damping, settled)
    else:
        now = _joined_rounds(_kept(_weighed(pairs, counted.total), "lexicon-edges"), seeds, rounds, damping, settled)
    return now.where(F.abs("valence") >= FAINT).select("word", "valence", F.lit(0.0).alias("scalar"), F.lit(0).alias("negation"))
