"""Sentence boundaries learnt from the texts themselves (the first half of T2).

A word with a period at its end closes a sentence unless it is an abbreviation,
an ellipsis, an ordinal number or an initial.  Which words are abbreviations is
learnt without labels, as in Kiss and Strunk (2006): a word that nearly always
comes with a period has a high log-likelihood ratio against the rate of periods
at large; the ratio is scaled by the word's length, inner periods and
occurrences without a period.  Pairs "word. next" that occur together more often
than by chance (initials and numbers with their followers) are collocations.  The
keyword tokenizer sees texts in lower case, so an initial or a number before a word
never closes a sentence.

Fitting counts the whitespace words as they stand, those with a period by the word
after them, in one pass over the texts (partial sums on the map side); the rest is plain
aggregates over those counts.  The fitted model is a pair of tables
that can be saved and loaded; scoring joins words with them on the word type,
broadcast up to a checked size and beyond that by a plain join in which words
without a period are spread out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eddy.functions.text import ALPHA_TOKEN, QUICK_SPLIT, WORD_END, english_stopwords, is_one_token, word_tokens
from eddy.session import scratch_path

# Published constants of the method.
ABBREVIATION = 0.3        # scaled ratio from which on a word is an abbreviation
PERIOD_RATE = 0.99        # of an abbreviation
COLLOCATION = 7.88        # ratio from which on a pair is a collocation
NUMBER = "##number##"

MAX_BROADCAST_ROWS = 400_000
MAX_BROADCAST_BYTES = 32 << 20
SPREAD = 1024             # keys that words without a period are spread over in a plain join

_OPENERS = r"""^[("'\[{<*_`“‘«]+"""
_CLOSERS = r"""[)"'\]}>*_`”’»,;:!?]+$"""


@dataclass(frozen=True)
class SentenceModel:
    """``types``: a row for each word type that occurs with a period; ``pairs``: a
    row for each pair of an initial or number with a period and its follower."""
    types: DataFrame
    pairs: DataFrame

    def save(self, path: str) -> None:
        """Write the model as a new version at ``path`` (which must not exist)."""
        self.types.write.parquet(f"{path}/types")
        self.pairs.write.parquet(f"{path}/pairs")

    @staticmethod
    def load(spark: SparkSession, path: str) -> SentenceModel:
        return SentenceModel(spark.read.parquet(f"{path}/types"), spark.read.parquet(f"{path}/pairs"))


def _core(word: Column) -> Column:
    """A word without brackets, quotes and marks around it; periods stay."""
    return F.regexp_replace(F.regexp_replace(word, _OPENERS, ""), _CLOSERS, "")


def _type(core: Column) -> Column:
    """Lower-cased word without its last period; numbers are one type."""
    bare = F.lower(F.regexp_replace(core, r"\.$", ""))
    return F.when(bare.rlike(r"^-?[.,]?[0-9][0-9,.-]*$"), NUMBER).otherwise(bare)


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, pos, word, next): whitespace words of whole texts, with the word after
    each (null after the last).  Texts that are null or blank have none."""
    base = docs.select(F.col(id_col).alias(id_col), F.filter(
        F.split(F.col(text_col), QUICK_SPLIT), lambda w: F.length(w) > 0).alias("_w"))
    # The outer form: the optimizer would split each text again to filter by size.
    return base.select(id_col, F.size("_w").alias("_n"), "_w", F.posexplode_outer("_w").alias("pos", "word")).where("word is not null").select(
        id_col, "pos", "word", F.when(F.col("pos") + 1 < F.col("_n"), F.element_at("_w", F.col("pos") + 2)).alias("next"))


def _period(word: Column) -> Column:
    """Whether a period ends the word; most words fail the first test."""
    return word.contains(".") & _core(word).rlike(r"[^.]\.$")


def _marked(w: DataFrame) -> DataFrame:
    """Words with whether a period ends them, and if so their type and the next one's."""
    w = w.withColumn("period", _period(F.col("word")))
    core, after = _core(F.col("word")), _core(F.col("next"))
    stop = (F.col("word").contains("?") | F.col("word").contains("!")) & F.col("word").rlike(WORD_END)
    return w.withColumns({
        "type": F.when(F.col("period"), _type(core)), "stop": stop,
        "next_type": F.when(F.col("period"), _type(after)), "next_letter": F.when(F.col("period"), after.rlike(r"^\p{L}"))})


def _ratio(both: Column, first: Column, second: Column, n: Column) -> Column:
    """Dunning's log-likelihood ratio of a pair against independence."""
    p, p1 = second / n, both / first
    p2 = F.when(n > first, (second - both) / (n - first)).otherwise(F.lit(0.0))

    def likely(k: Column, m: Column, q: Column) -> Column:
        hit = F.when(k == 0, F.lit(0.0)).otherwise(k * F.log(q))
        miss = F.when(m - k == 0, F.lit(0.0)).otherwise((m - k) * F.log(1 - q))
        return hit + miss
    out = 2 * (likely(both, first, p1) + likely(second - both, n - first, p2)
               - likely(both, first, p) - likely(second - both, n - first, p))
    return out


def seen_words(w: DataFrame) -> DataFrame:
    """(word, next, n): words as they stand, with the next one where there is a period
    in them (null for the others), and how often."""
    return w.groupBy("word", F.when(F.col("word").contains("."), F.col("next")).alias("next")).agg(F.count(F.lit(1)).alias("n"))


def period_counts(seen: DataFrame) -> DataFrame:
    """(type, n, with_period, capital): occurrences of each word type."""
    core = _core(F.col("word"))
    return seen.select(_type(core).alias("type"), F.col("n").alias("_n"), _period(F.col("word")).alias("period"), core.rlike(r"^\p{Lu}").alias("upper")).where(
        "type <> ''").groupBy("type").agg(
        F.sum("_n").alias("n"), F.sum(F.when(F.col("period"), F.col("_n")).otherwise(0)).alias("with_period"),
        F.max(F.col("upper").cast("int")).alias("capital"))


def abbreviations(counts: DataFrame) -> DataFrame:
    """(type, n, with_period, ratio, score, abbreviation) of the types that occur
    with a period.  The two totals are one row, read back while fitting."""
    total = counts.agg(F.sum("n").alias("n"), F.sum("with_period").alias("p")).first()
    n, p = float(total.n or 1), float(total.p or 0)
    a, ab = F.col("n").cast("double"), F.col("with_period").cast("double")
    rate = min(max(p / n, 1e-12), 1 - 1e-12)
    null = ab * F.log(F.lit(rate)) + (a - ab) * F.log(F.lit(1 - rate))
    alt = ab * F.log(F.lit(PERIOD_RATE)) + (a - ab) * F.log(F.lit(1 - PERIOD_RATE))
    ratio = F.round(-2 * (null - alt), 6)
    inner = F.regexp_count("type", F.lit(r"\.")) + 1
    letters = F.length("type") - inner + 1
    score = F.round(F.col("ratio") * F.exp(-letters) * inner * F.pow(letters.cast("double"), -(F.col("n") - F.col("with_period"))), 6)
    named = F.col("type").rlike(r"\p{L}")
    return counts.where("with_period > 0").withColumn("ratio", ratio).withColumn("score", score).select(
        "type", "n", "with_period", "capital", "ratio", "score", (named & (F.col("score") >= ABBREVIATION)).alias("abbreviation"))


def _is_initial(t: Column) -> Column:
    return t.rlike(r"^\p{L}$")


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> SentenceModel:
    """Learn abbreviations and collocations from whole texts.  Rows without a text
    add nothing; an empty table gives an empty model, under which every period at
    a word's end closes a sentence."""
    spark, w = docs.sparkSession, words(docs, id_col, text_col)
    path = scratch_path(spark, "sentence-model")
    # Stored, so that the expressions below run once a different word: a filter on one
    # would be pushed below the count, to every word.
    seen_words(w).write.parquet(f"{path}/seen")
    seen = spark.read.parquet(f"{path}/seen")
    counts = period_counts(seen)
    counts.write.parquet(f"{path}/counts")
    counts = spark.read.parquet(f"{path}/counts")
    pair = _marked(seen.where("next is not null")).where("period and next is not null and next_type <> ''").where(
        _is_initial(F.col("type")) | (F.col("type") == NUMBER)).groupBy("type", "next_type").agg(F.sum("n").alias("together"))
    side = counts.select("type", "n", "with_period")
    total = counts.agg(F.sum("n")).first()[0] or 1
    pair = pair.join(side.select("type", F.col("with_period").alias("first")), "type").join(
        side.select(F.col("type").alias("next_type"), F.col("n").alias("second")), "next_type")
    ratio = F.round(_ratio(*[F.col(c).cast("double") for c in ("together", "first", "second")], F.lit(float(total))), 6)
    often = F.col("together") / F.col("first") > F.col("second") / F.lit(float(total))
    pair = pair.withColumn("ratio", ratio).select(
        "type", "next_type", "together", "ratio", ((F.col("together") > 1) & often & (F.col("ratio") >= COLLOCATION)).alias("collocation"))
    model = SentenceModel(abbreviations(counts), pair)
    model.save(f"{path}/model")
    return SentenceModel.load(spark, f"{path}/model")


def _joined(rows: DataFrame, table: DataFrame, keys: list[str], place: list[str]) -> DataFrame:
    """Left join with a model table: broadcast if its measured size allows; in a plain
    join rows with a null key get keys of no type, spread by their ``place``."""
    size = sum((F.octet_length(k) for k in keys), F.lit(24))
    m = table.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("b")).first()
    if m.n <= MAX_BROADCAST_ROWS and m.b <= MAX_BROADCAST_BYTES:
        return rows.join(F.broadcast(table), keys, "left")
    none = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(*place), F.lit(SPREAD)).cast("string"))
    return rows.withColumn(keys[0], F.coalesce(keys[0], none)).join(table.hint("merge"), keys, "left")


def boundaries(docs: DataFrame, model: SentenceModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, pos, word, ends): whether each whitespace word closes a sentence.  The
    last word of a text always does."""
    rows = _marked(words(docs, id_col, text_col))      # only words with a period have a type and look up the model
    known = model.types.where("abbreviation").select("type", F.lit(True).alias("abbreviation"))
    rows = _joined(rows, known, ["type"], [id_col, "pos"])
    rows = _joined(rows, model.pairs.where("collocation").select("type", "next_type", F.lit(True).alias("collocation")),
                   ["type", "next_type"], [id_col, "pos"])
    short = _is_initial(F.col("type")) | (F.col("type") == NUMBER)
    open_ = F.coalesce("abbreviation", F.lit(False)) | F.coalesce("collocation", F.lit(False)) | (short & F.coalesce("next_letter", F.lit(False)))
    return rows.select(id_col, "pos", "word", (F.col("next").isNull() | F.col("stop") | (F.col("period") & ~open_)).alias("ends"))


def sentences(docs: DataFrame, model: SentenceModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, sentence, first, words): each sentence's number from 0, the position of
    its first word and its number of words."""
    b = boundaries(docs, model, id_col, text_col)
    before = Window.partitionBy(id_col).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    b = b.withColumn("sentence", F.coalesce(F.sum(F.col("ends").cast("int")).over(before), F.lit(0)).cast("int"))
    return b.groupBy(id_col, "sentence").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("words"))


def sentence_tokens(docs: DataFrame, model: SentenceModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, pos, sub, token): the tokens of every sentence, lower-cased: a period
    at the end of a word is a token of its own only where it closes a sentence, so
    "u.s." and "etc." stay one token inside it.  ``pos`` is the word's position,
    ``sub`` the token's place in the word."""
    b = boundaries(docs, model, id_col, text_col)
    word, low = F.col("word"), F.col("_low")
    toks = F.when(is_one_token(low), F.array(low)).when(F.col("ends"), word_tokens(word, True)).otherwise(word_tokens(word, False))
    return b.withColumn("_low", F.lower(word)).select(id_col, "pos", toks.alias("_t")).select(id_col, "pos", F.posexplode_outer("_t").alias("sub", "token")).where(
        "token is not null")


def sentence_terms(docs: DataFrame, model: SentenceModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, w, n, first_pos): term counts over sentence tokens, as in
    ``keywords.term_frequencies``; ``first_pos`` is (word, place in it)."""
    t = sentence_tokens(docs, model, id_col, text_col).where(F.col("token").rlike(ALPHA_TOKEN) & ~F.col("token").isin(list(english_stopwords())))
    return t.groupBy(id_col, F.col("token").alias("w")).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("pos", "sub")).alias("first_pos"))
