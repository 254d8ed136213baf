"""Lexicon sentiment as a set-based Spark job.

Rules follow the published VADER description (Hutto and Gilbert, 2014):
each lexicon word contributes its valence; each of the three preceding
words that is not itself a valence word may boost it (+-0.293, damped by
1 / 0.95 / 0.9 with distance, sign following the valence) and may negate it
(x -0.74); valences before the first "but" are halved and those after it
scaled by 1.5; the sum gets the '!'/'?' emphasis in its own direction and
is normalised to ``s / sqrt(s^2 + 15)``.  The label is ``Positive`` when the
compound rounded to 4 places is >= 0 (neutral and blank are Positive).

Plan: words are exploded with their position and left-joined to the
(broadcast, size-checked) lexicon; only lexicon hits, "n't" words and "but"
are kept, plus one marker row per comment carrying the punctuation emphasis,
so every comment gets a score.  The three look-backs are one-position range
frames of a single window over those sparse rows, and the per-comment sum
reuses that window's partitioning (no extra exchange).  Each word's
contribution is summed in integer micro-units, so the result does not depend
on summation order.
"""

from __future__ import annotations

import csv
from functools import lru_cache
from importlib import resources

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eddy.functions.text import sentiment_words

# Published VADER rule constants.
BOOST_DAMPING = {1: 1.0, 2: 0.95, 3: 0.9}
NEGATION_SCALAR = -0.74
NORMALIZATION_ALPHA = 15.0
BUT_BEFORE, BUT_AFTER = 0.5, 1.5
EXCLAMATION_STEP, EXCLAMATION_MAX = 0.292, 4
QUESTION_STEP, QUESTION_CAP = 0.18, 0.96
CAPS_STEP = 0.733
# Published phrases with a valence of their own.
IDIOMS = {
    "the shit": 3.0, "the bomb": 3.0, "bad ass": 1.5, "badass": 1.5, "bus stop": 0.0, "yeah right": -2.0, "kiss of death": -1.5,
    "to die for": 3.0, "beating heart": 3.1, "broken heart": -2.9,
}

MAX_LEXICON_ROWS = 1_000_000
LEXICON_SCHEMA = T.StructType([
    T.StructField("word", T.StringType()),
    T.StructField("valence", T.DoubleType()),
    T.StructField("scalar", T.DoubleType()),
    T.StructField("negation", T.IntegerType()),
])


@lru_cache(maxsize=None)
def default_lexicon_rows() -> tuple[tuple[str, float, float, int], ...]:
    text = resources.files("eddy.data").joinpath("lexicon.csv").read_text("utf-8")
    lines = [ln for ln in text.splitlines() if ln.strip() and not ln.startswith("#")]
    rows = list(csv.DictReader(lines))
    return tuple((r["word"], float(r["valence"]), float(r["scalar"]), int(r["negation"])) for r in rows)


def lexicon(spark: SparkSession, table: DataFrame | None = None) -> DataFrame:
    """The lexicon table, hinted for a broadcast if its size allows and for a
    plain join otherwise."""
    if table is None:
        return F.broadcast(spark.createDataFrame(list(default_lexicon_rows()), LEXICON_SCHEMA))
    rows = table.select([F.col(f.name).cast(f.dataType) for f in LEXICON_SCHEMA.fields])
    return F.broadcast(rows) if table.count() <= MAX_LEXICON_ROWS else rows.hint("merge")


def punctuation_emphasis(text):
    """Emphasis added to |sum|: 0.292 per '!' (at most 4) plus, for more
    than one '?', 0.18 each up to 3 and 0.96 beyond."""
    ex = F.least(F.size(F.split(text, "!", -1)) - 1, F.lit(EXCLAMATION_MAX))
    qm = F.size(F.split(text, r"\?", -1)) - 1
    q = F.when(qm <= 1, F.lit(0.0)).when(qm <= 3, qm * F.lit(QUESTION_STEP)).otherwise(F.lit(QUESTION_CAP))
    return F.coalesce(ex * F.lit(EXCLAMATION_STEP) + q, F.lit(0.0))


def _louder(value, loud, signed: bool):
    """A valence grows away from zero; a booster's scalar, which takes the sign of the
    valence it meets, grows upwards."""
    step = _sign(value) * F.lit(CAPS_STEP) if signed else F.lit(CAPS_STEP)
    return F.when(loud & (value != 0), value + step).otherwise(value)


def is_caps(word):
    """A word with a cased letter and no lower-case one."""
    return (word == F.upper(word)) & (word != F.lower(word))


def idiom_matches(words: DataFrame, id_col: str, idioms: dict[str, float]) -> DataFrame:
    """(id, pos, len, valence): the phrases in ``words(id, pos, word)``, leftmost and
    of those the longest first, none overlapping.

    Phrases of each length meet the words' n-grams in an equi-join (the phrases are a
    parameter and small); a text's matches are few, and their overlaps are settled in
    one pass over them.
    """
    spark = words.sparkSession
    table = spark.createDataFrame([(p, len(p.split()), float(v)) for p, v in idioms.items()], "phrase string, len int, valence double")
    order = Window.partitionBy(id_col).orderBy("pos")
    found = None
    for n in sorted({len(p.split()) for p in idioms}):
        gram = F.concat_ws(" ", "word", *[F.lead("word", k).over(order) for k in range(1, n)])
        one = words.select(id_col, "pos", gram.alias("phrase")).join(F.broadcast(table.where(F.col("len") == n)), "phrase")
        found = one if found is None else found.unionByName(one)
    item = F.struct("pos", (-F.col("len")).alias("short"), "valence")
    seen = found.groupBy(id_col).agg(F.array_sort(F.collect_list(item)).alias("m"))
    start = F.struct(F.lit(-1).alias("end"), F.array().cast("array<struct<pos:int,len:int,valence:double>>").alias("kept"))

    def step(acc, m):
        taken = F.struct((m["pos"] - m["short"]).cast("int").alias("end"), F.concat(acc["kept"], F.array(F.struct(
            m["pos"].cast("int").alias("pos"), (-m["short"]).cast("int").alias("len"), m["valence"].alias("valence")))).alias("kept"))
        return F.when(m["pos"] >= acc["end"], taken).otherwise(acc)
    return seen.select(id_col, F.explode(F.aggregate("m", start, step)["kept"]).alias("k")).select(id_col, "k.*")


def _sign(x):
    return F.when(x < 0, F.lit(-1.0)).otherwise(F.lit(1.0))


def sentiment_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     lex: DataFrame | None = None, idioms: dict[str, float] | None = None, caps: bool = False) -> DataFrame:
    """(id, compound) for every input row; null text scores 0.

    With ``idioms`` (say ``IDIOMS``), a phrase counts as one word of its own valence at
    its first word's place, and the words in it don't count.  With ``caps``, a word in
    capitals weighs more in a text where some words are in capitals and some not.
    """
    spark = docs.sparkSession
    lx = lexicon(spark, lex)
    base = docs.select(id_col, F.col(text_col).alias("_t"))
    text = F.coalesce(F.col("_t"), F.lit(""))
    if not caps:
        # The outer form: the optimizer would split each text again to filter by size.
        words = base.select(id_col, F.posexplode_outer(F.filter(sentiment_words(text), lambda w: F.length(w) > 0)).alias("pos", "word")).where("word is not null")
        words = words.withColumn("loud", F.lit(False))
    else:
        cased = base.select(id_col, F.filter(sentiment_words(text, lower=False), lambda w: F.length(w) > 0).alias("_w"))
        loud = F.size(F.filter("_w", is_caps))
        words = cased.withColumn("_mixed", (loud > 0) & (loud < F.size("_w"))).select(id_col, "_mixed", F.posexplode("_w").alias("pos", "_c"))
        words = words.select(id_col, "pos", F.lower("_c").alias("word"), (F.col("_mixed") & is_caps(F.col("_c"))).alias("loud"))
    phrases = None
    if idioms:
        phrases = idiom_matches(words, id_col, idioms)
        inside = phrases.select(id_col, F.explode(F.sequence(F.col("pos"), F.col("pos") + F.col("len") - 1)).alias("pos"))
        words = words.join(inside.hint("merge"), [id_col, "pos"], "left_anti")
    hits = (words.join(lx, "word", "left")
            .select(id_col, "pos",
                    _louder(F.coalesce("valence", F.lit(0.0)), F.col("loud"), True).alias("valence"),
                    _louder(F.coalesce("scalar", F.lit(0.0)), F.col("loud"), False).alias("scalar"),
                    ((F.coalesce("negation", F.lit(0)) == 1) | F.col("word").contains("n't")).alias("neg"),
                    (F.col("word") == "but").alias("is_but"),
                    F.lit(0.0).alias("emph"))
            .where((F.col("valence") != 0) | (F.col("scalar") != 0) | F.col("neg") | F.col("is_but")))
    markers = base.select(id_col, F.lit(None).cast("int").alias("pos"), F.lit(0.0).alias("valence"),
                          F.lit(0.0).alias("scalar"), F.lit(False).alias("neg"), F.lit(False).alias("is_but"),
                          punctuation_emphasis(F.col("_t")).alias("emph"))
    rows = hits.unionByName(markers)
    if phrases is not None:
        rows = rows.unionByName(phrases.where("valence <> 0").select(
            id_col, "pos", "valence", F.lit(0.0).alias("scalar"), F.lit(False).alias("neg"), F.lit(False).alias("is_but"),
            F.lit(0.0).alias("emph")))

    by_pos = Window.partitionBy(id_col).orderBy("pos")
    whole = Window.partitionBy(id_col)
    modifier = (F.col("valence") == 0)
    cols = {"first_but": F.min(F.when(F.col("is_but"), F.col("pos"))).over(whole)}
    for d in (1, 2, 3):
        frame = by_pos.rangeBetween(-d, -d)
        cols[f"s{d}"] = F.coalesce(F.max(F.when(modifier, F.col("scalar"))).over(frame), F.lit(0.0))
        cols[f"n{d}"] = F.coalesce(F.max(F.when(modifier & F.col("neg"), F.lit(1))).over(frame), F.lit(0))
    looked = rows.select("*", *[c.alias(k) for k, c in cols.items()])

    v = F.col("valence")
    for d in (1, 2, 3):
        s = F.col(f"s{d}") * F.lit(BOOST_DAMPING[d])
        v = (v + _sign(v) * s) * F.when(F.col(f"n{d}") == 1, F.lit(NEGATION_SCALAR)).otherwise(F.lit(1.0))
    but = (F.when(F.col("first_but").isNull(), F.lit(1.0))
           .when(F.col("pos") < F.col("first_but"), F.lit(BUT_BEFORE))
           .when(F.col("pos") > F.col("first_but"), F.lit(BUT_AFTER))
           .otherwise(F.lit(1.0)))
    micro = F.when(F.col("valence") != 0, F.round(v * but * F.lit(1e6)).cast("long")).otherwise(F.lit(0).cast("long"))
    per_doc = looked.groupBy(id_col).agg(F.sum(micro).alias("_s"), F.max("emph").alias("_e"))
    s = F.col("_s") / F.lit(1e6)
    s = F.when(s > 0, s + F.col("_e")).when(s < 0, s - F.col("_e")).otherwise(s)
    compound = F.round(s / F.sqrt(s * s + F.lit(NORMALIZATION_ALPHA)), 4)
    return per_doc.select(id_col, compound.alias("compound"))


def sentiment_label(compound):
    """>= 0 -> Positive, else Negative (no neutral class)."""
    return F.when(compound >= 0, F.lit("Positive")).otherwise(F.lit("Negative"))


def analyze_sentiment(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      lex: DataFrame | None = None) -> DataFrame:
    """(id, compound, sentiment)."""
    sc = sentiment_scores(docs, id_col, text_col, lex)
    return sc.select(id_col, "compound", sentiment_label(F.col("compound")).alias("sentiment"))
