"""Language identification: naive Bayes over character trigrams.

Training (``train_profile``) counts trigrams per labelled language and stores
add-one smoothed log-probabilities in integer micro-units (sums are exact
and order-independent):

    lp(L, g)  = ln((c(L,g) + 1) / (T_L + V))      for trigrams seen in L
    lp0(L)    = ln(1 / (T_L + V))                 floor for unseen ones

Scoring a comment (``detect``) over its trigrams g in the vocabulary, with
counts n(g), for every language L of the model:

    score(L) = sum_g n(g) * lp(L, g)      (lp0(L) where g was not seen in L)

The best score wins, ties by language code.  Blank text, or text without a
known trigram, is 'unknown'.

Plan: the profile has one row a trigram, with the languages that know it and what
each gains over its floor.  Its size is measured: up to a bound in rows and bytes it
is broadcast and each trigram is scored as it comes; beyond, trigram counts per
comment are pre-aggregated and sort-merge joined.  With few languages the broadcast
profile has a column for each, so a trigram is one row from the scan to the partial sum
by comment; ``detect`` then sums a text's gains in its own task, in arrays, so that a
comment is one row.  With more, gains are summed by (comment, language) with a partial sum on the map side, and the best language is a partial and
final minimum, so the number of languages is not bounded.  A language that shares no
trigram with a comment stays at its floor; of those only the one with the highest
floor can win, so it is the only one that is looked at.

N-grams of up to ``MAX_CODED`` letters are numbers in those arrays (a digit a letter);
training counts them so as well, a row for each n-gram and language in a slice of texts.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eddy.functions.fields import with_default
from eddy.session import checkpoint_root, scratch_path

# Tasks get the helpers below with the function that calls them, so executors need not
# have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MICRO = 1_000_000
# Largest profile that is broadcast: in trigrams, and in bytes (about 40 a trigram
# plus 24 for each language that knows it).
MAX_BROADCAST_VOCABULARY = 2_000_000
MAX_BROADCAST_BYTES = 128 << 20
MAX_WIDE = 16              # languages up to which the broadcast profile has a column for each
MAX_LANGUAGES = 100_000    # rows of the floors' table up to which it is broadcast
MAX_CODED = 3              # letters of an n-gram that is a number
MAX_DENSE = 1 << 22        # numbers up to which a plain array holds something for each
SLICE_BYTES = 2 << 20      # bytes of texts that are numbered at a time
WINDOW = 1 << 20           # n-grams that are looked up at a time, however long a text


def normalized_letters(text: Column) -> Column:
    """Lower-case letters with every other run collapsed to one space,
    padded with a space on both sides (word boundaries become trigrams)."""
    return F.concat(F.lit(" "), F.regexp_replace(F.lower(text), r"[^\p{L}]+", " "), F.lit(" "))


# Every overlapping 3-character window, found in one left-to-right regex pass
# (a zero-width lookahead match at each position).  Substring by character
# position would rescan the UTF-8 text from its start for every position.
SIZES = (3,)


def trigrams(docs: DataFrame, id_col: str, text_col: str, sizes=SIZES) -> DataFrame:
    """(id, g): the character n-grams of whole texts (trigrams by default).  Rows
    without any letter (null, blank, punctuation only) have none."""
    t = docs.where(F.col(text_col).rlike(r"\p{L}")).select(
        id_col, normalized_letters(F.col(text_col)).alias("_t"))
    grams = [F.regexp_extract_all(F.col("_t"), F.lit(f"(?=(.{{{n}}}))"), 1) for n in sizes]
    return t.select(id_col, F.explode(grams[0] if len(grams) == 1 else F.concat(*grams)).alias("g"))


def trigram_counts(docs: DataFrame, id_col: str, text_col: str, sizes=SIZES) -> DataFrame:
    """(id, g, n): n-gram counts per row."""
    return trigrams(docs, id_col, text_col, sizes).groupBy(id_col, "g").agg(F.count(F.lit(1)).alias("n"))


def _lettered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.where(F.col(text_col).rlike(r"\p{L}")).select(id_col, normalized_letters(F.col(text_col)).alias("_t"))


def _slices(batches, most_bytes: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Slices of (id, text) batches: the ids, all texts' letters as code points, and
    where each text begins (one more entry ends the last)."""
    for batch in batches:
        size = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False))
        cuts = np.unique(np.append(np.searchsorted(size, np.arange(0, size[-1] if len(size) else 0, most_bytes)), len(size)))
        for a, b in zip(cuts[:-1], cuts[1:]):
            texts = batch.column(1).slice(a, b - a).to_pylist()
            letters = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
            yield batch.column(0).slice(a, b - a), letters, np.append(0, np.cumsum([len(t) for t in texts]))


def _numbered(letters: np.ndarray, ends: np.ndarray, digit: np.ndarray, base: int, n: int) -> np.ndarray:
    """The number of the n-gram that begins at each letter, -1 where its text ends before
    the n-gram does or a letter has no digit; ``ends``: of each letter's text."""
    m = max(0, len(letters) - n + 1)
    digits = digit[letters].astype(np.int32 if base ** n < 1 << 31 else np.int64)
    out, ok = digits[:m].copy(), np.arange(n, m + n) <= ends[:m]
    for k in range(1, n):
        out *= base
        out += digits[k:m + k]
    unknown = digits < 0
    if unknown.any():
        for k in range(n):
            ok &= ~unknown[k:m + k]
    out[~ok] = -1
    return out


def _digits(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different letters in order, and the place of each code point among them (else -1)."""
    seen = np.zeros(0x110000, dtype=bool)
    seen[letters] = True
    alphabet = np.flatnonzero(seen)
    digit = np.full(0x110000, -1, dtype=np.int32)
    digit[alphabet] = np.arange(len(alphabet))
    return alphabet, digit


def _spelled(codes: np.ndarray, alphabet: np.ndarray, n: int) -> list[str]:
    points = np.stack([alphabet[codes // len(alphabet) ** (n - 1 - k) % len(alphabet)] for k in range(n)], axis=1)
    whole = points.astype(np.uint32).tobytes().decode("utf-32-le")
    return [whole[i:i + n] for i in range(0, len(whole), n)]


def label_counts(labelled: DataFrame, key_col: str, text_col: str, sizes=SIZES) -> DataFrame:
    """(key, g, n): n-gram counts of few or many keys, as ``trigram_counts`` gives them.
    N-grams are counted slice by slice of the texts, so a slice's different n-grams are
    rows and not its letters."""
    if max(sizes) > MAX_CODED:
        return trigram_counts(labelled, key_col, text_col, sizes)

    def run(batches):
        for keys, letters, starts in _slices(batches, SLICE_BYTES):
            key = keys.dictionary_encode()
            of = np.repeat(key.indices.to_numpy(), np.diff(starts))
            ends = np.repeat(starts[1:], np.diff(starts))
            alphabet, digit = _digits(letters)
            for n in sorted(set(sizes)):
                code = _numbered(letters, ends, digit, len(alphabet), n)
                at = np.flatnonzero(code >= 0)
                code, label = code[at].astype(np.int64), of[at].astype(np.int64)
                if len(key.dictionary) * len(alphabet) ** n <= MAX_DENSE:
                    count = np.bincount(label * len(alphabet) ** n + code)
                    both = np.flatnonzero(count)
                    count, label, code = count[both], both // len(alphabet) ** n, both % len(alphabet) ** n
                else:
                    grams, place = np.unique(code, return_inverse=True)
                    both, count = np.unique(label * len(grams) + place, return_counts=True)
                    label, code = both // max(1, len(grams)), grams[both % max(1, len(grams))]
                yield pa.RecordBatch.from_arrays([
                    key.dictionary.take(pa.array(label)), pa.array(_spelled(code, alphabet, n), pa.string()),
                    pa.array(count * list(sizes).count(n), pa.int64())], names=[key_col, "g", "n"])
    rows = _lettered(labelled, key_col, text_col).mapInArrow(run, T.StructType([
        labelled.schema[key_col], T.StructField("g", T.StringType()), T.StructField("n", T.LongType())]))
    return rows.groupBy(key_col, "g").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class LanguageProfile:
    """A fitted profile: ``table(lang, g, c, lp, lp0)``, the ``languages(lang, lp0)``
    with their floor log-probability, the sizes of the n-grams, and two measures of
    the table (distinct n-grams, rows) that decide how it is joined."""
    table: DataFrame
    languages: DataFrame
    sizes: tuple[int, ...] = SIZES
    vocabulary: int = 0
    rows: int = 0

    def save(self, path: str) -> None:
        """Write the profile as a new version at ``path`` (which must not exist)."""
        self.table.write.parquet(f"{path}/table")
        self.languages.write.parquet(f"{path}/languages")
        spark = self.table.sparkSession
        spark.createDataFrame([(list(self.sizes), self.vocabulary, self.rows)], "sizes array<int>, vocabulary long, rows long") \
            .coalesce(1).write.parquet(f"{path}/about")

    @staticmethod
    def load(spark: SparkSession, path: str) -> LanguageProfile:
        about = spark.read.parquet(f"{path}/about").first()
        return LanguageProfile(spark.read.parquet(f"{path}/table"), spark.read.parquet(f"{path}/languages"),
                               tuple(about.sizes), about.vocabulary, about.rows)


def train_profile(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text", sizes=SIZES,
                  path: str | None = None) -> LanguageProfile:
    """Fit the profile from labelled rows (log-probs in micro-units) and save it at
    ``path`` (a fresh folder of the session's scratch space by default).

    Nothing of the size of the labels comes to the driver: totals are a table.
    Rows without a label or a letter add nothing; without any the profile is empty.
    """
    spark = labelled.sparkSession
    path = path or scratch_path(spark, "language-profile")
    src = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()) \
                  .select(F.col(lang_col).alias("_k"), F.col(text_col).alias("_text"))
    label_counts(src, "_k", "_text", sizes).select(F.col("_k").alias("lang"), "g", F.col("n").alias("c")) \
        .write.parquet(f"{path}/counts")
    counts = spark.read.parquet(f"{path}/counts")
    size = counts.agg(F.count_distinct("g").alias("v"), F.count(F.lit(1)).alias("n")).first()
    totals = counts.groupBy("lang").agg((F.sum("c") + size.v).alias("d"))
    floors = totals.select("lang", "d", F.round(F.log(1.0 / F.col("d").cast("double")) * MICRO).cast("long").alias("lp0"))
    floors.write.parquet(f"{path}/totals")
    floors = spark.read.parquet(f"{path}/totals")
    small = floors.count() <= MAX_LANGUAGES
    table = counts.join(F.broadcast(floors) if small else floors.hint("merge"), "lang").select(
        "lang", "g", "c",
        F.round(F.log((F.col("c") + 1).cast("double") / F.col("d").cast("double")) * MICRO).cast("long").alias("lp"), "lp0")
    LanguageProfile(table, floors.select("lang", "lp0"), tuple(sizes), size.v, size.n).save(f"{path}/profile")
    return LanguageProfile.load(spark, f"{path}/profile")


def saved_profile(spark: SparkSession, labelled_path: str, lang_col: str = "lang", text_col: str = "text",
                  sizes=SIZES, root: str | None = None) -> LanguageProfile:
    """The profile of a labelled Parquet table, fitted once for each state of its
    files and loaded from ``root`` (below the checkpoint folder) after that.

    The name of a version is a digest of the files' names, sizes and times.  Fitting
    ends by writing the version's name; half-written versions are never loaded, and
    two drivers that fit at once write versions of their own.
    """
    root = (root or f"{checkpoint_root(spark)}/eddy-models/language").rstrip("/")
    src = spark.read.parquet(labelled_path)
    files = src.select(F.struct("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").alias("f"))
    state = files.groupBy("f").agg(F.count(F.lit(1)).alias("n")).agg(
        F.bit_xor(F.xxhash64("f")).alias("a"), F.sum("n").alias("n"), F.bit_xor(F.xxhash64("n", "f")).alias("b")).first()
    key = f"{lang_col}-{text_col}-{'_'.join(map(str, sizes))}-{state.a}-{state.b}-{state.n}"
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{key}")
    fs = fs_path.getFileSystem(spark._jsc.hadoopConfiguration())
    for done in sorted(str(f.getPath()) for f in fs.listStatus(fs_path)) if fs.exists(fs_path) else ():
        if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{done}/profile/about/_SUCCESS")):
            return LanguageProfile.load(spark, f"{done}/profile")
    return train_profile(src.select(text_col, lang_col), lang_col, text_col, sizes, f"{root}/{key}/{uuid.uuid4().hex}")


def _few_languages(profile: LanguageProfile) -> list:
    """The languages of a profile that may be broadcast with a column for each, or none."""
    if (0 < profile.vocabulary <= MAX_BROADCAST_VOCABULARY
            and profile.vocabulary * (40 + 8 * MAX_WIDE) <= MAX_BROADCAST_BYTES):
        few = profile.languages.limit(MAX_WIDE + 1).collect()
        return few if len(few) <= MAX_WIDE else []
    return []


def _wide_table(profile: LanguageProfile, languages: list) -> DataFrame:
    """(g, _x0, _x1, ...): each n-gram's gain over the floor in every language."""
    return profile.table.groupBy("g").agg(*[
        F.sum(F.when(F.col("lang") == r.lang, F.col("lp") - F.col("lp0")).otherwise(0)).alias(f"_x{i}")
        for i, r in enumerate(languages)])


def _text_gains(docs: DataFrame, profile: LanguageProfile, languages: list, id_col: str, text_col: str) -> DataFrame:
    """(id, _n, _x0, _x1, ...): the number of known n-grams and their gains, a row for
    each text that has one.  The profile is broadcast as arrays."""
    sizes, names = list(profile.sizes), ["_n"] + [f"_x{i}" for i in range(len(languages))]
    known = _wide_table(profile, languages).toArrow()       # of a checked size
    grams = known["g"].to_pylist()
    alphabet, _ = _digits(np.frombuffer("".join(grams).encode("utf-32-le"), np.uint32))
    gains = np.stack([np.ones(len(grams), dtype=np.int64), *[known[c].to_numpy() for c in names[1:]]])
    shared = docs.sparkSession.sparkContext.broadcast((grams, alphabet, gains))

    def tables(grams, alphabet, gains) -> dict:
        """For each size: how to find an n-gram's place, and the gains by place, which
        end in nothing for unknown ones."""
        out, size = {}, np.array([len(g) for g in grams])
        digit = _digits(alphabet)[1]
        for n in sorted(set(sizes)):
            of = np.flatnonzero(size == n)
            letters = np.frombuffer("".join(grams[i] for i in of).encode("utf-32-le"), np.uint32).reshape(-1, n)
            code = sum((digit[letters[:, k]].astype(np.int64) * len(alphabet) ** (n - 1 - k) for k in range(n)), np.zeros(len(of), dtype=np.int64))
            order = np.argsort(code)
            gain = np.concatenate([gains[:, of[order]], np.zeros((len(gains), 1), dtype=np.int64)], axis=1) * sizes.count(n)
            place = None
            if len(alphabet) ** n < MAX_DENSE:
                place = np.full(len(alphabet) ** n + 1, len(of), dtype=np.int32)     # the last one: -1
                place[code[order]] = np.arange(len(of))
            out[n] = code[order], place, gain
        return out

    def run(batches):
        grams, alphabet, gains = shared.value
        digit, table = _digits(alphabet)[1], tables(grams, alphabet, gains)
        for ids, letters, starts in _slices(batches, SLICE_BYTES):
            sums = np.zeros((len(gains), len(ids)), dtype=np.int64)
            for a in range(0, len(letters), WINDOW):
                b = min(a + WINDOW, len(letters))
                first, last = np.searchsorted(starts, a, "right") - 1, np.searchsorted(starts, b, "left")
                part, near = starts[first:last + 1], letters[a:b + MAX_CODED - 1]
                ends = np.repeat(part[1:], np.diff(np.clip(part, a, b + MAX_CODED - 1)))
                ends = np.append(ends, np.full(len(near) - len(ends), a)) - a      # beyond the last text: never looked at
                for n, (codes, place, gain) in table.items():
                    code = _numbered(near, ends, digit, len(alphabet), n)[:b - a]
                    if place is None:
                        at = np.minimum(np.searchsorted(codes, code), max(0, len(codes) - 1))
                        at = np.where(codes[at] == code, at, len(codes)) if len(codes) else at
                    else:
                        at = place[code]
                    at = np.append(at, np.full(b - a - len(at), len(codes)))
                    for k in range(len(gain)):
                        sums[k, first:last] += np.add.reduceat(gain[k][at], np.maximum(part[:-1], a) - a)
            found = np.flatnonzero(sums[0])
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(found)), *[pa.array(x[found]) for x in sums]], names=[id_col, *names])
    return _lettered(docs, id_col, text_col).mapInArrow(run, T.StructType([
        docs.schema[id_col], *[T.StructField(c, T.LongType()) for c in names]]))


def _wide_scores(docs: DataFrame, profile: LanguageProfile, languages: list, id_col: str, text_col: str) -> DataFrame:
    """``candidate_scores`` with the profile broadcast, a column a language.  A gain is
    positive where the language knows the n-gram, so its sum tells who shares one."""
    per_g = _wide_table(profile, languages)
    per = trigrams(docs, id_col, text_col, profile.sizes).join(F.broadcast(per_g), "g").groupBy(id_col).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(f"_x{i}").alias(f"_x{i}") for i in range(len(languages))])
    best = min(languages, key=lambda r: (-r.lp0, r.lang))
    each = F.array(*[F.struct(F.lit(r.lang).alias("lang"), (F.col("_n") * F.lit(r.lp0) + F.col(f"_x{i}")).alias("score"),
                              ((F.col(f"_x{i}") > 0) | F.lit(r.lang == best.lang)).alias("in")) for i, r in enumerate(languages)])
    return per.select(id_col, F.explode(each).alias("_e")).where("_e.in").select(id_col, "_e.lang", "_e.score")


def candidate_scores(docs: DataFrame, profile: LanguageProfile, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang, score): for rows with a known n-gram, every language that shares
    one, and the language with the highest floor."""
    few = _few_languages(profile)
    if few:
        return _wide_scores(docs, profile, few, id_col, text_col)
    gain = F.struct("lang", (F.col("lp") - F.col("lp0")).alias("gain"), "lp0")
    per_g = profile.table.groupBy("g").agg(F.collect_list(gain).alias("_l"))
    if (0 < profile.vocabulary <= MAX_BROADCAST_VOCABULARY
            and profile.vocabulary * 40 + profile.rows * 24 <= MAX_BROADCAST_BYTES):
        # Scores add up, so each n-gram meets the profile as it comes.
        tri = trigrams(docs, id_col, text_col, profile.sizes).withColumn("n", F.lit(1).cast("long")).join(F.broadcast(per_g), "g")
    else:
        tri = trigram_counts(docs, id_col, text_col, profile.sizes).join(profile.table.select("g", F.array(gain).alias("_l")).hint("merge"), "g")
    # Rows of the floor: how many known n-grams a comment has, under a null language.
    own = F.struct(F.lit(None).cast("string").alias("lang"), F.lit(1).cast("long").alias("gain"), F.lit(None).cast("long").alias("lp0"))
    if profile.vocabulary <= MAX_BROADCAST_VOCABULARY and profile.vocabulary * 40 + profile.rows * 24 <= MAX_BROADCAST_BYTES:
        known = tri.select(id_col, "n", F.explode(F.concat(F.array(own), "_l")).alias("_x"))
    else:
        once = trigram_counts(docs, id_col, text_col, profile.sizes).join(
            profile.table.select("g").distinct().hint("merge"), "g", "left_semi")
        known = tri.select(id_col, "n", F.explode("_l").alias("_x")).unionByName(once.select(id_col, "n", own.alias("_x")))
    sums = known.groupBy(id_col, F.col("_x.lang").alias("lang")).agg(
        F.sum(F.col("n") * F.col("_x.gain")).alias("x"), F.max("_x.lp0").alias("lp0"))
    # One row a comment brings its number of n-grams and all its gains together.
    per = sums.groupBy(id_col).agg(
        F.max(F.when(F.col("lang").isNull(), F.col("x"))).alias("_n"),
        F.collect_list(F.when(F.col("lang").isNotNull(), F.struct("lang", "x", "lp0"))).alias("_l"))
    top = profile.languages.orderBy(F.desc("lp0"), "lang").limit(1).collect()      # one row
    if not top:
        return per.select(id_col, F.lit(None).cast("string").alias("lang"), F.col("_n").alias("score")).where("false")
    best = F.lit(top[0]["lang"])
    floor = F.struct(best.alias("lang"), F.lit(0).cast("long").alias("x"), F.lit(top[0]["lp0"]).cast("long").alias("lp0"))
    hits = F.when(F.exists("_l", lambda e: e["lang"] == best), F.col("_l")).otherwise(F.concat("_l", F.array(floor)))
    rows = per.select(id_col, "_n", F.explode(hits).alias("_e")).select(id_col, "_n", "_e.*")
    return rows.select(id_col, "lang", (F.col("_n") * F.col("lp0") + F.col("x")).alias("score"))


def detect(docs: DataFrame, profile: LanguageProfile, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(id, detected) for rows with at least one known n-gram: the highest score,
    on equal scores the earlier code."""
    few = _few_languages(profile) if max(profile.sizes) <= MAX_CODED else []
    if few:
        # Texts with the same id (null is one as well) are one comment.
        gains = _text_gains(docs, profile, few, id_col, text_col)
        per = gains.groupBy(id_col).agg(*[F.sum(c).alias(c) for c in gains.columns if c != id_col])
        each = [F.struct((-(F.col("_n") * F.lit(r.lp0) + F.col(f"_x{i}"))).alias("s"), F.lit(r.lang).alias("l")) for i, r in enumerate(few)]
        return per.select(id_col, F.array_min(F.array(*each))["l"].alias("detected"))
    scores = candidate_scores(docs, profile, id_col, text_col)
    best = F.min(F.struct((-F.col("score")).alias("s"), F.col("lang").alias("l")))
    return scores.groupBy(id_col).agg(best.alias("_b")).select(id_col, F.col("_b.l").alias("detected"))


def posterior(docs: DataFrame, profile: LanguageProfile, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang, score, posterior): candidates' scores, and their probabilities
    under equal priors, normalised over the candidates (others are at their floor)."""
    scores = candidate_scores(docs, profile, id_col, text_col)
    per = Window.partitionBy(id_col)
    odds = F.exp((F.col("score") - F.max("score").over(per)) / F.lit(float(MICRO)))
    rows = scores.withColumn("_o", odds)
    return rows.select(id_col, "lang", "score", F.round(F.col("_o") / F.sum("_o").over(per), 6).alias("posterior"))


def detect_language(docs: DataFrame, profile: LanguageProfile, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(id, language) for every row: detection, or 'unknown' (P2)."""
    det = detect(docs, profile, id_col, text_col)
    # Blank text has no trigram, so it has no detection; only ids are joined
    # (the text is not shuffled again).
    return docs.select(id_col).join(det.hint("merge"), id_col, "left").select(
        id_col, with_default(F.col("detected"), "unknown").alias("language"))
