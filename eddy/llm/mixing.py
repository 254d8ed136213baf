"""Mix sources to target weights: capped water-filling and seeded sampling.

Main path: DataFrame functions only.  Sources get sizes (words) by a partial
and a final sum.  Water-filling repeats "share what is left by weight, stop the
sources above their cap" until none is above; each round reads two sums back,
whatever the number of sources.  A source's target then buys whole repetitions
of all its documents plus a fractional one: documents in the order of a seeded
hash, whole ones as long as they fit, and the boundary document in part.

The running sum that finds the boundary never sorts a source in one task: sizes
are first summed in 4096 hash buckets a source, the boundary bucket is found on
those sums, and only inside that bucket are documents put in order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eddy.llm.common import bounded, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
PERCENT = 150
MAX_EPOCHS = 2


def word_count(text: str):
    """Number of maximal runs of characters other than ASCII white space."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, percent: int = PERCENT, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sizes(source, source_size)`` to ``(source, source_size, target)``.

    Sources take the weights in code point order (null last), repeating; they
    share ``percent`` of all sizes; a target stops at ``max_epochs`` times its
    source's size and the rest shares the excess by weight.  If all sources are
    capped, every target is its cap.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))  # one row a source
    w = F.array(*[F.lit(float(x)) for x in weights])
    s = sizes.withColumn("_k", F.row_number().over(order) - 1).select(
        "source", "source_size", (F.col("source_size") * max_epochs).cast("double").alias("_cap"),
        F.element_at(w, (F.col("_k") % len(weights) + 1).cast("int")).alias("_w"))
    s = written(s, "mix-sources")
    total = s.agg(F.sum("source_size")).first()[0] or 0
    level, goal = 0.0, total * percent / 100
    while True:
        capped = F.col("_cap") <= F.col("_w") * F.lit(level)
        row = s.agg(F.sum(F.when(capped, F.col("_cap")).otherwise(0.0)).alias("cap"),
                    F.sum(F.when(~capped, F.col("_w")).otherwise(0.0)).alias("w")).first()
        if not row.w:
            break
        new = (goal - row.cap) / row.w
        if new <= level:
            break
        level = new
    return s.select("source", "source_size",
                    F.when(F.col("_w") * F.lit(level) >= F.col("_cap"), F.col("_cap"))
                    .otherwise(F.col("_w") * F.lit(level)).alias("target"))


def _key(id_col: str, seed: int):
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"))


def _plan(base: DataFrame, weights, percent: int, max_epochs: int) -> DataFrame:
    """For each source and hash bucket of ``base(_source, _size, _bucket)``: what
    the source gets, and where the bucket stands in its running sum."""
    buckets = written(base.groupBy(F.col("_source").alias("source"), "_bucket").agg(F.sum("_size").alias("_n")), "mix-buckets")
    t = targets(buckets.groupBy("source").agg(F.sum("_n").alias("source_size")), weights, percent, max_epochs)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    t = t.withColumn("_whole", F.floor(ratio).cast("long")).withColumn(
        "_quota", F.round(F.col("target") - F.col("_whole") * F.col("source_size")).cast("long")).withColumnRenamed("source", "_of")
    # Running sum over at most 4096 buckets of a source.
    over = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = buckets.withColumn("_before", F.coalesce(F.sum("_n").over(over), F.lit(0)))
    edge = (F.col("_before") < F.col("_quota")) & (F.col("_before") + F.col("_n") > F.col("_quota"))
    return written(starts.join(t, F.col("source").eqNullSafe(F.col("_of"))).select(
        F.col("source").alias("_s"), F.col("_bucket").alias("_b"), "_before", "source_size", "target", "_whole", "_quota",
        edge.alias("_edge")), "mix-plan")


def _taken(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows(..., _source, _size, _hash, _bucket)`` with source_size, target and
    taken.  Only the rows of a source's boundary bucket are put in order."""
    keep = [c for c in rows.columns if c not in ("_source", "_hash", "_bucket", "_tie")]
    both = rows.join(bounded(plan), F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_bucket") == F.col("_b")))
    whole = F.col("_whole") * F.col("_size")
    more = F.when(F.col("_before") < F.col("_quota"), F.col("_size")).otherwise(0)
    plain = both.where("not _edge").select(*keep, "source_size", "target", (whole + more).cast("long").alias("taken"))
    ties = [c for c in ("_tie",) if c in rows.columns]
    order = Window.partitionBy("_source", "_bucket").orderBy("_hash", "_size", *ties).rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("_quota") - F.col("_before") - F.coalesce(F.sum("_size").over(order), F.lit(0))
    part = F.greatest(F.lit(0), F.least(F.col("_size"), left))
    edges = both.where("_edge").select(*keep, "source_size", "target", (whole + part).cast("long").alias("taken"))
    return plain.unionByName(edges)


def _base(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int, *others) -> DataFrame:
    """The operator's own columns, whatever those of ``docs`` are called, and ``others``."""
    return docs.select(F.col(source_col).cast("string").alias("_source"), word_count(text_col).alias("_size"),
                       _key(id_col, seed).alias("_hash"), *others).withColumn("_bucket", F.substring("_hash", 1, 3))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, percent: int = PERCENT, max_epochs: int = MAX_EPOCHS, seed: int = 17) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every row of ``docs``.

    ``taken`` is the number of words the mix takes, repetitions counted; at
    most ``max_epochs`` times the size.  Null text: size 0; null source: a
    source of its own (last).  Null ids hash as an empty string.  Repeated rows
    are separate documents; among equal ids and sizes the rows are alike, so
    their order does not matter.  An empty table gives no rows.  Reruns agree:
    the hash depends on the seed and the id only.
    """
    base = written(_base(docs, id_col, text_col, source_col, seed, F.col(id_col).alias("doc_id")), "mix")
    return _taken(base, _plan(base, weights, percent, max_epochs)).select(
        "doc_id", F.col("_size").alias("size"), "source_size", "target", "taken")


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          weights=WEIGHTS, percent: int = PERCENT, max_epochs: int = MAX_EPOCHS, seed: int = 17) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as it is taken.  A source's
    boundary document comes once more with its first words only (white space
    between them kept).  Documents that are not taken, and those without words,
    are left out.  Columns as in ``docs``, whatever their names.  Rows that
    repeat an id and differ in their text stand in the order of a hash of it, so
    reruns agree.  An empty table gives no rows.
    """
    base = _base(docs, id_col, text_col, source_col, seed, F.struct("*").alias("_row"),
                 F.md5(F.col(text_col).cast("binary")).alias("_tie"))
    plan = _plan(base.select("_source", "_size", "_bucket"), weights, percent, max_epochs)
    rows = _taken(base, plan).where("taken > 0")
    whole = rows.where("taken >= _size").withColumn("_i", F.explode(F.sequence(F.lit(1), F.expr("int(taken div _size)"))))
    text = F.col("_row").getField(text_col)
    first = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(r"([\x20\x09-\x0D]*" + WORD + ")"), F.lit(1)),
                                 F.lit(1), (F.col("taken") % F.col("_size")).cast("int")), "")
    part = rows.where("taken % _size > 0").withColumn("_row", F.col("_row").withField(f"`{text_col}`", first))
    return whole.select("_row.*").unionByName(part.select("_row.*"))


# DuckDB statement for the rows of ``mix`` over ``documents`` (same constants).
ORACLE = r"""
WITH RECURSIVE base AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('17:' || coalesce(doc_id::VARCHAR, '')) AS key, substr(md5('17:' || coalesce(doc_id::VARCHAR, '')), 1, 3) AS bucket
  FROM documents),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM base GROUP BY source),
wt AS (
  SELECT source, source_size, 2.0::DOUBLE * source_size AS cap,
         ([3.0, 1.0, 2.0]::DOUBLE[])[((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::INT] AS w
  FROM src),
fill(k, level) AS (
  SELECT 0, 0::DOUBLE
  UNION ALL
  SELECT k + 1, nxt FROM (
    SELECT f.k, f.level,
           (SELECT ((SELECT sum(source_size)::BIGINT FROM src) * 150 / 100
                    - coalesce(sum(cap) FILTER (cap <= w * f.level), 0)) / sum(w) FILTER (cap > w * f.level) FROM wt) AS nxt
    FROM fill f) z
  WHERE nxt > level),
tgt AS (
  SELECT source, source_size, CASE WHEN w * l >= cap THEN cap ELSE w * l END AS target
  FROM wt, (SELECT max(level) AS l FROM fill) m),
q AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM tgt),
run AS (
  SELECT b.doc_id, b.size, q.source_size, q.target, q.whole,
         round(q.target - q.whole * q.source_size)::BIGINT AS quota,
         coalesce(sum(b.size) OVER (PARTITION BY b.source ORDER BY b.key, b.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM base b JOIN q ON b.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, size, source_size, target,
       (whole * size + greatest(0, least(size, quota - before)))::BIGINT AS taken
FROM run
"""
