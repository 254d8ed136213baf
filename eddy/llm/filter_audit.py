"""Filter interaction audit: every order of the filters, step by step.

Documents are first folded into mask cells: one bit a filter that the document
fails, so a part has at most 2^5 cells whatever its size.  A recursive CTE then
extends filter prefixes with unused letters; each level joins the part's cells,
carries the bits applied so far and emits that step's metrics.  Texts are read
once and never shuffled: copies meet by a 256-bit digest, already counted.
"""

from __future__ import annotations

from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eddy.llm.common import written

WORD = r"[^\x20\x09-\x0D]+"
LETTERS = "ABCDE"
COPY_BIT = 16             # E is decided across documents, A to D from the text alone
MIN_WORDS = 50
DISTINCT_PERCENT = 65
CAPITAL_PERCENT = 5
MARKS = r"[#$%&*|]"


def _text_mask(text: Column, words: Column) -> Column:
    """Bits of the filters A to D that a text fails."""
    fails = [F.size(words) < MIN_WORDS,
             100 * F.size(F.array_distinct(words)) < DISTINCT_PERCENT * F.size(words),
             100 * F.regexp_count(text, F.lit("[A-Z]")) > CAPITAL_PERCENT * F.length(text),
             text.rlike(MARKS)]
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))


def cells(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "source") -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part by the set of filters
    they fail, and how many of them are labelled good or toxic.

    Null texts count as empty, null parts as the empty string.  A document whose
    id is null has no smaller one and is none itself: it never fails E and makes
    no other fail.  Rows that repeat an id are separate documents; as copies they
    fail E together or not at all.  A document has a label if any of its label
    rows says 1.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       text.alias("text"), F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words"))
    rows = base.select("id", "part", F.unhex(F.sha2("text", 256)).alias("digest"),
                       _text_mask(F.col("text"), F.col("words")).alias("mask"))
    one = rows.groupBy("id", "part", "digest", "mask").agg(F.count(F.lit(1)).alias("n"))
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    one = one.join(known, "id", "left").na.fill(0, ["good", "toxic"])
    # An id occurs once in such a group, so n at the smallest id counts that id's rows.
    few = one.groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min("id").alias("low"), F.min_by("n", "id").alias("at_low"),
        F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("no_id"))
    first = F.min("low").over(Window.partitionBy("digest"))   # rows: the parts that hold the text
    passing = F.col("no_id") + F.when(F.col("low") == F.col("first"), F.col("at_low")).otherwise(0)
    split = few.withColumn("first", first).withColumn("ok", passing).select(
        "part", "good", "toxic", F.explode(F.array(
            F.struct(F.col("mask").alias("mask"), F.col("ok").alias("n")),
            F.struct((F.col("mask") + COPY_BIT).alias("mask"), (F.col("n") - F.col("ok")).alias("n")))).alias("c"))
    return split.where("c.n > 0").groupBy("part", F.col("c.mask").alias("mask")).agg(
        F.sum("c.n").alias("n"), F.sum(F.col("c.n") * F.col("good")).alias("good"),
        F.sum(F.col("c.n") * F.col("toxic")).alias("toxic"))


def steps(cell: DataFrame, letters: str = LETTERS) -> DataFrame:
    """(part, prefix, step, letter, kept, removed, ...): the metrics of applying
    the last letter of ``prefix`` after the ones before it, for every prefix of
    every order.  ``letters`` names the bits of ``mask`` from the lowest."""
    spark = cell.sparkSession
    parts = cell.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    parts = written(parts, "audit-cells")

    def total(value: str, condition: str) -> str:
        return f"aggregate(p.cells, 0L, (s, c) -> s + if({condition}, c.{value}, 0L))"

    here, before = "(c.mask & x.bit) <> 0", "(c.mask & x.applied)"
    bits = ", ".join(f"named_struct('letter', '{a}', 'bit', {1 << i})" for i, a in enumerate(letters))
    return spark.sql(f"""
        WITH RECURSIVE walk(part, prefix, applied, step, letter, kept, removed, redundant, unique_fails, good_lost, toxic_lost)
        MAX RECURSION LEVEL {len(letters) + 2} AS (
          SELECT part, '', 0, 0, '', 0L, 0L, 0L, 0L, 0L, 0L FROM {{parts}}
          UNION ALL
          SELECT x.part, concat(x.prefix, x.letter), x.applied | x.bit, x.step + 1, x.letter,
                 {total("n", "(c.mask & (x.applied | x.bit)) = 0")},
                 {total("n", f"{here} AND {before} = 0")},
                 {total("n", f"{here} AND {before} <> 0")},
                 {total("n", "c.mask = x.bit")},
                 {total("good", f"{here} AND {before} = 0")},
                 {total("toxic", f"{here} AND {before} = 0")}
          FROM (SELECT part, prefix, applied, step, l.letter AS letter, l.bit AS bit
                FROM (SELECT part, prefix, applied, step,
                             explode(filter(array({bits}), b -> (b.bit & applied) = 0)) AS l
                      FROM walk)) x
          JOIN {{parts}} p ON x.part = p.part)
        SELECT part, prefix, step, letter, kept, removed, redundant, unique_fails, good_lost, toxic_lost
        FROM walk LIMIT ALL""", parts=parts).where("step > 0")


def audit(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """One row per part, filter order and step, zeros included: ``part,
    filter_order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley``.  An empty table has no parts and gives no rows.
    Further columns of the inputs are not looked at."""
    walk = written(steps(cells(docs, labels, **columns)), "audit-steps")
    k = len(LETTERS)
    # A prefix of step s stands in (k - s)! orders.
    orders = F.element_at(F.array(*[F.lit(factorial(k - s)) for s in range(1, k + 1)]), F.col("step"))
    credit = walk.groupBy("part", "letter").agg(F.sum(F.col("removed") * orders).alias("shapley"))
    full = walk.where(F.col("step") == k).select("part", F.col("prefix").alias("filter_order"), F.explode(
        F.transform(F.sequence(F.lit(1), F.lit(k)), lambda s: F.substring("prefix", F.lit(1), s))).alias("prefix"))
    return full.join(walk, ["part", "prefix"]).join(credit, ["part", "letter"]).select(
        "part", "filter_order", F.col("step").cast("int").alias("step"), "kept", "removed", "redundant", "unique_fails",
        "good_lost", "toxic_lost", "shapley")


# DuckDB statement for the rows of ``audit`` over ``documents`` and ``labels``.
ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
f AS (
  SELECT w.doc_id, part,
         CASE WHEN len(words) < 50 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 2 ELSE 0 END
         + CASE WHEN 100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN w.doc_id > min(w.doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS mask,
         coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic
  FROM w LEFT JOIN (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic
                    FROM labels GROUP BY doc_id) l ON w.doc_id = l.doc_id),
cell AS (
  SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, mask),
letter(a, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
walk(prefix, applied, a, bit) AS (
  SELECT '', 0, '', 0
  UNION ALL
  SELECT prefix || l.a, applied + walk.bit, l.a, l.bit FROM walk, letter l WHERE instr(prefix, l.a) = 0),
s AS (
  SELECT part, prefix, a, length(prefix) AS step,
         coalesce(sum(n) FILTER (mask & (applied | bit) = 0), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & applied = 0), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & applied <> 0), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (mask & bit <> 0 AND mask & applied = 0), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (mask & bit <> 0 AND mask & applied = 0), 0)::BIGINT AS toxic_lost
  FROM walk, cell WHERE bit > 0 GROUP BY part, prefix, a),
o AS (
  SELECT s.*, p.prefix AS filter_order FROM s JOIN walk p ON length(p.prefix) = 5 AND starts_with(p.prefix, s.prefix))
SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, a))::BIGINT AS shapley
FROM o
"""
