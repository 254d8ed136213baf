"""Merkle manifest of a dataset: leaves, subroots by group, one root, proofs.

Every node carries the interval of leaf ranks it covers.  A node whose interval
is its whole group is a root of it and rises no further; the others meet in
runs of eight.  From the top down, each level's nodes join the level above on
the bucket of their intervals, with containment as the condition; what is left
of the parent's interval without the node's own are its siblings.  A leaf thus
gets its siblings up to the root from one join with its parent, which already
holds the rest of the way; whole paths are never shuffled a second time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eddy.llm.common import bounded, written
from eddy.session import cut_lineage

RUN = 8
HEX = 64                  # characters of a digest
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SIBLINGS = "array<struct<left: string, right: string>>"


def digest(*columns: Column) -> Column:
    """Lowercase hex SHA-256 of the concatenated strings."""
    return F.sha2(F.concat(*columns).cast("binary"), 256)


def leaf(*values: Column) -> Column:
    """Digest of the values, each ``-`` if null, else its UTF-8 length, ``:`` and itself."""
    def part(v: Column) -> Column:
        s = v.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return digest(*[part(v) for v in values])


def fold(start: Column, siblings: Column) -> Column:
    """The root that a leaf's digest and its siblings give."""
    return F.aggregate(siblings, start, lambda acc, s: digest(s["left"], acc, s["right"]))


def proof(siblings: Column) -> Column:
    """Digest of all siblings from the lowest level up, left to right."""
    return digest(F.array_join(F.transform(siblings, lambda s: F.concat(s["left"], s["right"])), ""))


def _ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """Number ``rows(g, ...)`` from 0 within each g, in order, without a task
    that holds a group: (lo, hi, size) with lo = hi the rank."""
    tagged = cut_lineage(rows.orderBy("g", *[F.col(c).asc_nulls_first() for c in order])).withColumns({
        "pid": F.spark_partition_id(),
        "row": F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)})
    # One row a partition, and one more where a partition goes on to the next group.
    ends = written(tagged.groupBy("g", "pid").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first")), "merkle-ends")
    before = Window.partitionBy("g").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("g", "pid", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"),
                       F.sum("n").over(Window.partitionBy("g")).alias("size"))
    rank = F.col("row") + F.col("shift")
    return tagged.join(bounded(ends), ["g", "pid"]).withColumns({"lo": rank, "hi": rank}).drop("pid", "row", "shift")


def _levels(leaves: DataFrame) -> list[DataFrame]:
    """The tree over ``leaves(g, lo, hi, size, digest, ...)``, lowest level first.
    Inner nodes hold the digests of their run as ``children``."""
    out = [leaves]
    while True:
        open_nodes = out[-1].where("hi - lo + 1 < size")
        if open_nodes.isEmpty():
            return out
        width = RUN ** len(out)
        run = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("lo", "digest"))), lambda s: s["digest"]), "")
        up = open_nodes.groupBy("g", F.expr(f"lo div {width}L").alias("bucket")).agg(
            F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.first("size").alias("size"), run.alias("children"))
        out.append(written(up.drop("bucket").withColumn("digest", digest(F.col("children"))), "merkle-level"))


def _paths(levels: list[DataFrame], tops: DataFrame | None) -> DataFrame:
    """Leaves with ``top`` (digest of their tree's root) and ``path``: siblings up
    to it, followed by the path of ``tops(g, path, root)`` where given."""
    above, carried = None, ["top"] if tops is None else ["top", "root"]
    for k in reversed(range(len(levels))):
        nodes = levels[k].alias("c")
        root = nodes.where("hi - lo + 1 = size").withColumn("top", F.col("digest"))
        if tops is None:
            root = root.withColumn("path", F.array().cast(SIBLINGS))
        else:
            root = root.join(tops, "g")
        if above is not None:
            width = RUN ** k
            p = above.select("g", F.col("lo").alias("p_lo"), F.col("hi").alias("p_hi"), F.col("children").alias("run"),
                             F.col("path").alias("p_path"), *[F.col(c).alias(f"p_{c}") for c in carried],
                             F.expr(f"lo div {width * RUN}L").alias("bucket"))
            inner = nodes.where("hi - lo + 1 < size").withColumn("bucket", F.expr(f"lo div {width * RUN}L")).join(
                p, ["g", "bucket"]).where("p_lo <= lo and hi <= p_hi")
            step = F.struct(
                F.expr(f"substring(run, 1, int({HEX} * ((lo - p_lo) div {width}L)))").alias("left"),
                F.expr(f"substring(run, int({HEX} * ((lo - p_lo) div {width}L + 1)) + 1)").alias("right"))
            inner = inner.withColumns({"path": F.concat(F.array(step), "p_path"), **{c: F.col(f"p_{c}") for c in carried}})
            root = root.unionByName(inner.select(*root.columns))
        above = root
    return above


def manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang", fields=FIELDS,
             others: dict[str, Column] | None = None) -> DataFrame:
    """(doc_id, leaf, subroot, root, siblings), and a column for each of
    ``others``, expressions over ``docs`` that are read in the same scan.

    ``siblings`` lists (left, right) digests from the leaf's run to the root's.
    Null values hash as ``-``; a null group is a group of its own, before all
    others; null ids stand before others of their group.  Rows that repeat an id
    are leaves of their own, ordered by digest.  A group of one leaf has that
    leaf as subroot, a single subroot is the root; an empty table gives no rows.
    """
    others = others or {}
    base = docs.select(
        F.col(id_col).alias("id"), leaf(*[F.col(c) for c in fields]).alias("digest"),
        F.coalesce(F.concat(F.lit("+"), F.col(group_col).cast("string")), F.lit("")).alias("g"),
        F.struct(F.lit(0).alias("_"), *[c.alias(k) for k, c in others.items()]).alias("others"))
    leaves = _ranked(written(base, "merkle-leaves"), ["id", "digest"])
    levels = _levels(written(leaves, "merkle-ranked"))
    subroots = levels[0].where("hi - lo + 1 = size").select("g", "digest")
    for level in levels[1:]:
        subroots = subroots.union(level.where("hi - lo + 1 = size").select("g", "digest"))
    over = _ranked(subroots.select(F.lit("").alias("g"), F.col("g").alias("of"), "digest"), ["of"])
    tops = _paths(_levels(written(over, "merkle-subroots")), None)
    tops = written(tops.select(F.col("of").alias("g"), F.col("path").alias("path"), F.col("top").alias("root")), "merkle-tops")
    return _paths(levels, tops).select(F.col("id").alias("doc_id"), F.col("digest").alias("leaf"),
                                       F.col("top").alias("subroot"), "root", F.col("path").alias("siblings"),
                                       *[F.col("others")[k].alias(k) for k in others])


def tamper_check(docs: DataFrame) -> DataFrame:
    """The manifest's digests, and what folding gives after tampering: texts of
    ids whose CRC-32 is divisible by 3 lose their capitals A-Z.  Documents whose
    id or text is null are left as they are."""
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    other = F.when(hit, leaf(*[low if c == "text" else F.col(c) for c in FIELDS]))
    m = manifest(docs, others={"tampered": other})
    return m.select("doc_id", "leaf", "subroot", "root", proof(F.col("siblings")).alias("proof_sha256"),
                    fold(F.coalesce("tampered", "leaf"), F.col("siblings")).alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))


# DuckDB statement for the rows of ``tamper_check`` over ``documents``.
ORACLE = r"""
WITH RECURSIVE tab AS (
  SELECT list_transform(range(256), lambda n: list_reduce(range(8),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS t),
base AS (
  SELECT doc_id, coalesce('+' || lang, '') AS g,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
         text, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
         xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
                         lambda h, b: xor(h >> 8, t[(xor(h, b) & 255) + 1]), 4294967295), 4294967295) % 3 = 0 AS hit
  FROM documents, tab),
leaf AS (
  SELECT doc_id, g, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         CASE WHEN hit THEN sha256(head || coalesce(strlen(low) || ':' || low, '-')) END AS other
  FROM base),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS m
  FROM leaf),
tree(g, k, i, d, m) AS (
  SELECT g, 0, i, leaf, m FROM ranked
  UNION ALL
  SELECT g, k + 1, i // 8, sha256(string_agg(d, '' ORDER BY i)), (m + 7) // 8 FROM tree WHERE m > 1 GROUP BY g, k, i // 8, m),
subroot AS (
  SELECT g AS of, d, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS m FROM tree WHERE m = 1),
over_tree(k, i, d, m) AS (
  SELECT 0, i, d, m FROM subroot
  UNION ALL
  SELECT k + 1, i // 8, sha256(string_agg(d, '' ORDER BY i)), (m + 7) // 8 FROM over_tree WHERE m > 1 GROUP BY k, i // 8, m),
node AS (
  SELECT * FROM tree WHERE m > 1 UNION ALL SELECT 'root', k, i, d, m FROM over_tree WHERE m > 1),
sib AS (
  SELECT g, k, i, m, coalesce(string_agg(d, '') OVER before, '') AS l, coalesce(string_agg(d, '') OVER after, '') AS r
  FROM node WINDOW before AS (PARTITION BY g, k, i // 8 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                   after AS (PARTITION BY g, k, i // 8 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
lower_way(doc_id, n, g, k, i, m, leaf, proof, fold) AS (
  SELECT doc_id, row_number() OVER (), g, 0, i, m, leaf, '', coalesce(other, leaf) FROM ranked
  UNION ALL
  SELECT w.doc_id, n, w.g, w.k + 1, w.i // 8, (w.m + 7) // 8, leaf, proof || l || r, sha256(l || fold || r)
  FROM lower_way w JOIN sib ON w.g = sib.g AND w.k = sib.k AND w.i = sib.i),
upper_way(doc_id, n, subroot, k, i, m, leaf, proof, fold) AS (
  SELECT w.doc_id, n, s.d, 0, s.i, s.m, leaf, proof, fold FROM lower_way w JOIN subroot s ON w.g = s.of WHERE w.m = 1
  UNION ALL
  SELECT w.doc_id, n, subroot, w.k + 1, w.i // 8, (w.m + 7) // 8, leaf, proof || l || r, sha256(l || fold || r)
  FROM upper_way w JOIN sib ON sib.g = 'root' AND w.k = sib.k AND w.i = sib.i)
SELECT w.doc_id, leaf, subroot, o.d AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = o.d AS verified
FROM upper_way w, (SELECT d FROM over_tree WHERE m = 1) o WHERE w.m = 1
"""
