"""Embedding near-dedup: int8 tile products with error bounds.

Equal vectors are one class.  Classes are dealt into blocks of a bounded size
by a hash, and every pair of blocks is a tile.  In a tile, unit vectors are
quantised to int8 with a scale each; for u = s q + e the product of two unit
vectors differs from ``s1 s2 q1.q2`` by at most ``|e1| + |e2| + |e1||e2|``.  Pairs
that this bound can't rule out are computed again in double precision.

A tile gives back a count for each vector and one edge for each member of a
component inside the tile, never its pairs, so a group of thousands of near
copies costs rows in proportion to its size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eddy.llm.common import components, written

BLOCK = 4096       # classes in a block
STRIPE = 256       # rows of a tile product at a time
THRESHOLD = 0.9


def usable(vec: str):
    """Whether a vector has only finite components, at least one not zero."""
    v = F.col(vec)
    return F.coalesce((F.size(v) > 0) & F.forall(v, lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False))) & F.exists(v, lambda x: x != 0), F.lit(False))


def keyed(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, vec array<double>, key): key is a 64-bit hash of the vector, null
    where it takes no part."""
    vec = F.transform(F.col(vec_col), lambda x: x.cast("double") + F.lit(0.0))
    frame = df.select(F.col(id_col).alias("vec_id"), vec.alias("vec"))
    return frame.withColumn("key", F.when(usable("vec"), F.xxhash64("vec")))


def matrix(column: pa.Array) -> np.ndarray:
    """The rows of a list column, all of one length, as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def units(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def quantised(u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Int8 codes, scales and error lengths of unit vectors."""
    scale = np.abs(u).max(axis=1) / 127
    codes = np.rint(u / scale[:, None]).astype(np.int8)
    left = u - codes * scale[:, None]
    return codes, scale, np.sqrt((left * left).sum(axis=1)) + 1e-12


def tile_links(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Which unit vectors of a and b have a product of at least ``threshold``."""
    qa, sa, ea = quantised(a)
    qb, sb, eb = quantised(b)
    # Products of int8 sums stay exact in float32 up to about a thousand components.
    kind = np.float32 if a.shape[1] * 127 * 127 < 1 << 24 else np.float64
    right = qb.astype(kind).T
    hits = np.zeros((len(a), len(b)), dtype=bool)
    for k in range(0, len(a), STRIPE):
        s = slice(k, k + STRIPE)
        # product >= (threshold - bound) / (scales), in one precision with a margin for rounding
        need = ((threshold - 1e-6 - (ea[s, None] + eb + ea[s, None] * eb)) / (sa[s, None] * sb)).astype(np.float32)
        i, j = np.nonzero(qa[s].astype(kind) @ right >= need)
        for m in range(0, len(i), 1 << 16):
            x, y = i[m:m + (1 << 16)], j[m:m + (1 << 16)]
            hits[k + x, y] = np.einsum("ij,ij->i", a[k + x], b[y]) >= threshold
    return hits


def forest(hits: np.ndarray) -> list[tuple[int, int, int]]:
    """(row, side, member) for each component: side 0 are rows, 1 are columns;
    the first row of a component stands for it."""
    out, left = [], hits.any(axis=1)
    for r in np.flatnonzero(left).tolist():
        if not left[r]:
            continue
        cols, rows = hits[r].copy(), np.zeros(len(hits), dtype=bool)
        rows[r], new = True, cols
        while new.any():
            more = hits[:, new].any(axis=1) & ~rows
            rows |= more
            new = hits[more].any(axis=0) & ~cols if more.any() else np.zeros_like(cols)
            cols |= new
        left &= ~rows
        out += [(r, 0, m) for m in np.flatnonzero(rows).tolist()] + [(r, 1, m) for m in np.flatnonzero(cols).tolist()]
    return out


def near_groups(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``df``.

    Two vectors link when their cosine, in double precision, is at least
    ``threshold``.  Vectors that are null, empty, zero or hold null or non-finite
    components link with nothing and are components of their own; vectors of
    different lengths never link.  Rows may repeat ids.  A null id counts as a
    vector but names no component: such a row takes the smallest other id it
    reaches.  An empty table gives no rows.
    """
    spark = df.sparkSession
    rows = written(keyed(df, id_col, vec_col), "near-rows")
    classes = written(rows.where("key is not null").groupBy("key").agg(
        F.first("vec").alias("vec"), F.count(F.lit(1)).alias("c"), F.min("vec_id").alias("low")).withColumn("dim", F.size("vec")),
        "near-classes")
    sizes = classes.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    dealt = classes.join(F.broadcast(sizes), "dim").withColumn("own", F.pmod(F.hash("key"), F.col("blocks")))
    tiles = dealt.select("dim", "key", "c", "vec", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        "dim", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        (F.col("own") <= F.col("other")).alias("left"), "key", "c", "vec")

    def solve(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        one = table["i"][0].as_py() == table["j"][0].as_py()
        left = np.array(table["left"].to_pylist())
        keys, counts = table["key"].to_numpy(), table["c"].to_numpy()
        u = units(matrix(table["vec"].combine_chunks()))
        x = np.flatnonzero(left)
        y = x if one else np.flatnonzero(~left)
        out: list[tuple[int, int, int]] = []
        if len(x) and len(y):
            hits = tile_links(u[x], u[y], threshold)
            if one:
                np.fill_diagonal(hits, False)
            for at, n in ((x, hits @ counts[y]), (y, counts[x] @ hits)) if not one else ((x, hits @ counts[x]),):
                out += [(int(k), int(v), None) for k, v in zip(keys[at], n) if v]
            sides = (keys[x], keys[y])
            out += [(int(keys[x[r]]), None, int(sides[s][m])) for r, s, m in forest(hits)]
        cols = list(zip(*out)) if out else [(), (), ()]
        return pa.table([pa.array(c, pa.int64()) for c in cols], names=["a", "n", "b"])

    found = written(tiles.groupBy("dim", "i", "j").applyInArrow(solve, "a long, n long, b long"), "near-found")
    links = found.where("n is not null").groupBy(F.col("a").alias("key")).agg(F.sum("n").alias("n"))
    root = components(spark, found.where("b is not null").select("a", "b")).withColumnRenamed("node", "key")
    named = (classes.select("key", "c", "low").join(root, "key", "left").join(links, "key", "left")
             .withColumn("root", F.coalesce("root", "key")))
    name = named.groupBy("root").agg(F.min("low").alias("component_id"))
    label = named.join(name, "root").select(
        F.col("key").alias("_key"), (F.coalesce("n", F.lit(0)) + F.col("c") - 1).alias("n_links"), "component_id")
    got = rows.select("vec_id", "key").join(label, F.col("key") == F.col("_key"), "left")
    return got.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).cast("long").alias("component_id")
                      ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))

