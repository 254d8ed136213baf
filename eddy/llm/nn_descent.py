"""Approximate nearest neighbours: NN-descent and greedy graph search.

Build.  Distinct vectors start with the best neighbours inside the leaves of a
few random-hyperplane trees.  Then, round by round, Spark joins bring the
neighbours and reverse neighbours of each vector together; any two of them are
neighbours of neighbours, and a pair closer than one's worst neighbour replaces
it.  Two links that met in an earlier round don't meet again, and vectors whose
links are all old bring no one together.  Rounds go on until few lists change;
lists only get better, so they end.  Vectors travel whole, packed without
loss, and distances are computed in double precision.

Search.  A beam of the nearest vectors found so far starts at the query's own
place in the graph.  Each round joins the beam's unexpanded vectors with the
graph, scores the new ones on the original vectors and keeps the best ``BEAM``;
it ends when nothing in the beam is left to expand (a vector leaves the beam for
good, so it ends).

Every vector length has trees of its own.  Their hyperplanes come from a seed and
the length; the thresholds are medians of ``SAMPLE`` vectors for the ``FITTED``
commonest lengths and zero for others.  Every vector is indexed.  Equal vectors are one node; for each, the ``top + 1`` smallest
ids stand for its rows, more can't be among the ``top`` nearest of a query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eddy.llm.common import BROADCAST_ENTRIES, bounded, written
from eddy.llm.embedding_dedup import keyed, matrix

NEIGHBOURS = 20    # list length
TREES = 4
LEAF = 400         # vectors in a leaf, about
SAMPLE = 1000      # vectors that fit the trees' thresholds
FITTED = 16        # lengths whose thresholds are fitted
SETTLED = 0.02     # share of changed list places that ends the rounds
PER_JOIN = 6       # improvements of one vector that one meeting reports
BEAM = 128


def _pack(vec: list[float]) -> bytes:
    """A vector without loss: a letter, then float32 where that holds every
    component, else float64."""
    x = np.array(vec, dtype=np.float64)
    with np.errstate(over="ignore"):
        y = x.astype(np.float32)
    return b"f" + y.tobytes() if (x == y).all() else b"d" + x.tobytes()


def _unpack(packed: list[bytes]) -> np.ndarray:
    """Vectors of one length as a float64 matrix."""
    kinds = {p[:1] for p in packed}
    if len(kinds) == 1:
        raw = np.frombuffer(b"".join(packed), dtype=np.uint8).reshape(len(packed), -1)
        return raw[:, 1:].copy().view(np.float32 if kinds == {b"f"} else np.float64).astype(np.float64)
    return np.array([np.frombuffer(p, dtype=np.float32 if p[:1] == b"f" else np.float64, offset=1) for p in packed], dtype=np.float64)


def _nearest(x: np.ndarray, rows: slice, k: int, old: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Of each of these rows of x, the places and squared distances of the k
    nearest other rows.  Products (after centring) choose, differences score.  Two
    ``old`` rows are infinitely far from each other."""
    c = x - x.mean(axis=0)
    own = c[rows]
    d = (own * own).sum(1)[:, None] + (c * c).sum(1) - 2 * (own @ c.T)
    d[np.arange(len(d)), rows.start + np.arange(len(d))] = np.inf
    if old is not None:
        d[np.ix_(old[rows], old)] = np.inf
    near = np.argpartition(d, k - 1, axis=1)[:, :k]
    got = np.empty(near.shape)
    for i in range(k):
        left = x[rows] - x[near[:, i]]
        got[:, i] = (left * left).sum(1)
    got[np.isinf(np.take_along_axis(d, near, 1))] = np.inf
    return near, got


def _sent(queries: DataFrame) -> DataFrame:
    """Broadcast (q, cq) by its bytes; leave a larger table to a plain join."""
    n = queries.agg(F.coalesce(F.sum(F.length("cq")), F.lit(0)).alias("n")).first().n
    return F.broadcast(queries) if n <= 4 * BROADCAST_ENTRIES else queries


def _best(lists: DataFrame, by: str, keep: int) -> DataFrame:
    """The ``keep`` rows of smallest d for each ``by`` (a partial limit runs
    before the shuffle)."""
    w = Window.partitionBy(by).orderBy("d", "v" if by == "u" else "u")
    return lists.withColumn("_r", F.row_number().over(w)).where(f"_r <= {keep}").drop("_r")


def _edges(out) -> pa.RecordBatch:
    cols = [np.concatenate(c) if c else np.empty(0) for c in zip(*out)] if out else [np.empty(0)] * 3
    return pa.RecordBatch.from_arrays([pa.array(cols[0].astype(np.int64)), pa.array(cols[1].astype(np.int64)),
                                       pa.array(cols[2].astype(np.float64))], names=["u", "v", "d"])


def _planes(seed: int, depth: int, dim: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).normal(size=(depth, dim))


def _leaves(nodes: DataFrame, seed: int) -> DataFrame:
    """(u, v, d) of the best neighbours inside the leaves of random trees."""
    cuts = {}
    depth = F.greatest(F.lit(0), F.least(F.lit(62), F.ceil(F.log2(F.col("c") / LEAF)))).cast("int")
    lengths = written(nodes.groupBy("dim").agg(F.count(F.lit(1)).alias("c")).withColumn("depth", depth), "nn-lengths")
    for r in lengths.orderBy(F.desc("c"), "dim").limit(FITTED).collect():
        few = nodes.where(F.col("dim") == r["dim"]).orderBy(F.xxhash64("key"), "key").limit(SAMPLE).select("vec").collect()
        x = np.array([v.vec for v in few])
        cuts[r["dim"]] = [np.median(x @ _planes(seed + t, r["depth"], r["dim"]).T, axis=0) for t in range(TREES)]
    counted = nodes.select("key", "dim", "vec").join(bounded(lengths), "dim")

    def leaf(batches):
        planes: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            rows = []
            for k, d, v, depth in zip(*(batch.column(n).to_pylist() for n in ("key", "dim", "vec", "depth"))):
                v = np.array(v)
                for t in range(TREES):
                    if (d, t) not in planes:
                        if len(planes) > 4 * FITTED * TREES:
                            planes.clear()
                        planes[d, t] = _planes(seed + t, depth, d)
                    bits = planes[d, t] @ v > (cuts[d][t] if d in cuts else 0.0)
                    rows.append((k, d, t, int(sum(1 << i for i, b in enumerate(bits) if b))))
            cols = zip(*rows) if rows else ((),) * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["key", "dim", "tree", "leaf"])

    placed = written(counted.mapInArrow(leaf, "key long, dim long, tree long, leaf long"), "nn-leaves")
    sizes = placed.groupBy("dim", "tree", "leaf").agg(F.ceil(F.count(F.lit(1)) / (2 * LEAF)).alias("parts"))
    dealt = (placed.join(bounded(sizes), ["dim", "tree", "leaf"]).withColumn("part", F.pmod(F.hash("key", "tree"), F.col("parts")))
             .join(nodes.select("key", "packed"), "key"))

    def solve(table: pa.Table) -> pa.Table:
        keys, x = table["key"].to_numpy(), _unpack(table["packed"].to_pylist())
        out, k = [], min(NEIGHBOURS, len(keys) - 1)
        for a in range(0, len(keys) if k > 0 else 0, 512):
            near, d = _nearest(x, slice(a, a + 512), k)
            out.append((np.repeat(keys[a:a + 512], k), keys[near].ravel(), d.ravel()))
        return pa.Table.from_batches([_edges(out)])

    return dealt.groupBy("dim", "tree", "leaf", "part").applyInArrow(solve, "u long, v long, d double")


def _meet(graph: DataFrame, nodes: DataFrame) -> DataFrame:
    """(u, v, d) closer than u's worst neighbour, among neighbours and reverse
    neighbours of some vector, at least one of the two being a new link."""
    links = graph.select(F.col("u").alias("w"), F.col("v").alias("key"), "old").union(
        _best(graph, "v", NEIGHBOURS).select(F.col("v").alias("w"), F.col("u").alias("key"), "old"))
    links = written(links.groupBy("w", "key").agg(F.min("old").alias("old")), "nn-meet")
    links = links.join(links.where("old = 0").select("w").distinct(), "w", "left_semi")
    worst = graph.groupBy(F.col("u").alias("key")).agg(
        F.when(F.count(F.lit(1)) >= NEIGHBOURS, F.max("d")).otherwise(F.lit(float("inf"))).alias("worst"))
    state = nodes.select("key", "packed").join(worst, "key", "left").withColumn(
        "worst", F.coalesce("worst", F.lit(float("inf"))))
    rows = links.join(state, "key")
    rows = rows.select("w", "key", "packed", "worst", "old").repartition("w").sortWithinPartitions("w")

    def solve(keys, packed, worst, old):
        near, got = _nearest(_unpack(packed), slice(0, len(keys)), min(PER_JOIN, len(keys) - 1), old > 0)
        i, j = np.nonzero(got < worst[:, None])
        return keys[i], keys[near[i, j]], got[i, j]

    def run(batches):
        held: list = [[], [], [], []]
        at = None
        for batch in batches:
            w = batch.column("w").to_numpy()
            cuts = [0, *(np.flatnonzero(w[1:] != w[:-1]) + 1).tolist(), len(w)]
            cols = [batch.column("key").to_numpy(), batch.column("packed").to_pylist(), batch.column("worst").to_numpy(),
                    batch.column("old").to_numpy()]
            out = []
            for a, b in zip(cuts[:-1], cuts[1:]):
                if b == a:
                    continue
                if w[a] != at:
                    if len(held[1]) > 1:
                        out.append(solve(np.concatenate(held[0]), held[1], *map(np.concatenate, held[2:])))
                    held, at = [[], [], [], []], w[a]
                held[0].append(cols[0][a:b])
                held[1] = held[1] + cols[1][a:b]
                held[2].append(cols[2][a:b])
                held[3].append(cols[3][a:b])
            yield _edges(out)
        yield _edges([solve(np.concatenate(held[0]), held[1], *map(np.concatenate, held[2:]))] if len(held[1]) > 1 else [])

    return rows.mapInArrow(run, "u long, v long, d double")


def build(nodes: DataFrame, seed: int = 11) -> DataFrame:
    """Neighbour graph (u, v, d squared) of ``nodes(key, dim, vec, packed)``."""
    graph = written(_best(_leaves(nodes, seed).groupBy("u", "v").agg(F.min("d").alias("d")), "u", NEIGHBOURS)
                    .withColumn("old", F.lit(0)), "nn-graph")
    places = nodes.count() * NEIGHBOURS
    while True:
        both = graph.withColumn("old", F.lit(1)).unionByName(_meet(graph, nodes).withColumn("old", F.lit(0)))
        both = both.groupBy("u", "v").agg(F.min("d").alias("d"), F.max("old").alias("old"))
        graph = written(_best(both, "u", NEIGHBOURS), "nn-graph")
        if graph.where("old = 0").count() <= SETTLED * places:
            return graph.drop("old")


def _scored(pairs: DataFrame, nodes: DataFrame, queries: DataFrame) -> DataFrame:
    """(q, v) to (q, v, d): squared distances of the original vectors."""
    rows = (pairs.join(nodes.select(F.col("key").alias("v"), F.col("packed").alias("cv")), "v")
            .join(_sent(queries.select(F.col("key").alias("q"), F.col("packed").alias("cq"))), "q"))

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                cq, cv = batch.column("cq").to_pylist(), batch.column("cv").to_pylist()
                d = np.zeros(len(cq))
                by: dict[tuple[int, int], list[int]] = {}
                for i, c in enumerate(zip(cq, cv)):
                    by.setdefault((len(c[0]), len(c[1])), []).append(i)
                for at in by.values():
                    for a in range(0, len(at), 2048):
                        part = at[a:a + 2048]
                        x = _unpack([cq[i] for i in part]) - _unpack([cv[i] for i in part])
                        d[part] = (x * x).sum(1)
                yield pa.RecordBatch.from_arrays([batch.column("q"), batch.column("v"), pa.array(d)], names=["q", "v", "d"])

    return rows.mapInArrow(run, "q long, v long, d double")


def search(graph: DataFrame, nodes: DataFrame, queries: DataFrame) -> DataFrame:
    """(q, v, d): the beam of each query node, greedy search over the graph."""
    near = graph.select("u", "v").union(_best(graph, "v", NEIGHBOURS).select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct()
    near = written(near, "nn-links")
    beam = queries.select(F.col("key").alias("q"), F.col("key").alias("v"), F.lit(0.0).alias("d"), F.lit(False).alias("done"))
    beam = written(beam, "nn-beam")
    while True:
        front = beam.where("not done").select("q", F.col("v").alias("u"))
        if front.isEmpty():
            return beam
        fresh = front.join(near, "u").select("q", "v").distinct().join(beam.select("q", "v"), ["q", "v"], "left_anti")
        fresh = _scored(fresh, nodes, queries).withColumn("done", F.lit(False))
        w = Window.partitionBy("q").orderBy("d", "v")
        both = beam.withColumn("done", F.lit(True)).unionByName(fresh)
        beam = written(both.withColumn("_r", F.row_number().over(w)).where(f"_r <= {BEAM}").drop("_r"), "nn-beam")


def nearest(df: DataFrame, every: int = 100, top: int = 10, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows whose id ``every`` divides:
    their ``top`` nearest other rows found, by Euclidean distance in double
    precision, ties to smaller ids.

    Vectors that are null, empty, zero or hold null or non-finite components,
    and rows without an id, take no part; vectors of another length are no
    candidates.  A row is not its own candidate, but an equal vector under
    another id is; repeated ids count once.  An empty table gives no rows.
    """
    rows = keyed(df, id_col, vec_col).where("key is not null and vec_id is not null").dropDuplicates(["vec_id", "key"])
    rows = written(rows, "nn-rows")

    def pack(batches):
        for batch in batches:
            packed = [_pack(v) for v in batch.column("vec").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("dim"), batch.column("vec"),
                                              pa.array(packed, pa.binary())], names=["key", "dim", "vec", "packed"])

    nodes = rows.groupBy("key").agg(F.first("vec").alias("vec")).select("key", F.size("vec").cast("long").alias("dim"), "vec")
    nodes = written(nodes.mapInArrow(pack, "key long, dim long, vec array<double>, packed binary"), "nn-nodes")
    asked = rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), F.col("key").alias("q"))
    queries = written(nodes.join(asked.select(F.col("q").alias("key")).distinct(), "key", "left_semi"), "nn-queries")
    beam = search(build(nodes), nodes, queries)
    found = (beam.select("q", "v").join(nodes.select(F.col("key").alias("v"), F.col("vec").alias("x")), "v")
             .join(bounded(queries.select(F.col("key").alias("q"), F.col("vec").alias("y")), "y"), "q"))
    exact = found.select("q", "v", F.sqrt(F.aggregate(
        F.zip_with("x", "y", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)).alias("score"))
    ids = Window.partitionBy("key").orderBy("vec_id")
    members = (rows.select("key", "vec_id").distinct().withColumn("_r", F.row_number().over(ids)).where(f"_r <= {top + 1}")
               .select(F.col("key").alias("v"), "vec_id"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (exact.join(members, "v").join(asked, "q").where("vec_id <> query_id")
            .groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
            .withColumn("rank", F.row_number().over(order)).where(f"rank <= {top}")
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
