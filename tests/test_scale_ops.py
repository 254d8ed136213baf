"""Distributed rank and exact quantiles against pandas, including a hot group."""

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from eddy.operators.quantiles import exact_quantiles
from eddy.operators.ranking import global_rank
from eddy.sources.topic import consumer_for_partition, stride_shard


def test_global_rank_equals_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 1000).alias("n"), F.col("id").cast("string").alias("k"))
    got = global_rank(df.repartition(7), [F.desc("n"), F.asc("k")])
    want = df.withColumn("want", F.row_number().over(Window.orderBy(F.desc("n"), F.asc("k"))))
    j = got.join(want, ["n", "k"])
    assert j.count() == 5000 and j.where(F.col("rank") != F.col("want")).count() == 0


def test_exact_quantiles_match_pandas_with_hot_group(spark):
    rng = np.random.default_rng(7)
    g = np.where(rng.random(6000) < 0.34, "hot", rng.choice(["a", "b", "c", "d"], 6000))
    pdf = pd.DataFrame({"g": g, "v": rng.exponential(100.0, 6000).round(3)})
    pdf.loc[::97, "v"] = np.nan
    got = exact_quantiles(spark.createDataFrame(pdf).repartition(5), ["g"], "v", [0.5, 0.95, 0.99]).toPandas()
    want = pdf.groupby("g")["v"].quantile([0.5, 0.95, 0.99]).unstack()
    for _, r in got.iterrows():
        for q, c in [(0.5, "p50"), (0.95, "p95"), (0.99, "p99")]:
            assert abs(r[c] - want.loc[r["g"], q]) < 1e-9


def test_quantiles_of_a_large_hot_group_with_a_common_value(spark):
    """Large enough for the sketch's band; a third of the rows share one value,
    which is the 95th percentile of one group; one group's key is null."""
    n = 120_000
    rng = np.random.default_rng(3)
    v = np.where(rng.random(n) < 0.34, 250.0, rng.exponential(100.0, n))
    pdf = pd.DataFrame({"g": np.where(rng.random(n) < 0.6, "hot", None), "v": v})
    df = spark.createDataFrame(pdf).repartition(6)
    got = {r["g"]: r for r in exact_quantiles(df, ["g"], "v", [0.05, 0.5, 0.95, 0.99]).collect()}
    assert set(got) == {"hot", None}
    for g, part in (("hot", pdf[pdf.g == "hot"]), (None, pdf[pdf.g.isna()])):
        for q, c in [(0.05, "p5"), (0.5, "p50"), (0.95, "p95"), (0.99, "p99")]:
            assert abs(got[g][c] - part["v"].quantile(q)) < 1e-9, (g, q)
    whole = exact_quantiles(df, [], "v", [0.0, 0.95, 1.0]).collect()[0]
    for q, c in [(0.0, "p0"), (0.95, "p95"), (1.0, "p100")]:
        assert abs(whole[c] - pdf["v"].quantile(q)) < 1e-9


def test_quantiles_of_nothing(spark):
    none = spark.createDataFrame([], "g string, v double")
    assert exact_quantiles(none, [], "v", [0.95]).count() == 0
    assert exact_quantiles(none, ["g"], "v", [0.95]).count() == 0


def test_whole_input_quantiles(spark):
    pdf = pd.DataFrame({"v": [5.0, 1.0, 3.0, 2.0, 4.0]})
    got = exact_quantiles(spark.createDataFrame(pdf), [], "v", [0.95]).collect()[0]
    assert abs(got["p95"] - pdf["v"].quantile(0.95)) < 1e-12


def test_stride_shards_disjoint_and_cover(spark):
    df = spark.range(0, 1001).withColumnRenamed("id", "row_index")
    parts = [set(r.row_index for r in stride_shard(df, 3, k).collect()) for k in range(3)]
    assert sum(len(p) for p in parts) == 1001 and set().union(*parts) == set(range(1001))


def test_uneven_partitions_each_read_once(spark):
    df = spark.range(0, 5).select(F.col("id").cast("int").alias("p"))
    got = {r.p: r.c for r in df.select("p", consumer_for_partition(F.col("p"), 5, 2).alias("c")).collect()}
    assert got == {0: "consumer_0", 1: "consumer_0", 2: "consumer_1", 3: "consumer_1", 4: "consumer_1"}
    got = {r.p: r.c for r in df.select("p", consumer_for_partition(F.col("p"), 5, 10).alias("c")).collect()}
    assert got == {p: f"consumer_{p}" for p in range(5)}
