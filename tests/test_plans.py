"""Physical-plan checks: the plans that must hold at scale."""

import re

from conftest import SF
from eddy.plans.catalog import QUERIES


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_keyword_topk_limits_map_side(spark):
    p = _plan(QUERIES["keywords_top3"](spark, SF))
    assert "WindowGroupLimit" in p and "Partial" in p
    # partial aggregation before the (doc, word) shuffle
    assert re.search(r"HashAggregate\(keys=\[doc_id#\d+L, token#\d+\], functions=\[partial_count", p)


def test_scans_prune_columns(spark):
    p = _plan(QUERIES["consumer_stats"](spark, SF))
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", p)
    assert schemas and all("props" not in s and "user_id" not in s for s in schemas), schemas
    p = _plan(QUERIES["keyword_counts"](spark, SF))
    assert all("lang" not in s and "source" not in s for s in re.findall(r"ReadSchema: (struct<[^>]*>)", p))


def test_no_data_derived_broadcast_in_enrichment(spark):
    from eddy.operators import language as lg
    p = _plan(QUERIES["enriched"](spark, SF))
    # per-comment results meet in sort-merge joins; the only broadcasts are the
    # size-checked profile and the fixed lexicon
    assert p.count("SortMergeJoin") >= 2
    assert p.count("BroadcastExchange") <= 2
    assert lg.MAX_BROADCAST_VOCABULARY > 0


def test_no_single_partition_exchange_before_aggregation(spark):
    for key in ("keyword_counts", "sentiment_counts", "consumer_stats", "partition_counts"):
        p = _plan(QUERIES[key](spark, SF))
        assert "SinglePartition" not in p, key


def test_quantiles_neither_sort_the_input_nor_checkpoint(spark):
    for key in ("latency_report", "latency_report_tumbling"):
        p = _plan(QUERIES[key](spark, SF))
        assert "ExistingRDD" not in p and "rangepartitioning" not in p, key
