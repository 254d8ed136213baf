"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries",
"sf"}.  Each query is fully materialised (written to a no-op sink) so the
whole plan runs; the session is warmed up by one small query first.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from eddy.plans.catalog import QUERIES  # noqa: E402
from eddy.session import build_session, scratch_conf  # noqa: E402

HEADLINE = [
    "report",                   # flagship: enrich (language, sentiment, keywords) + report
    "enriched",
    "keyword_ranking",
    "sentiment_score",
    "detect_language",
    "latency_report",
    "latency_report_tumbling",
    "consumer_stats",
    "epoch_to_iso",
    "partition_assign",
    "json_decode_double",
    "scan_comments",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", app="eddy-bench", shuffle_partitions=int(cpus) * 2,
                          extra={"spark.driver.memory": "16g", **scratch_conf()})
    QUERIES["stride_shard"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    times = {}
    for name in HEADLINE:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
