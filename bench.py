"""Headline queries on one machine; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS
(default 2: the median counts, after one warm-up run). Every row of a result is
produced and discarded.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path
from statistics import median

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tarmac.registry import QUERIES  # noqa: E402
from tarmac.session import build_session  # noqa: E402

HEADLINE = (
    "delay_cost_summary", "flight_status", "passenger_risk", "route_performance", "ops_anomaly", "daily_kpi",
    "critical_feedback", "flight_delay_risk", "airport_share", "route_benchmarks", "weather_attribution", "ops_wide",
    "churn_shortlist", "multi_fact_fanout", "count_distinct", "percentile_cont", "running_balance", "merge_upsert",
    "merge_update_only", "scd2_apply", "as_of_snapshot", "forecast", "detect_anomalies", "churn_training",
    "cancel_training", "passenger_features", "passenger_feature_rows", "sentiment", "summarise", "extract_answer",
    "semantic_query", "key_checks", "stream_feedback", "stream_bookings", "stream_flights", "all_anomalies", "classify_metrics",
)


def timed(fn, spark, sf: str) -> float:
    start = time.perf_counter()
    fn(spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    memory = {"spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g")}
    spark = build_session("bench", f"local[{cpus}]", int(cpus), **memory)
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in HEADLINE:
        timed(QUERIES[name], spark, sf)
        times[name] = round(median(timed(QUERIES[name], spark, sf) for _ in range(runs)), 3)
    result = {
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": sf.rstrip("/").rsplit("sf", 1)[-1], "cpus": int(cpus), "shuffle_partitions": int(cpus), "runs": runs,
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
