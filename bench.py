"""Benchmark of the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Set ``BENCH_EVENT_LOG`` to a folder to keep Spark's event log there (stage
and task times without the UI).

Each query is run once to warm up, then ``BENCH_RUNS`` times (default 3),
fully materialised through the ``noop`` sink; the median is reported. The
stream job is timed end to end (file stream, available-now trigger, all five
running tables written). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shoplens.plans.model import BLACKLIST_THRESHOLD, Model  # noqa: E402
from shoplens.plans.queries import REGISTRY  # noqa: E402
from shoplens.session import build_session, scratch_path  # noqa: E402
from shoplens.streaming import ad_stream  # noqa: E402
from shoplens.streaming.sources import events_click_stream  # noqa: E402

HEADLINE = {
    "q1_session_stats": "session_stats",
    "q2_session_extract": "session_extract",
    "q3_top10_categories": "top10_categories",
    "q4_top10_products_universe": "top10_products_universe",
    "q5_area_top3_products": "area_top3_products",
    "q5b_area_top3_orders": "area_top3_orders",
    "q6_blacklist_users": "blacklist_users",
    "q7_province_city_clicks": "clicks_by_city_ad_day",
    "q8_province_top3": "province_top3",
    "q9_last_hour_trend": "last_hour_trend",
    "q9b_hourly_sliding_clicks": "hourly_sliding_clicks",
    "page_flow_conversion": "page_flow_conversion",
}


def run_query(spark, base: str, name: str) -> None:
    REGISTRY[name](spark, base).write.format("noop").mode("overwrite").save()


def run_stream(spark, base: str) -> None:
    root = scratch_path(spark, "bench-stream")
    tables = ad_stream.AdTables.at(spark, f"{root}/tables")
    clicks, geo = events_click_stream(spark, base)
    q = ad_stream.start_ad_pipeline(clicks, tables, f"{root}/checkpoint",
                                    threshold=BLACKLIST_THRESHOLD,
                                    trigger={"availableNow": True}, geo=geo)
    q.awaitTermination()


def timed(fn, runs: int) -> float:
    fn()
    samples = []
    for _ in range(runs):
        t0 = time.perf_counter()
        fn()
        samples.append(time.perf_counter() - t0)
    return statistics.median(samples)


def main() -> None:
    base = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    conf = {}
    if os.environ.get("BENCH_EVENT_LOG"):
        conf = {"spark.eventLog.enabled": "true",
                "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG"]}
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(cpus, 4), conf=conf)
    Model(spark, base)  # pins the UTC session zone
    results = {}
    for label, name in HEADLINE.items():
        results[label] = round(timed(lambda: run_query(spark, base, name), runs), 3)
    results["stream_pipeline"] = round(timed(lambda: run_stream(spark, base), runs), 3)
    sf = base.rsplit("sf", 1)[-1]
    try:
        sf = float(sf)
    except ValueError:
        pass
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": sf,
        "cpus": cpus,
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
