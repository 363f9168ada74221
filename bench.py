"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINES = [
    "bars_daily", "bars_running", "bar_audit", "side_impact", "quote_at_trade", "book_now", "delta_state", "clock_texts", "repeats_report", "messages_round_trip",
    "partition_counters", "partition_versions", "contents_shapes", "lens_members", "spans_cut", "listing_page", "listing_merged", "missing_days", "coverage", "stocking_decided",
]


def main() -> None:
    from marketloom.plans import registry
    from marketloom.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="spark-", dir="/tmp")})
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    spark.read.parquet(f"{sf_dir}/events.parquet").count()
    times = {}
    for name in HEADLINES:
        best = float("inf")
        for _ in range(2):  # the first run compiles
            began = time.time()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.time() - began)
        times[name] = round(best, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
