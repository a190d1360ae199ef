"""Bench: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (no collect to the
driver), once to warm up the JVM/codegen caches and then timed.  Prints one
JSON line: {"metric", "value", "unit", "queries", "sf"}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "candles_5m", "candles_15m", "candles_1h", "candles_1d",
    "latest_per_ticker", "history_last_n", "market_overview", "top_gainers",
    "sma", "ema", "rsi",
    "coverage", "overview",
    "fixed_width_parse", "hist_dedupe_last", "fixed_width_stats",
    "jsonl_points", "payload_series", "daily_csv_transform", "universe_strict",
    "upsert_trades", "insert_ignore", "stream_candles",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from candlewick.plans import catalog
    from candlewick.session import local_session

    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="candlewick-bench")
    catalog.load_all()
    names = [n for n in (only or HEADLINE) if n in catalog.QUERIES]
    timings: dict[str, float] = {}
    for name in names:
        fn = catalog.QUERIES[name]
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        t0 = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total_sec",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
