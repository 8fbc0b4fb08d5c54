"""Time the headline queries, each the better of two runs; prints one JSON line.

``BENCH_SF_DIR`` is the folder of Parquet tables, ``BENCH_CPUS`` the local threads.
``BENCH_VOLUME_ROWS`` adds the state and curated jobs over a generated change log of that
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

from ledgerlake.plans import volume
from ledgerlake.plans.sample_queries import QUERIES
from ledgerlake.session import build_session

HEADLINE = [
    "change_summary",
    "latest_state",
    "change_diff",
    "period_balance",
    "running_balance",
    "category_spend",
    "method_spend",
    "period_change",
    "iqr_stats",
    "iqr_outliers",
    "outlier_summary",
    "change_with_total",
    "portfolio_running",
    "check_balance",
    "check_change",
    "check_recompute",
    "check_unique",
    "multiset_diff",
    "recon_totals",
    "latency_summary",
    "raw_landing",
]


def run(frame) -> None:
    """Compute every row and column without writing them anywhere."""
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    volume_rows = int(os.environ.get("BENCH_VOLUME_ROWS", "1000000"))
    names = sys.argv[1:] or HEADLINE
    started = time.perf_counter()
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    session_seconds = time.perf_counter() - started
    run(QUERIES["period_totals"](spark, folder))  # warm-up
    seconds = {}
    for name in names:
        times = []
        for _ in range(2):
            start = time.perf_counter()
            run(QUERIES[name](spark, folder))
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times), 3)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(match.group(1)) if (match := re.search(r"sf([\d.]+)", folder)) else folder,
        "cpus": int(cpus),
        "session_start": round(session_seconds, 3),
    }
    if volume_rows and not sys.argv[1:]:
        result["volume"] = volume.measure(spark, volume_rows, tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    print(json.dumps(result))


if __name__ == "__main__":
    main()
