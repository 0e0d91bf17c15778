"""Benchmark: headline queries on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]``. Each query is run to completion (noop sink, nothing collected)
once to warm up and then ``$BENCH_RUNS`` times; the median is reported. Prints one
JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from qoeflow.plans import catalog  # noqa: E402
from qoeflow.session import local_session  # noqa: E402

HEADLINE = [
    "base_table",
    "kpi_time_to_top",
    "kpi_pct_below_top",
    "session_ptbtp",
    "score_session",
    "score_device",
    "score_account",
    "wifi_session_hour",
]


def run_once(spark, fn, sf_dir: str) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")),
                          app="qoeflow-bench")
    reg = catalog.registry()
    times = {}
    for name in names:
        run_once(spark, reg[name], sf_dir)  # warm-up (JIT, file listing, broadcast checks)
        times[name] = round(statistics.median(run_once(spark, reg[name], sf_dir) for _ in range(runs)), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "median_query_seconds_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
