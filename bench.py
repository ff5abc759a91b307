"""Benchmark: run every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (all rows produced,
nothing collected to the driver). One JSON line is printed:
``{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}``.
A short warm-up on the smallest fixture starts the JVM and Python workers
first; it is not part of the timings. Each query runs ``$BENCH_REPEAT``
times (default 2) and its fastest run is reported, as shared machines are
noisy; ``"stat": "min"`` says so in the output.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shoplens.plans.queries import QUERIES  # noqa: E402
from shoplens.session import build_session  # noqa: E402

WARMUP_DIR = "/root/testdata/sf0.001"


def run(spark, fn, sf_dir: str) -> float:
    t = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [a for a in sys.argv[1:] if a in QUERIES]
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "2")))
    spark = build_session(f"local[{cpus}]", extra={"spark.sql.shuffle.partitions": str(cpus)})
    if os.path.isdir(WARMUP_DIR):
        for name in ("session_stat", "page_jump_counts", "ads_blacklist"):
            run(spark, QUERIES[name], WARMUP_DIR)
    times = {}
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        times[name] = round(min(run(spark, fn, sf_dir) for _ in range(repeat)), 3)
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus),
        "repeat": repeat,
        "stat": "min",
    }))
    spark.stop()


if __name__ == "__main__":
    main()
