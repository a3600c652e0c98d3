"""Benchmark: run the registered queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [name ...]

Each query is executed in full with the ``noop`` sink (every row computed,
nothing collected to the driver) and timed wall-clock, ``BENCH_RUNS`` times
(default 2).  ``queries`` holds the best run per query and ``value`` their
sum; ``cold_value`` is the sum of first runs (codegen and Python worker
start-up included).  Streaming twins are included with ``BENCH_STREAMS=1``.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    with_streams = os.environ.get("BENCH_STREAMS", "0") == "1"
    runs = max(1, int(os.environ.get("BENCH_RUNS", "2")))

    from eventide.session import checkpoint_root, local_session
    from eventide.plans.catalog import QUERIES
    from eventide.streaming.twins import STREAM_QUERIES

    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2, app_name="eventide-bench")
    checkpoint_root(spark)   # the configured spark.checkpoint.dir; a temp folder only if unset

    todo = dict(QUERIES)
    if with_streams:
        todo.update(STREAM_QUERIES)
    if len(sys.argv) > 1:
        todo = {k: v for k, v in {**QUERIES, **STREAM_QUERIES}.items() if k in sys.argv[1:]}

    # JVM / Python worker warm-up on the smallest input, not timed.
    QUERIES["page_views"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times, cold, errors = {}, {}, {}
    for name, q in todo.items():
        best = None
        try:
            for i in range(runs):
                t0 = time.perf_counter()
                q(spark, sf_dir).write.format("noop").mode("overwrite").save()
                dt = time.perf_counter() - t0
                if i == 0:
                    cold[name] = round(dt, 3)
                best = dt if best is None else min(best, dt)
            times[name] = round(best, 3)
        except Exception as e:  # noqa: BLE001 - reported in the JSON, exit code 1
            errors[name] = f"{type(e).__name__}: {str(e)[:300]}"

    total = round(sum(times.values()), 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": int(cpus), "runs": runs,
                      "cold_value": round(sum(cold.values()), 3), "cold_queries": cold,
                      **({"errors": errors} if errors else {})}))
    spark.stop()
    if errors:
        sys.exit(1)


if __name__ == "__main__":
    main()
