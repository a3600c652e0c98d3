"""Summarise the physical plan of every registered batch query (dev tool).

    python tools/plan_report.py [--sf DIR] > PLANS.md

Counts, per query, the Parquet scans, shuffle exchanges, broadcast
exchanges, partial window-group limits, sort-merge joins and Python nodes in
the executed plan (AQE's final plan, after running the query once with the
noop sink).
"""

from __future__ import annotations

import argparse
import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "PythonUDF")


def summarise(plan: str) -> dict:
    out = dict(scans=0, shuffles=0, reused=0, broadcasts=0, smj=0, bhj=0, wgl_partial=0,
               python=0)
    plan = plan.split("== Initial Plan ==")[0]     # AQE prints final and initial plans
    for line in plan.splitlines():
        if "ReusedExchange" in line:
            out["reused"] += 1
        elif re.search(r"\bExchange (hash|range|single|roundrobin)", line, re.I):
            out["shuffles"] += 1
        out["scans"] += bool(re.search(r"FileScan parquet|Scan parquet", line))
        out["broadcasts"] += "BroadcastExchange" in line
        out["smj"] += "SortMergeJoin" in line
        out["bhj"] += "BroadcastHashJoin" in line
        out["wgl_partial"] += bool(re.search(r"WindowGroupLimit.*Partial", line))
        out["python"] += any(p in line for p in PYTHON_NODES)
    return out


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    args = ap.parse_args()
    from eventide.plans.catalog import QUERIES
    from eventide.session import local_session

    spark = local_session(8, 16)
    print("# Physical plans of the registered batch queries\n")
    print(f"Generated by `tools/plan_report.py` on `{args.sf}` (local[8], 16 shuffle partitions, "
          "AQE on). Counts are taken from the final adaptive plan after one run. At this size AQE "
          "turns most joins into broadcasts, and bigger inputs keep sort-merge joins. "
          "`shuffles` counts shuffle exchanges; `reused` counts exchanges served from another branch.\n")
    print("| query | scans | shuffles | reused | broadcasts | SMJ | BHJ | partial WGL | python |")
    print("|---|---|---|---|---|---|---|---|---|")
    for name, q in QUERIES.items():
        df = q(spark, args.sf)
        df.collect()                 # run this Dataset so AQE's plan is final (dev tool only)
        s = summarise(df._jdf.queryExecution().executedPlan().toString())
        print(f"| `{name}` | {s['scans']} | {s['shuffles']} | {s['reused']} | {s['broadcasts']} | "
              f"{s['smj']} | {s['bhj']} | {s['wgl_partial']} | {s['python']} |")
    spark.stop()


if __name__ == "__main__":
    main()
