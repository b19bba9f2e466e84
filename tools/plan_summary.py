"""Summarise the physical plan of each report: exchanges, join strategies, pushed filters.

    python tools/plan_summary.py [--sf DIR] [--full] [name ...]
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

MARKERS = ["Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange SinglePartition",
           "Exchange RoundRobin", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin",
           "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct", "Expand",
           "WindowGroupLimit", "TakeOrderedAndProject", "ObjectHashAggregate", "SortAggregate"]


def summarise(df) -> tuple[dict, list[str]]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    counts = {m: plan.count(m) for m in MARKERS if plan.count(m)}
    # The formatted explain lists every scan with its full PushedFilters / ReadSchema.
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    scans = []
    for block in text.split("\n\n"):
        if "Scan parquet" not in block or "ReadSchema" not in block:
            continue
        table = re.search(r"/([a-z_]+)\.parquet", block)
        pushed = re.search(r"PushedFilters: \[(.*)\]", block)
        schema = re.search(r"ReadSchema: struct<(.*)>", block)
        scans.append(f"{table.group(1) if table else '?'} cols=[{schema.group(1) if schema else ''}]"
                     f" pushed=[{pushed.group(1)[:200] if pushed else ''}]")
    return counts, scans


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("--full", action="store_true")
    ap.add_argument("--markdown", action="store_true", help="one table row per report")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    from quarry.plans import QUERIES
    from quarry.session import build_session

    spark = build_session("local[8]", 16)
    qs = QUERIES
    if args.markdown:
        print("| report | shuffles | broadcast joins | sort-merge joins | other |")
        print("|---|---|---|---|---|")
    for name in args.names or sorted(qs):
        df = qs[name](spark, args.sf)
        counts, scans = summarise(df)
        if args.markdown:
            shuffles = sum(v for k, v in counts.items() if k.startswith("Exchange") and "Broadcast" not in k)
            other = ", ".join(k for k in ("WindowGroupLimit", "TakeOrderedAndProject", "Expand",
                                          "ObjectHashAggregate", "SortAggregate") if k in counts)
            print(f"| `{name}` | {shuffles} | {counts.get('BroadcastHashJoin', 0)} | "
                  f"{counts.get('SortMergeJoin', 0)} | {other} |")
            continue
        print(f"== {name}: {counts}")
        for s in scans:
            print(f"     scan {s}")
        if args.full:
            df.explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
