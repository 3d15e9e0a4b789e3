"""Summarise the physical plan of every registered query (writes PLANS.md).

    python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarise(plan: str) -> dict:
    scans = re.findall(r"FileScan parquet \[([^\]]*)\][^\n]*?PushedFilters: \[([^\]]*)\]", plan)
    return {
        "hash": plan.count("hashpartitioning"),
        "range": plan.count("rangepartitioning"),
        "single": plan.count("Exchange SinglePartition"),
        "bhj": plan.count("BroadcastHashJoin"),
        "smj": plan.count("SortMergeJoin"),
        "window": len(re.findall(r"\bWindow \[", plan)),
        "subquery": len(set(re.findall(r"Subquery subquery#(\d+)", plan))),
        "scans": scans,
    }


def main(argv) -> None:
    from fleetstar.session import build_session
    from fleetstar.registry import QUERIES

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `tools/plan_report.py` on `{sf_dir}` (adaptive execution re-plans at runtime;")
    print("these are the initial plans). Columns: hash / range exchanges, single-partition exchanges")
    print("(final merges of global aggregates), broadcast hash joins, sort-merge joins, window")
    print("operators, distinct scalar subqueries, and each parquet scan's columns and pushed filters.")
    print("Operator counts include a scalar subquery's plan once per place that references it (the")
    print("plan text repeats it); a subquery listed once in the subqueries column executes once.\n")
    print("| query | hash | range | single | BHJ | SMJ | windows | subqueries | scans (columns; pushed filters) |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for name, fn in QUERIES.items():
        if name.startswith("stream_"):
            continue
        s = summarise(fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString())
        scans = "; ".join(sorted({f"{re.sub(r'#[0-9L]+', '', c)} [{re.sub(r'#[0-9L]+', '', f)}]"
                                   for c, f in s["scans"]}))
        print(f"| `{name}` | {s['hash']} | {s['range']} | {s['single']} | {s['bhj']} | {s['smj']} | "
              f"{s['window']} | {s['subquery']} | {scans} |")
    print("\nStreaming queries (`stream_*`) run `foreachBatch` / file-sink micro-batches; see README.")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
