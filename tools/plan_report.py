"""Physical-plan summary of every registered query -> PLANS.md.

usage: python tools/plan_report.py [sf_dir] > PLANS.md
Each query runs once (noop sink) so the adaptive plan is final; counts are
taken from the executed plan text.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

def summarize(plan: str) -> dict:
    def n(pat):
        return len(re.findall(pat, plan))
    pushed = [p for p in re.findall(r"PushedFilters: \[([^\]]*)\]", plan) if p.strip()]
    return {
        "shuffles": n(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition"),
        "broadcasts": n(r"BroadcastExchange"),
        "joins": ", ".join(sorted(set(re.findall(
            r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)",
            plan)))) or "-",
        "topk": "yes" if "TakeOrderedAndProject" in plan else "",
        "pushed": len(pushed),
        "single_partition": n(r"Exchange SinglePartition"),
    }


def main():
    from flight_engine.plans.catalog import QUERIES
    from flight_engine.session import get_spark
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("plans", master="local[8]")
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `tools/plan_report.py` on `{sf}` after one execution of each query "
          "(final adaptive plans). `shuffles` counts hash/range/single-partition exchanges, "
          "`broadcasts` broadcast exchanges, `pushed` scans with non-empty PushedFilters. "
          "`SinglePartition` exchanges are global aggregates of already reduced rows.\n")
    print("| query | shuffles | single-partition | broadcasts | joins | windows | top-k | scans with pushed filters |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- |")
    for name in sorted(QUERIES):
        df = QUERIES[name](spark, sf)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarize(plan)
        windows = len(re.findall(r"(?m)^\s*[:+\- ]*Window \[", plan))
        print(f"| {name} | {s['shuffles']} | {s['single_partition']} | {s['broadcasts']} | "
              f"{s['joins']} | {windows} | {s['topk']} | {s['pushed']} |")
    spark.stop()


if __name__ == "__main__":
    main()
