"""Summarise the executed physical plan of the headline queries (run after one execution so
AQE's final plan is shown): exchanges, broadcasts, join strategies, windows and scans
with pushed filters.  usage: python tools/plan_summary.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from bidbox.plans import QUERIES, load_all  # noqa: E402
from bidbox.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session(shuffle_partitions=16)
    load_all()
    print("# Executed plan shapes of the headline queries\n")
    print(f"Generated by `tools/plan_summary.py {sf_dir}` (AQE final plans after one run, local[8]).\n")
    print("Queries whose core work runs eagerly before the returned plan (global rank behind a reliable")
    print("checkpoint in c21/w04, the ridge sums in m01) show only the plan after that point.\n")
    print("| query | shuffle exchanges | broadcasts | joins | windows | scans with pushed filters | scans |")
    print("|---|---|---|---|---|---|---|")
    for name in HEADLINE:
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        shuffles = len(re.findall(r"\bExchange (hashpartitioning|rangepartitioning|RoundRobin|SinglePartition)", plan, re.I))
        bcast = plan.count("BroadcastExchange")
        joins = {}
        for j in re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)", plan):
            joins[j] = joins.get(j, 0) + 1
        windows = len(re.findall(r"\bWindow ", plan))
        scans = len(re.findall(r"FileScan|Scan parquet", plan))
        pushed = len(re.findall(r"PushedFilters: \[[^\]]+\]", plan))
        jtxt = ", ".join(f"{k} x{v}" for k, v in sorted(joins.items())) or "-"
        print(f"| {name} | {shuffles} | {bcast} | {jtxt} | {windows} | {pushed} | {scans} |")
    spark.stop()


if __name__ == "__main__":
    main()
