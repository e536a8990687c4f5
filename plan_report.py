"""Summarize the final (post-AQE) physical plan of every registered query.

    python plan_report.py [sf_dir] > PLANS.md

Runs each query once through its own plan (``foreach`` with a no-op, so
AQE finalizes exactly that plan) and tabulates operator counts read from
the executed plan: shuffles, broadcast exchanges, join strategies, skew
splits, partial aggregates, group limits and scans.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wardline.plans.queries import all_queries  # noqa: E402
from wardline.session import build_session  # noqa: E402

COUNTED = [
    ("shuffles", r"\bExchange hashpartitioning|\bExchange rangepartitioning|\bExchange RoundRobin|\bExchange SinglePartition"),
    ("broadcasts", r"BroadcastExchange"),
    ("BHJ", r"BroadcastHashJoin"),
    ("SMJ", r"SortMergeJoin"),
    ("skew-split joins", r"isSkewJoin=true"),
    ("partial aggs", r"HashAggregate\(keys=\[[^\]]*\], functions=\[partial_"),
    ("group limits", r"WindowGroupLimit"),
    ("scans", r"FileScan|Scan parquet"),
]


def final_plan(df) -> str:
    df.foreach(lambda _: None)  # executes this DataFrame's own plan
    return df._jdf.queryExecution().executedPlan().toString()


def main() -> None:
    root = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8)
    print(f"# Final physical plans ({os.path.basename(root.rstrip('/'))}, local[8], AQE on)\n")
    print("Counts of operators in the executed (post-AQE) plan of each query.\n")
    print("| query | " + " | ".join(n for n, _ in COUNTED) + " |")
    print("| --- |" + " --- |" * len(COUNTED))
    for name, fn in sorted(all_queries().items()):
        p = final_plan(fn(spark, root))
        final = p.split("== Initial Plan ==")[0]
        cells = [str(len(re.findall(rx, final))) for _, rx in COUNTED]
        print(f"| {name} | " + " | ".join(cells) + " |")


if __name__ == "__main__":
    main()
