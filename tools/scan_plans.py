"""Report plan shapes that do not scale: cross joins, one-task exchanges over
row-level data, row-at-a-time Python.

    python tools/scan_plans.py [--sf DIR] [key ...]
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskweave.session import build_session  # noqa: E402
from riskweave.workload import all_queries  # noqa: E402

MARKS = ("CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition", "BatchEvalPython", "ArrowEvalPython", "InMemoryTableScan")


def marks_of(plan: str) -> dict[str, int]:
    initial = plan.split("== Initial Plan ==")[0]
    return {m: len(re.findall(m, initial)) for m in MARKS if m in initial}


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.001")
    parser.add_argument("keys", nargs="*")
    args = parser.parse_args()
    spark = build_session()
    queries = all_queries()
    for key in args.keys or queries:
        plan = queries[key](spark, args.sf)._jdf.queryExecution().executedPlan().toString()
        lines = plan.splitlines()
        single = []
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                below = lines[i + 1].strip(" :+-") if i + 1 < len(lines) else ""
                single.append(below[:110])
        print(key, marks_of(plan))
        for s in sorted(set(single)):
            print("      single <-", s)


if __name__ == "__main__":
    main()
