"""Audit the physical plans of every registered query.

Prints, per query, the join strategies, broadcasts, windows and Python
operators of the executed plan (before adaptive re-planning), and flags
Cartesian products or nested-loop joins.

usage: python tools/plan_audit.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from mdquarry.plans.queries import QUERIES  # noqa: E402
from mdquarry.session import local_session  # noqa: E402

NODES = ["CartesianProduct", "BroadcastNestedLoopJoin", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin",
         "ShuffledHashJoin", "Window", "FlatMapCoGroupsInPandas", "MapInPandas", "BatchEvalPython", "ArrowEvalPython"]


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    bad = 0
    for name, fn in QUERIES.items():
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        counts = {k: len(re.findall(rf"\b{k}\b", plan)) for k in NODES}
        counts = {k: v for k, v in counts.items() if v}
        flag = "CartesianProduct" in counts or "BroadcastNestedLoopJoin" in counts
        bad += flag
        print(f"{name:24s} {'!!' if flag else '  '} {counts}")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
