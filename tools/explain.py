"""Print the formatted physical plan of registered queries.

Usage: python tools/explain.py [sf_dir] name [name ...]
Also prints a one-line summary per query: exchanges, broadcasts, sorts,
Python stages, scans with their pushed filters and read schema.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from voxelframe.plans import catalog  # noqa: E402
from voxelframe.session import build_session  # noqa: E402


def summary(plan: str) -> str:
    def n(p):
        return len(re.findall(p, plan))
    return (f"exchanges={n(r'Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition|Exchange RoundRobin')} "
            f"broadcast={n(r'BroadcastExchange')} smj={n(r'SortMergeJoin')} bhj={n(r'BroadcastHashJoin')} "
            f"windows={n(r'Window ')} python={n(r'ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas|AggregateInPandas|FlatMapCoGroupsInPandas')}")


def main():
    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    full = "--full" in args
    args = [a for a in args if a != "--full"]
    spark = build_session("local[8]", 8)
    qs = catalog.queries()
    for name in args or list(qs):
        df = qs[name](spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"== {name}: {summary(plan)} scans={len(re.findall('FileScan', plan))} "
              f"cached={len(re.findall('InMemoryTableScan', plan))}")
        for line in plan.splitlines():
            if "FileScan" in line:
                m = re.search(r"FileScan parquet \[([^\]]*)\].*?PushedFilters: \[([^\]]*)\]", line)
                if m:
                    print(f"   scan cols=[{m.group(1)[:120]}] pushed=[{m.group(2)[:160]}]")
        if full:
            df.explain("formatted")


if __name__ == "__main__":
    main()
