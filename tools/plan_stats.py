"""Wall time and final-plan shape (exchanges, joins) per headline query.

Usage: python tools/plan_stats.py [sf_dir]; prints a markdown table.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from hourgrid.plans.catalog import QUERIES  # noqa: E402
from hourgrid.session import get_session  # noqa: E402


def plan_nodes(df) -> tuple[list[str], list[str]]:
    """Operator names of the final plan, and of the cached relations it reads.

    Walks the JVM plan tree (adaptive plans through their executed plan).
    An InMemoryTableScan is a leaf of the query; the plan of its cached
    relation is walked once per distinct relation and reported separately,
    since it is computed once however often it is read.
    """
    own: list[str] = []
    cached: list[str] = []
    seen: set[int] = set()

    def walk(node, out: list[str]) -> None:
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            walk(node.executedPlan(), out)
            return
        out.append(name)
        if name.endswith("QueryStage") and not name.startswith("Reused"):
            walk(node.plan(), out)
            return
        if name == "InMemoryTableScan":
            rel = node.relation()
            key = rel.hashCode()
            if key not in seen:
                seen.add(key)
                walk(rel.cachedPlan(), cached)
            return
        kids = node.children()
        for i in range(kids.size()):
            walk(kids.apply(i), out)

    walk(df._jdf.queryExecution().executedPlan(), own)
    return own, cached


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", "hourgrid-plan-stats", {"spark.sql.shuffle.partitions": "16"})
    QUERIES["monthly_change"](spark, sf).write.format("noop").mode("overwrite").save()
    print("| query | wall s | shuffle exchanges | broadcast joins | sort-merge joins | windows | cached reads "
          "| exchanges inside cached inputs |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- |")
    for name in HEADLINE:
        df = QUERIES[name](spark, sf)
        t0 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        dt = time.perf_counter() - t0
        own, cached = plan_nodes(df)
        count = own.count
        print(f"| {name} | {dt:.2f} | {count('Exchange')} | {count('BroadcastHashJoin') + count('BroadcastNestedLoopJoin')} "
              f"| {count('SortMergeJoin')} | {count('Window')} | {count('InMemoryTableScan')} "
              f"| {cached.count('Exchange')} |")
        spark.catalog.clearCache()


if __name__ == "__main__":
    main()
