"""Plan report: shuffles, joins, Python nodes and scanned columns per query.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
Reads the executed (pre-AQE) physical plan of every registered query; for the
streaming queries the plan is that of the batch read-back of the sink.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarise(plan: str) -> dict:
    scans = re.findall(r"FileScan \w+ \[([^\]]*)\].*?ReadSchema: (struct<[^>]*>)?", plan)
    tables = re.findall(r"Location: InMemoryFileIndex\(\d+ paths?\)\[[^\]]*?/([a-z_]+)\.parquet", plan)
    return {
        "exchanges": len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange RoundRobin|"
                                    r"Exchange SinglePartition", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "smj": plan.count("SortMergeJoin"),
        "bhj": plan.count("BroadcastHashJoin"),
        "nested_loop": plan.count("BroadcastNestedLoopJoin") + plan.count("CartesianProduct"),
        "python": plan.count("MapInPandas") + plan.count("ArrowEvalPython") + plan.count("FlatMapGroupsInPandas")
                  + plan.count("BatchEvalPython"),
        "scans": len(scans),
        "tables": sorted(set(tables)),
        "text_read": any(re.search(r"\b(text|html|content)#", cols) for cols, _ in scans),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from shroud.session import get_session
    spark = get_session("plans", master="local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    print("# PLANS\n")
    print(f"Physical plans of the registered queries at `{sf_dir}` (before AQE re-planning), produced by "
          "`tools/plan_report.py`. Streaming queries show the read-back of their sink.\n")
    print("| query | shuffles | broadcast | SMJ | BHJ | nested loop | Python | scans | tables | reads a text column |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    from shroud.plans.registry import QUERIES, load_all
    load_all()
    for name, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        print(f"| `{name}` | {s['exchanges']} | {s['broadcasts']} | {s['smj']} | {s['bhj']} | {s['nested_loop']} | "
              f"{s['python']} | {s['scans']} | {' '.join(s['tables'])} | {'yes' if s['text_read'] else 'no'} |")


if __name__ == "__main__":
    main()
