"""Summarise the executed (final adaptive) plan of every registered query into PLANS.md.

usage: python tools/plan_report.py [sf_dir] > PLANS.md
Counts shuffles, broadcast / sort-merge joins, windows and aggregates, and
lists what each scan reads (ReadSchema) and which filters reach it.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfspark.plans.registry import QUERIES  # noqa: E402
from shelfspark.session import get_session  # noqa: E402


def summarise(plan: str) -> dict:
    final = plan.split("== Initial Plan ==")[0]
    return {
        "shuffles": len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange RoundRobin|Exchange SinglePartition", final)),
        "reused": final.count("ReusedExchange"),
        "bhj": final.count("BroadcastHashJoin"),
        "smj": final.count("SortMergeJoin"),
        "bnlj": final.count("BroadcastNestedLoopJoin"),
        "windows": len(re.findall(r"\bWindow \[", final)),
        "wgl": final.count("WindowGroupLimit"),
        "aggs": len(re.findall(r"HashAggregate|ObjectHashAggregate|SortAggregate", final)),
        "python": len(re.findall(r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas", final)),
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session()
    spark.conf.set("spark.sql.maxPlanStringLength", str(1 << 30))
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    print("# Executed plans\n")
    print(f"Final adaptive plans of every registered query at `{sf}` (local[8], AQE on), produced by "
          "`tools/plan_report.py`. `shuffles` counts hash/range exchanges in the final plan, `reused` exchanges "
          "read twice, `bhj`/`smj`/`bnlj` join strategies, `wgl` WindowGroupLimit (pre-shuffle top-1), `python` "
          "Python evaluation nodes (always 0).\n")
    print("| query | rows | shuffles | reused | bhj | smj | bnlj | windows | wgl | aggs | python |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    scans: dict[str, set[str]] = {}
    for name, fn in QUERIES.items():
        df = fn(spark, sf)
        qe = df._jdf.queryExecution()
        n = qe.toRdd().count()
        plan = qe.executedPlan().toString()
        s = summarise(plan)
        print(f"| `{name}` | {n} | {s['shuffles']} | {s['reused']} | {s['bhj']} | {s['smj']} | {s['bnlj']} | "
              f"{s['windows']} | {s['wgl']} | {s['aggs']} | {s['python']} |")
        for m in re.finditer(r"FileScan parquet \[([^\]]*)\][^\n]*?DataFilters: \[([^\]]*)\][^\n]*?/(\w+)\.parquet\]",
                             plan.split("== Initial Plan ==")[0]):
            cols, filt, table = m.group(1), m.group(2), m.group(3)
            cols = re.sub(r"#\d+L?", "", cols)
            filt = re.sub(r"#\d+L?", "", filt)
            scans.setdefault(name, set()).add(f"{table}: [{cols}] filters [{filt}]")
    print("\n## Scans (columns read, filters pushed to the Parquet reader)\n")
    for name, items in scans.items():
        print(f"* `{name}`: " + "; ".join(sorted(items)))


if __name__ == "__main__":
    main()
