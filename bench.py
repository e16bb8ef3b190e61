"""Benchmark the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query's full result is forced through the ``noop`` sink (no collect),
one warm-up run then the median of ``$BENCH_RUNS`` timed runs.  Prints ONE
JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shelfspark.plans.registry import QUERIES  # noqa: E402
from shelfspark.session import get_session  # noqa: E402

HEADLINE = [
    # flagship silver inventory and the gold fact
    "inventory_movement", "star_lookup",
    # the nine reports
    "inventory_valuation", "turnover_category", "movement_quartiles", "ontime_vs_delayed",
    "supplier_concentration_risk", "supplier_category_contribution", "engagement_metrics",
    "roi_by_segment", "sales_impact",
    # campaign fact and the order layer
    "campaign_roi", "order_header_items",
    # ingestion / history / checks
    "json_extract", "flatten_items", "latest_per_key", "scd2_history", "check_unique",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else (list(QUERIES) if os.environ.get("BENCH_ALL") else HEADLINE)
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus))
    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=parts)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    times: dict[str, float] = {}
    for name in names:
        samples = []
        for i in range(runs + 1):
            t0 = time.perf_counter()
            df = QUERIES[name](spark, sf_dir)  # construction may run size checks / checkpoints
            df.write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            if i > 0:
                samples.append(dt)
        times[name] = round(statistics.median(samples), 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": total, "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace('.', '', 1).isdigit() else sf,
                      "cpus": int(cpus), "shuffle_partitions": parts, "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
