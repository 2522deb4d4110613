"""Times the headline jobs and prints one JSON line.

Each job is planned and run into the noop sink, so every row is computed. One
warm-up, then the median of three runs.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from dimflow import get_session
from dimflow.queries import all_queries

HEADLINE = [
    "job_scd2_islands",
    "job_scd2_first_seen",
    "job_purchase_state",
    "jn_lookup_asof",
    "win_latest_per_key",
    "win_forward_fill",
    "snk_scd2_merge",
    "snk_upsert",
    "job_attribute_log",
    "job_wide_view",
    "job_fact",
    "job_fact_incremental",
    "job_employee_dim",
    "job_position_dim",
    "job_requisition_fact",
    "job_manager_hierarchy",
    "job_org_dim",
    "job_accumulator_bridge",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = get_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": os.environ.get("BENCH_MEM", "16g")},
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted = os.environ.get("BENCH_QUERIES")
    names = wanted.split(",") if wanted else HEADLINE
    every, seconds = all_queries(), {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            every[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
    sf = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline jobs, sum of medians",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf,
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
