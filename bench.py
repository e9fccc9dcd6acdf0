"""Time the headline queries on one machine and print one JSON line.

Each query is run once to warm up and then timed once, with its rows going to
the `noop` sink, so that all columns are computed but nothing is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

from strataloom import build_session
from strataloom.catalog import QUERIES

HEADLINE = [
    "g03_daily_store_sales",
    "g04_category_avg",
    "g06_segment",
    "g12_left_agg",
    "j02_star_join",
    "j10_asof_inner",
    "j13_wide_join",
    "w01_running_sum",
    "w02_rank_in_group",
    "w03_top3_per_day",
    "w05_lag_delta",
    "t02_top10",
    "d04_fact_load",
    "d07_scd2",
    "d08_scd2_check",
    "d15_normalize",
    "d18_daily_sales",
    "d19_gold",
    "i01_incremental",
    "i12_merge",
    "k03_partitioned_write",
    "q08_violations",
    "q12_overview",
    "q15_profile",
    "x07_role_analyst",
    "x16_audit",
    "b03_drill",
    "r03_replay",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", app="bench", shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in names:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
