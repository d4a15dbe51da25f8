"""Times the headline queries and prints one JSON line.

Each query runs twice and the better time counts: the first run also compiles.

Environment: BENCH_SF_DIR (table folder), BENCH_CPUS (local threads).
"""

from __future__ import annotations

import json
import os
import re
import time

from wxlake.checks.queries import QUERIES
from wxlake.session import build_session

HEADLINE = (
    "latest_per_key", "rename_cast_project", "daily_rollup", "gloom_daily", "rank_in_partition",
    "rank_global", "sorted_ranking", "islands", "episode_status", "groupwise_max_join",
    "latest_live_rows", "sorted_live", "reliability", "gloom_grid", "gloom_partial",
    "idw_cross_join", "flatten_current", "fill_rate", "describe", "exact_quantiles",
    "write_partitions", "stream_dedup", "job_path", "live_cycle",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("wxlake-bench", f"local[{cpus}]", {
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "16g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()  # start-up is not measured
    seconds = {}
    for name in HEADLINE:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(scale.group(1)) if scale else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
