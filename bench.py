"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from stratawell.registry import all_queries
from stratawell.session import build_session

HEADLINE = (
    "dedupe_latest", "silver_production", "lag_features", "rolling_30", "month_to_date",
    "block_frames", "gold_daily", "v_alerts", "v_trends", "v_predictions", "v_comparison",
    "station_explode", "feature_store", "dq_suite_silver", "dq_suite_gold", "dq_gate",
    "quarantine", "upsert_latest", "median_impute", "ordered_split", "drop_vs_rolling",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    wanted = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"),
        spark__sql__shuffle__partitions=cpus,
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = all_queries()
    seconds = {}
    for name in wanted:
        runs = []
        for _ in range(repeats):
            start = time.perf_counter()
            registered[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        # The first run compiles and fills caches; the rest are warm.
        seconds[name] = round(statistics.median(runs[1:] or runs), 3)
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    print(
        json.dumps(
            {
                "metric": "total_warm_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "cpus": int(cpus),
                "lineitem_rows": lines,
            }
        )
    )


if __name__ == "__main__":
    main()
