"""Time the headline queries: one JSON line. Folder and cores from BENCH_SF_DIR and BENCH_CPUS."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from plantmart.workload import QUERIES

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
SECONDS = float(os.environ.get("BENCH_SECONDS", "12"))  # a query that took so long in all is not run again
HEADLINE = [
    "hierarchy_join", "conditional_sums", "two_level_agg", "weighted_avg", "segment_by_quantile", "surrogate_id",
    "event_duration", "order_attribution", "loss_classification", "oee_summary", "latest_event_per_day",
    "occurrence_number", "next_threshold", "agg_join_back", "as_of_prev_next", "reconcile_full_outer", "bracket_of_volume",
    "complement", "genealogy_expand", "quality_summary", "consumption_reconciled", "batch_hierarchy", "event_split",
    "upsert_history", "fx_inverse_pairs", "customer_segments", "customer_averages", "product_positioning", "price_scales",
    "margin_matrix",
]


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    times: dict[str, float] = {}
    # The first query also pays for starting the JVM's compiler and the first scan.
    QUERIES["frequency_table"](spark, FOLDER).write.format("noop").mode("overwrite").save()
    for name in names:
        runs = []
        for _ in range(RUNS):
            start = time.perf_counter()
            QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
            if sum(runs) > SECONDS:
                break
        times[name] = round(statistics.median(runs), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                "queries": times, "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
                "cpus": CPUS, "runs": RUNS,
            }
        )
    )


if __name__ == "__main__":
    main()
