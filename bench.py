"""Times the headline queries: one warm-up, then the median of three runs each; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from vesselflow.plans import registry

HEADLINE = (
    "label_fixes dedup_fixes port_events lane_events dwell_sessions port_lifts_daily lane_transit_daily lane_transit_time_daily area_occupancy_daily "
    "ballast_return_daily class_mix_daily overview ingest_rate occupancy_snapshot latest_n_fixes port_occupancy_series normalize_rows tile_cover aggregate_row_counts ml_features_daily "
    "pipeline_from_payloads dedup_out_of_order run_summary leg_tile_cover"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = [n for n in HEADLINE if not sys.argv[1:] or n in sys.argv[1:]]
    took = {}
    for name in names:
        runs = []
        for _ in range(4):
            start = time.perf_counter()
            registry.queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        took[name] = round(statistics.median(runs[1:]), 3)
    name = os.path.basename(sf_dir.rstrip("/"))
    print(json.dumps({"metric": "vessel queries, warm median", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": name.removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
