"""Times the headline queries and prints one JSON line.

Each query runs to the last row (``noop`` sink) once to warm up and then twice; the better
time counts.
"""

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

HEADLINE = [
    "monthly_sales",
    "group_sum_five_keys",
    "refresh_mtd",
    "refresh_n_days_batch_bounds",
    "refresh_cdc_file",
    "refresh_cdc_many_files",
    "upsert_by_key",
    "schema_sync_types",
    "schema_reconcile",
    "string_width_profile",
    "normalize_text_values",
    "parse_date_pattern",
    "human_size",
    "content_hash",
    "new_files",
    "changed_content",
    "latest_per_key",
    "retention_expired",
    "run_bounds_window",
    "scd2_delta",
    "scd2_dimension",
    "month_mismatch",
    "reconcile_content",
    "join_to_aggregate",
    "multi_key_sort",
    "run_date_spine",
    "partition_number",
    "delimited_roundtrip",
    "month_backup_roundtrip",
    "table_refresh_month",
    "table_refresh_cdc",
    "job_transform",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    from warehouse_queries import QUERIES

    times = {}
    for name in names:
        best = None
        for attempt in range(3):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            if attempt and (best is None or took < best):
                best = took
        times[name] = round(best, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_time_headline_queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
