"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the test tables, BENCH_CPUS the local cores. Every query is
computed in full and written to Spark's no-op sink, twice: ``queries`` and ``value`` hold the second
runs, ``cold`` the total of the first ones, which compile code as well.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from tidemark.queries import QUERIES
from tidemark.session import SETTINGS

HEADLINE = (
    "latest_record latest_record_composite latest_record_cutoff clean_and_cast load_contracts"
    " load_accounts load_items load_divisions load_usagetransactions ingest_union typed_requests"
    " publish_log conversion_source active_modules daily_statistics zero_glitch_repair daily_changes"
    " summary_upsert lifecycle_pivot month_end_owner running_total neighbours first_event_counters"
    " first_event_bounded first_event_like key_events_all key_event_merge add_missing_keys first_accessed save_moments"
    " transfer_rule setup_cascade erase_history erase_crm_accounts redact mask_divisions stale_files"
    " salted_join"
).split()


def session(cpus: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidemark-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
    )
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    wanted = sys.argv[1:] or HEADLINE
    spark.read.parquet(f"{sf_dir}/orders.parquet").write.format("noop").mode("overwrite").save()
    times, cold = {}, {}
    for name in wanted:
        for runs in (cold, times):
            begin = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs[name] = round(time.perf_counter() - begin, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    result = {
        "metric": "headline queries, total time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "cold": round(sum(cold.values()), 3),
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
