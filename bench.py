"""Headline timings: prints one JSON line. BENCH_SF_DIR and BENCH_CPUS choose data and cores."""

import json
import os
import re
import time

from pyspark.sql import SparkSession

from tidewake.queries import QUERIES

NAMES = ["event_log", "stg_events", "daily_active", "engagement_daily", "signup_cohorts", "capture_gaps", "engagement_minute", "late_minute", "sessions_closed", "account_state_open", "partition_watermark", "verify_missing", "late_reconciliation", "version_diff", "codec_roundtrip"]


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    took = {}
    for name in NAMES:
        runs = []
        for _ in range(3):
            t = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t)
        took[name] = round(sorted(runs)[1], 3)
    sf = re.search(r"sf([\d.]+)", sf_dir)
    print(json.dumps({"metric": "sum over the headline queries of the median seconds of three runs", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": float(sf[1]) if sf else None}))
    spark.stop()


if __name__ == "__main__":
    main()
