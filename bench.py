"""Times the headline queries and prints one JSON line.

Each query is built and run to the end once untimed, then timed; results go to Spark's `noop` sink, so that every
row is computed and none is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from siltgate.operators.latest import latest_per_key  # noqa: E402
from siltgate.operators.merge import scd1_bucketed, scd1_touched, scd1_window  # noqa: E402
from siltgate.plans import catalog  # noqa: E402
from siltgate.sources.snapshot import read_bucketed, read_snapshot, write_snapshot  # noqa: E402
from siltgate.sources.storage import clear_scratch, join_path, scratch_folder  # noqa: E402

HEADLINE = [
    "special_char_good",
    "special_char_bad",
    "special_char_text",
    "blank_reject_good",
    "reject_reasons_all_rules",
    "scrub_to_empty",
    "dq_counts",
    "quarantine_difference",
    "quarantine_antijoin",
    "latest_per_key",
    "latest_per_key_lineitem",
    "scd1_merge_window",
    "scd1_merge_antijoin",
    "scd1_merge_bucketed",
    "scd1_merge_lineitem",
    "key_cast_sort",
    "preview_limit",
    "append_snapshot",
    "snapshot_read_pruned",
    "csv_scan_typed",
    "daily_special_scd1",
    "daily_blank_scd1",
    "daily_scrub_append",
    "daily_passthrough",
]


def merge_ways(spark: SparkSession, sf_dir: str) -> dict[str, float]:
    """The merge alone, against a stored snapshot of line items: three ways, a day of 1 % of the keys and of all."""
    key, folder, buckets = ["l_orderkey", "l_linenumber"], scratch_folder(spark), 8
    lines = latest_per_key(catalog.table(spark, sf_dir, "lineitem"), key, "l_shipdate")
    lines = lines.withColumn("time_stamp", F.lit("2024-01-01").cast("timestamp_ntz"))
    write_snapshot(lines.repartition(buckets, *key), folder, 20240101, unique_on=key, buckets=buckets)
    stored = read_snapshot(spark, folder, 20240101)
    seconds = {}
    for size, part in (("1pct", "l_orderkey % 100 = 0"), ("all", "true")):
        day = stored.filter(part).withColumn("time_stamp", F.lit("2024-01-02").cast("timestamp_ntz"))
        day.write.parquet(join_path(folder, f"day-{size}"))
        day = spark.read.parquet(join_path(folder, f"day-{size}"))
        ways = {
            "window": lambda d=day: scd1_window(stored, d, key),
            "touched": lambda d=day: scd1_touched(stored, d, key, newest_old=datetime(2024, 1, 1)),
            "bucketed": lambda d=day: scd1_bucketed(
                read_bucketed(spark, folder, 20240101), d, key, buckets, newest_old=datetime(2024, 1, 1)
            ),
        }
        for way, merge in ways.items():
            for _ in range(2):
                start = time.perf_counter()
                merge().write.format("noop").mode("overwrite").save()
                seconds[f"merge_{way}_{size}"] = round(time.perf_counter() - start, 3)
    clear_scratch(spark, folder)
    return seconds


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("siltgate-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in HEADLINE:
        run(name)
        seconds[name] = round(run(name), 3)
    total = sum(seconds.values())
    # Beside the headline queries, not part of their total.
    seconds |= merge_ways(spark, sf_dir)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(total, 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")),
            }
        )
    )


if __name__ == "__main__":
    main()
