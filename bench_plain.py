"""Times a day's load of `lineitem` in its plain form beside `run_load`.

The plain form is what one would write first: the rejected rows as a multiset difference, a window over the union with
the whole previous snapshot, a sort by key, one output file, and every count and preview an action of its own that
starts from the text again. Both leave the same snapshot, which is checked.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from siltgate.functions.dates import load_stamp  # noqa: E402
from siltgate.plans.contracts import Contract  # noqa: E402
from siltgate.plans.daily import Layout, read_loaded, run_load  # noqa: E402
from siltgate.sources.storage import join_path, scratch_folder  # noqa: E402

SCHEMA = "line_id bigint, part bigint, quantity double, price double, flag string, status string, note string"
DAYS = (20240101, 20240102, 20240103)


def feed(spark: SparkSession, sf_dir: str, share: float) -> DataFrame:
    """Lines with their own numbers; some flags are blank. `share` is how much of the table a later day brings."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    number = F.col("l_orderkey") * 100_000_000 + F.col("l_partkey") * 100 + F.col("l_linenumber")
    return lines.select(
        number.alias("line_id"),
        "l_partkey",
        "l_quantity",
        "l_extendedprice",
        F.when(F.col("l_quantity") > 45, F.lit("-1")).otherwise(F.col("l_returnflag")),
        "l_linestatus",
        F.concat_ws(" ", "l_shipdate", "l_tax", "l_discount"),
    ).filter(F.pmod(F.xxhash64("l_orderkey"), F.lit(1000)) < int(1000 * share))


def plain_load(spark: SparkSession, path: str, out: str, bad: str, previous: str | None, stamp) -> None:
    rows = spark.read.csv(path, schema=SCHEMA)
    accepted = rows.filter(F.col("flag").isNotNull() & ~F.col("flag").isin("", "-1"))
    good = load_stamp(accepted, stamp)
    good.count()
    rows.exceptAll(accepted).write.mode("overwrite").csv(bad)
    if previous:
        newest = Window.partitionBy("line_id").orderBy(F.desc("time_stamp"), *[F.desc(c) for c in rows.columns])
        union = good.union(spark.read.parquet(previous))
        merged = union.withColumn("rk", F.row_number().over(newest)).filter("rk = 1").drop("rk").sort("line_id")
        merged.count()
        merged.take(1000)
        merged.coalesce(1).write.parquet(out)
    else:
        good.coalesce(1).write.parquet(out)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    contract = Contract(
        "line", SCHEMA, quality="blank", check_columns=("flag",), merge_mode="scd1", key=("line_id",)
    )
    seconds: dict[str, list[float]] = {"plain": [], "ours": []}
    for _ in range(2):
        folder = scratch_folder(spark)
        layout = Layout(join_path(folder, "feed"), join_path(folder, "out"), join_path(folder, "bad"))
        seconds = {"plain": [], "ours": []}
        previous = None
        for nth, day in enumerate(DAYS):
            path = layout.feed("line", day)
            feed(spark, sf_dir, 1.0 if nth == 0 else 0.05).write.csv(path)
            stamp = F.lit(f"2024-01-0{nth + 1} 06:00:00").cast("timestamp")
            out = join_path(folder, "plain", day)
            start = time.perf_counter()
            plain_load(spark, path, out, join_path(folder, "plain_bad", day), previous, stamp)
            seconds["plain"].append(round(time.perf_counter() - start, 2))
            previous = out
            start = time.perf_counter()
            run_load(spark, contract, layout, day, stamp)
            seconds["ours"].append(round(time.perf_counter() - start, 2))
        ours, theirs = read_loaded(spark, contract, layout, DAYS[-1]), spark.read.parquet(previous)
        assert ours.count() == theirs.count() and ours.exceptAll(theirs).isEmpty()
    spark.stop()
    print(json.dumps({"days": ["first load", "5 % of the table", "5 % of the table again"], "sec": seconds}))


if __name__ == "__main__":
    main()
