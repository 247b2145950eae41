"""Snapshots kept in order of their key."""

import random
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltgate.operators.latest import latest_per_key
from siltgate.sources import ranges
from siltgate.sources.ranges import Ranges, labelled, labels, load_ranges, merge_ranges, read_ranges
from siltgate.sources.snapshot import read_bucketed, read_snapshot
from siltgate.sources.storage import entries, join_path, sizes_below
from tests.helpers import at, bag, plan

ROW = "a string, b long, v string, time_stamp timestamp"
KEY = ("a", "b")


def shown(key):
    """NULL before all else, field by field."""
    return tuple((k is not None, k) for k in key)


def ordered(df, key):
    got = [shown([r[k] for k in key]) for r in df.collect()]
    assert got == sorted(got)
    return got


def above(lines, at):
    """The operators between a line of a plan and its root."""
    depth = len(lines[at])
    for line in reversed(lines[: at + 1]):
        own = len(line) - len(line.lstrip(" :+-"))
        if own < depth:
            depth = own
            yield line


def test_a_label_lies_in_the_bucket_of_its_number(spark):
    got = labels(spark, 300).withColumn("bucket", F.expr(f"pmod(hash({ranges.LABEL}), 300)")).collect()
    assert sorted(r.number for r in got) == list(range(300)) and all(r.number == r.bucket for r in got)


def test_keys_are_put_between_bounds(spark):
    lows = [(i, 1000 + i, (10 * i,)) for i in range(400)]
    bounds = spark.createDataFrame(lows, f"number int, {ranges.LABEL} long, low struct<k0: long>")
    keys = spark.createDataFrame([(None,), (-5,), (0,), (9,), (10,), (1279,), (1280,), (3989,), (3990,), (10**9,)], "k long")
    got = [r[ranges.LABEL] - 1000 for r in labelled(keys, bounds, ["k"]).collect()]
    assert got == [0, 0, 0, 0, 1, 127, 128, 398, 399, 399]


@pytest.mark.parametrize("seed", [1, 2])
def test_days_equal_brute_force(spark, tmp_path, seed):
    """NULL in keys and stamps, repeated rows and keys, ties, empty days."""
    dice = random.Random(seed)

    def row():
        key = dice.choice([None, "", "x", "y", "z"]), dice.choice([None, *range(40)])
        return (*key, dice.choice("pqr"), dice.choice([None, at(1), at(2), at(3)]))

    table, days = Ranges(str(tmp_path), KEY, 5), []
    for number, size in enumerate((150, 0, 60)):
        days.append(spark.createDataFrame([row() for _ in range(size)], ROW))
        load_ranges(spark, table, days[-1], 20240101 + number)
        expected = latest_per_key(reduce(DataFrame.unionByName, days), KEY)
        got = read_ranges(spark, table, 20240101 + number)
        assert bag(got) == bag(expected)
        ordered(got, KEY)


def test_the_snapshot_is_not_moved(spark, tmp_path):
    table = Ranges(str(tmp_path), ("k",), 6)
    first = spark.range(3000).selectExpr("id * 7 % 3000 k", "'old' v", "timestamp '2024-01-01' time_stamp")
    assert not load_ranges(spark, table, first, 20240101)
    files = [n for n in sizes_below(spark, join_path(str(tmp_path), "load_date=20240101")) if n.endswith(".parquet")]
    assert len(files) == 6
    day = spark.range(0, 3000, 50).selectExpr("id - 20 k", "'new' v", "timestamp '2024-01-02' time_stamp")
    existing = read_bucketed(spark, str(tmp_path), 20240101)
    name = entries(spark, join_path(str(tmp_path), "_bounds"))[0]
    merged = merge_ranges(existing, day, spark.read.parquet(join_path(str(tmp_path), "_bounds", name)), 6, table)
    merged._jdf.collectToPython()
    lines = plan(merged).splitlines()
    assert not any("rangepartitioning" in line for line in lines)
    scans = [i for i, line in enumerate(lines) if "Bucketed: true" in line]
    ways = [list(above(lines, i)) for i in scans]
    assert ways and all(any("Union" in line for line in way) for way in ways)
    assert not any("Exchange" in line for way in ways for line in way)
    assert load_ranges(spark, table, day, 20240102)
    for got in (merged, read_ranges(spark, table, 20240102)):
        assert len(ordered(got, ["k"])) == 3001
    assert entries(spark, join_path(str(tmp_path), "_bounds")) == [name]
    stored = read_snapshot(spark, str(tmp_path), 20240102)
    per_file = stored.groupBy(F.input_file_name()).agg(F.min("k").alias("low"), F.max("k").alias("high")).orderBy("low").collect()
    assert len(per_file) == 6 and all(a.high < b.low for a, b in zip(per_file, per_file[1:], strict=False))


def test_a_day_at_the_end_of_the_key_has_the_table_dealt_out_anew(spark, tmp_path):
    table, rows = Ranges(str(tmp_path), ("k",), 4), ["id k", "'x' v", "timestamp '2024-01-01' time_stamp"]
    load_ranges(spark, table, spark.range(400).selectExpr(*rows), 20240101)
    assert not load_ranges(spark, table, spark.range(400, 1200).selectExpr(*rows), 20240102)
    per_range = read_snapshot(spark, str(tmp_path), 20240102).groupBy(ranges.LABEL).count().collect()
    assert len(per_range) == 4 and max(r["count"] for r in per_range) < 600
    assert len(ordered(read_ranges(spark, table, 20240102), ["k"])) == 1200


def largest(spark, folder, date):
    """Ranges of a snapshot, and the rows of the largest."""
    counts = [r["count"] for r in read_snapshot(spark, folder, date).groupBy(ranges.LABEL).count().collect()]
    return len(counts), max(counts)


def test_a_range_does_not_grow_with_the_table(spark, tmp_path):
    """Ten times the rows make more ranges, not larger ones; nulls, repeated rows and wide text count as they are."""
    row = ["nullif(id, 7) k", "repeat('x', 200) v", "timestamp '2024-01-01' time_stamp"]
    for size in (2000, 20000):
        folder = join_path(str(tmp_path), size)
        table, rows = Ranges(folder, ("k",), 2, range_bytes=1 << 16), spark.range(size).selectExpr(*row)
        load_ranges(spark, table, rows.unionAll(rows), 20240101)
        number, most = largest(spark, folder, 20240101)
        assert number >= size * 288 / (1 << 16) * 0.8 and most * 288 <= 2 * (1 << 16)
        got = read_ranges(spark, table, 20240101)
        assert got.rdd.getNumPartitions() == number and bag(got) == bag(rows)
        ordered(got, ["k"])


def test_a_table_that_outgrows_its_ranges_is_dealt_out_in_more_of_them(spark, tmp_path):
    """Days spread over all ranges, each twice the first: the bounds serve until a range is full, and after that again."""
    folder = str(tmp_path)
    table, days, served = Ranges(folder, ("k",), 2, range_bytes=1 << 16), [], []
    for n in range(5):
        held = f"id * 10 + {n} k", "repeat('x', 200) v", f"timestamp '2024-01-0{n + 1}' time_stamp"
        days.append(spark.range(300 if n == 0 else 600).selectExpr(*held).withColumn("k", F.col("k") / (1 if n == 0 else 2)))
        served.append(load_ranges(spark, table, days[-1], 20240101 + n))
        number, most = largest(spark, folder, 20240101 + n)
        assert most * 288 <= ranges.FULL * (1 << 16)
        got = read_ranges(spark, table, 20240101 + n)
        assert bag(got) == bag(latest_per_key(reduce(DataFrame.unionByName, days), ("k",)))
        ordered(got, ["k"])
    assert served[0] is False and True in served[1:] and False in served[1:] and number > 2


def test_a_wider_day_counts_by_its_text(spark, tmp_path):
    """The same keys with far longer text fill the ranges; the table is dealt out anew once, then the bounds serve."""
    table = Ranges(str(tmp_path), ("k",), 2, range_bytes=1 << 16)

    def day(n, width):
        return spark.range(400).selectExpr("id k", f"repeat('x', {width}) v", f"timestamp '2024-01-0{n}' time_stamp")

    assert not load_ranges(spark, table, day(1, 1), 20240101)
    assert not load_ranges(spark, table, day(2, 4000), 20240102)
    assert load_ranges(spark, table, day(3, 4000), 20240103)
    assert largest(spark, str(tmp_path), 20240103)[0] > 10
    assert bag(read_ranges(spark, table, 20240103)) == bag(day(3, 4000))


def test_empty_tables_and_columns_that_come(spark, tmp_path):
    table, none = Ranges(str(tmp_path), ("k",), 4), spark.createDataFrame([], "k int, time_stamp timestamp")
    load_ranges(spark, table, none, 20240101)
    assert read_ranges(spark, table, 20240101).isEmpty()
    day = spark.createDataFrame([(2, at(2), "b"), (1, at(2), None)], "k int, time_stamp timestamp, more string")
    load_ranges(spark, table, day, 20240102)
    load_ranges(spark, table, spark.createDataFrame([(10**12, at(3))], "k long, time_stamp timestamp"), 20240103)
    got = [tuple(r) for r in read_ranges(spark, table, 20240103).select("k", "more").collect()]
    assert got == [(1, None), (2, "b"), (10**12, None)]
