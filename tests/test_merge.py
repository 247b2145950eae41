import random
from datetime import datetime

import pytest
from helpers import at, bag, final_plan, plan
from pyspark.sql import functions as F

from siltgate.operators import merge
from siltgate.operators.difference import key_difference, multiset_difference
from siltgate.operators.latest import key_cast_sort, latest_per_key, preview
from siltgate.operators.merge import append, measure_keys, scd1, scd1_bucketed, scd1_touched, scd1_window
from siltgate.sources.snapshot import read_bucketed, read_snapshot, write_snapshot

DDL = "k int, v string, time_stamp timestamp"


def frame(spark, *rows, ddl=DDL):
    return spark.createDataFrame(list(rows), ddl)


def brute_force(rows, key=lambda r: r[0]):
    """Newest row per key, ties by the larger other values, all NULLs last."""
    def rank(row):
        return [(v is not None, v if v is not None else 0) for v in [row[2], *row[:2]]]

    best = {}
    for row in rows:
        if key(row) not in best or rank(row) > rank(best[key(row)]):
            best[key(row)] = row
    return sorted(best.values(), key=str)


def test_latest_per_key(spark):
    rows = [(1, "a", at(1)), (1, "b", at(2)), (2, "c", None), (2, "d", at(1)), (None, "e", at(1)), (None, "f", at(3)),
            (3, "x", at(1)), (3, "y", at(1)), (3, None, at(1))]
    got = sorted((tuple(r) for r in latest_per_key(frame(spark, *rows), ["k"]).collect()), key=str)
    assert got == sorted([(1, "b", at(2)), (2, "d", at(1)), (None, "f", at(3)), (3, "y", at(1))], key=str)


def test_declared_tie_break(spark):
    rows = [(1, "z", 1, at(1)), (1, "a", 2, at(1))]
    df = frame(spark, *rows, ddl="k int, v string, n int, time_stamp timestamp")
    assert latest_per_key(df, ["k"], tie_break=["n"]).first().v == "a"
    assert latest_per_key(df, ["k"]).first().v == "z"


def test_outcome_does_not_depend_on_partitions(spark):
    rows = [(i % 5, f"v{i % 7}", at(1 + i % 2)) for i in range(200)]
    one, many = frame(spark, *rows).coalesce(1), frame(spark, *rows).repartition(13)
    assert bag(latest_per_key(one, ["k"])) == bag(latest_per_key(many, ["k"]))


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("bound", [merge.BROADCAST_BYTES, "below"])
@pytest.mark.parametrize("late", [False, True])
def test_touched_equals_window_equals_brute_force(spark, seed, bound, late):
    draw = random.Random(seed)
    keys = [None, *range(12)]
    old = {k: (k, draw.choice("abc"), draw.choice([at(3), at(4)])) for k in draw.sample(keys, 9)}
    days = [at(2), at(4), at(6), None] if late else [at(6), at(7)]
    new = [(draw.choice(keys), draw.choice("abc"), draw.choice(days)) for _ in range(25)]
    existing, day = frame(spark, *old.values()), frame(spark, *new)
    if bound == "below":
        bound = measure_keys(day, ["k"], "time_stamp").bytes - 1
    expected = brute_force([*old.values(), *new])
    for merged in (
        scd1_window(existing, day, ["k"]),
        scd1_touched(existing, day, ["k"], broadcast_bytes=bound),
    ):
        assert sorted((tuple(r) for r in merged.collect()), key=str) == expected


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("late", [False, True])
@pytest.mark.parametrize("hot", [False, True])
def test_bucketed_equals_brute_force(spark, tmp_path, seed, late, hot):
    draw = random.Random(seed)
    keys = [*range(12)] + [None] * seed
    old = {k: (k, draw.choice("abc"), draw.choice([at(3), at(4)])) for k in draw.sample(keys, 9)}
    days = [at(2), at(4), at(6), None] if late else [at(6), at(7)]
    new = [(3 if hot and i % 2 else draw.choice(keys), draw.choice("abc"), draw.choice(days)) for i in range(40)]
    base = str(tmp_path)
    write_snapshot(frame(spark, *old.values()).repartition(4, "k"), base, 1, unique_on=["k"], buckets=4)
    existing = read_bucketed(spark, base, 1)
    merged = scd1_bucketed(existing, frame(spark, *new), ["k"], 4)
    write_snapshot(merged, base, 2, unique_on=["k"], buckets=4)
    for df in (merged, read_bucketed(spark, base, 2), read_snapshot(spark, base, 2)):
        assert sorted((tuple(r) for r in df.collect()), key=str) == brute_force([*old.values(), *new])
    if not late:
        text = plan(merged)
        probe = text[text.index("ShuffledHashJoin") :]
        assert "Bucketed: true" in probe and "LeftAnti" in probe
        assert "Exchange" not in probe[: probe.index("Bucketed: true")]
        assert len(read_snapshot(spark, base, 2).inputFiles()) <= 4


def test_bucketed_with_an_empty_day(spark, tmp_path):
    write_snapshot(frame(spark, (1, "a", at(1))), str(tmp_path), 1, unique_on=["k"], buckets=4)
    existing = read_bucketed(spark, str(tmp_path), 1)
    assert bag(scd1_bucketed(existing, existing.filter("k < 0"), ["k"], 4)) == {(1, "a", at(1)): 1}


def test_two_column_keys_with_nulls(spark):
    ddl = "a int, b string, time_stamp timestamp"
    old = frame(spark, (1, "x", at(1)), (1, None, at(1)), (None, None, at(1)), (2, "y", at(1)), ddl=ddl)
    new = frame(spark, (1, None, at(2)), (None, "x", at(2)), (2, "y", at(2)), ddl=ddl)
    expected = {(1, "x", at(1)): 1, (1, None, at(2)): 1, (None, None, at(1)): 1, (2, "y", at(2)): 1,
                (None, "x", at(2)): 1}
    for bound in (merge.BROADCAST_BYTES, 0):
        assert bag(scd1_touched(old, new, ["a", "b"], broadcast_bytes=bound)) == expected
    assert bag(scd1_window(old, new, ["a", "b"])) == expected


def test_merge_is_idempotent_and_unique(spark):
    old = frame(spark, *[(k, "o", at(1)) for k in range(10)])
    day = frame(spark, *[(k, f"n{i}", at(2)) for k in range(5, 15) for i in range(3)])
    once = scd1(old, day, ["k"], existing_unique=True)
    twice = scd1(once, day, ["k"], existing_unique=True)
    assert bag(once) == bag(twice)
    assert once.count() == once.select("k").distinct().count() == 15


def test_merge_with_empty_sides(spark):
    rows = frame(spark, (1, "a", at(1)))
    none = rows.filter("k < 0")
    assert bag(scd1_touched(rows, none, ["k"])) == bag(rows)
    assert bag(scd1_touched(none, rows, ["k"])) == bag(rows)
    assert scd1_touched(none, none, ["k"]).count() == 0


def test_snapshot_with_repeated_keys_gives_the_same_at_any_bound(spark):
    old = frame(spark, (1, "a", at(1)), (1, "b", at(2)), (2, "c", at(1)))
    day = frame(spark, (2, "d", at(3)))
    assert scd1(old, day, ["k"], existing_unique=False).count() == 2
    expected = {(1, "a", at(1)): 1, (1, "b", at(2)): 1, (2, "d", at(3)): 1}
    for bound in (merge.BROADCAST_BYTES, -1):
        assert bag(scd1_touched(old, day, ["k"], broadcast_bytes=bound)) == expected


def test_bucketed_two_column_keys_with_nulls_stay_in_their_buckets(spark, tmp_path):
    ddl = "a int, b string, time_stamp timestamp"
    old = frame(spark, *[(k, f"x{k}", at(1)) for k in range(40)], (1, None, at(1)), (None, None, at(1)), ddl=ddl)
    write_snapshot(old.repartition(4, "a", "b"), str(tmp_path), 1, unique_on=["a", "b"], buckets=4)
    new = frame(spark, (1, None, at(2)), (None, "x", at(2)), (2, "x2", at(2)), ddl=ddl)
    merged = scd1_bucketed(read_bucketed(spark, str(tmp_path), 1), new, ["a", "b"], 4)
    assert bag(merged) == bag(scd1_window(old, new, ["a", "b"]))
    assert "Bucketed: true" in plan(merged, "formatted")


def test_late_merge_uses_the_noted_stamp(spark):
    old, new = frame(spark, (1, "o", at(3))), frame(spark, (1, "n", at(2)))
    assert scd1_touched(old, new, ["k"]).first().v == "o"


def test_stamps_compare_across_the_change_of_clocks(spark):
    """Two moments that look alike on a local clock when summer time ends."""
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        first, second = "timestamp'2024-10-27 00:30:00Z'", "timestamp'2024-10-27 01:30:00Z'"
        old = spark.sql(f"SELECT 1 AS k, 'old' AS v, {second} AS time_stamp")
        new = spark.sql(f"SELECT 1 AS k, 'new' AS v, {first} AS time_stamp")
        assert scd1_touched(old, new, ["k"]).first().v == "old"
        assert scd1_touched(new, old, ["k"]).first().v == "old"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_append_matches_columns_by_name(spark):
    old = frame(spark, (1, "a", at(1)))
    new = old.select("v", "time_stamp", "k")
    assert append(old, new).select("k", "v").collect() == [(1, "a"), (1, "a")]


def test_fast_merge_does_not_shuffle_the_snapshot(spark, tmp_path):
    path = str(tmp_path / "old")
    frame(spark, *[(k, "o", at(1)) for k in range(100)]).write.parquet(path)
    day = frame(spark, (1, "n", at(2)))
    text = plan(scd1_touched(spark.read.parquet(path), day, ["k"]))
    snapshot = text[text.index("BroadcastHashJoin") :]
    assert "LeftAnti" in snapshot
    assert "Exchange" not in snapshot[: snapshot.index("BroadcastExchange")]
    assert "WindowGroupLimit" in text


def test_keys_over_the_bound_are_not_broadcast(spark):
    old, day = frame(spark, *[(k, "o", at(1)) for k in range(50)]), frame(spark, (1, "n", at(2)))
    size = measure_keys(day, ["k"], "time_stamp").bytes
    assert "BroadcastHashJoin" in plan(scd1_touched(old, day, ["k"], broadcast_bytes=size))
    over = plan(scd1_touched(old, day, ["k"], broadcast_bytes=size - 1))
    assert "SortMergeJoin" in over and "BroadcastHashJoin" not in over


def test_one_key_with_a_third_of_all_rows(spark):
    """Each task keeps one row of the frequent key before the shuffle."""
    df = spark.range(0, 300_000, numPartitions=16).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        F.col("id").cast("string").alias("v"),
        F.timestamp_seconds("id").alias("time_stamp"),
    )
    latest = latest_per_key(df, ["k"])
    assert latest.count() == 200_001
    assert latest.filter("k = -1").first().v == "299997"
    text = plan(latest)
    assert text.index("Final") < text.index("Exchange hashpartitioning") < text.index("Partial")


@pytest.mark.parametrize("chunk", [1, 3, 10_000])
def test_multiset_difference_equals_except_all(spark, chunk):
    draw = random.Random(chunk)
    rows = [(draw.choice([None, 1, 2]), draw.choice(["a", None])) for _ in range(300)]
    left = frame(spark, *rows, ddl="k int, v string")
    right = frame(spark, *rows[:120], (9, "z"), ddl="k int, v string")
    got = multiset_difference(left, right.select("v", "k"), chunk)
    assert got.columns == left.columns
    assert bag(got) == bag(left.exceptAll(right))


def test_multiset_difference_spreads_copies(spark):
    left = spark.range(0, 90_000, numPartitions=4).select(F.lit("copy").alias("v"))
    got = multiset_difference(left, left.limit(7), chunk_copies=500)
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 89_993
    assert len(sizes) >= 4 and max(sizes) < 45_000


def test_multiset_difference_counts_once(spark):
    df = spark.range(100).select((F.col("id") % 5).alias("k"))
    assert "ReusedExchange" in final_plan(multiset_difference(df, df.filter("k = 1"), 5))


def test_key_difference(spark):
    left = frame(spark, (1, "a"), (1, "b"), (2, "c"), (None, "d"), ddl="k int, v string").select("v", "k")
    right = frame(spark, (1, "x"), (1, "y"), (None, "z"), ddl="k int, v string")
    got = key_difference(left, right, ["k"])
    assert got.columns == ["v", "k"]
    assert bag(got) == {("c", 2): 1, ("d", None): 1}


def test_key_cast_sort(spark):
    df = spark.createDataFrame([("10",), ("9",), ("x",), (None,), (" 7 ",), ("2.5",), ("99999999999",)], "k string")
    ordered = [r.k for r in key_cast_sort(df, "k").collect()]
    assert ordered == [None, None, None, None, 7, 9, 10]
    assert "rangepartitioning" in plan(key_cast_sort(df, "k"))


def test_preview_is_ordered_and_not_a_full_sort(spark):
    df = spark.range(5000, 0, -1).withColumnRenamed("id", "k")
    assert [r.k for r in preview(df, ["k"]).collect()] == list(range(1, 1001))
    assert "TakeOrderedAndProject" in plan(preview(df, ["k"]))


def test_measured_keys(spark):
    day = frame(spark, (1, "a", at(2)), (1, "a", None), (None, "b", at(1)))
    keys = measure_keys(day, ["k"], "time_stamp")
    assert (keys.count, keys.has_null, keys.has_null_stamp) == (2, True, True)
    assert keys.bytes >= 200
    assert keys.oldest == int((datetime(2024, 1, 1, 6) - datetime(1970, 1, 1)).total_seconds() * 1_000_000)


def test_key_difference_splits_a_frequent_key(spark):
    """Beyond the broadcast bound, adaptive execution splits the partition that holds a third of the rows."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        left = spark.range(0, 300_000, numPartitions=16).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
        )
        right = spark.range(0, 300_000, 2).withColumnRenamed("id", "k")
        got = key_difference(left, right, ["k"])
        text = final_plan(got)
        assert "SortMergeJoin(skew=true)" in text
        assert got.filter("k = 7").count() == 100_000 + 1
    finally:
        for name in settings:
            spark.conf.unset(name)
