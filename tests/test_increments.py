"""Tables kept as days and compacted states: reads by date, files taken over, publication, columns that change."""

from datetime import datetime
from functools import reduce

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltgate.operators.columns import reconciled, wider
from siltgate.operators.latest import latest_per_key
from siltgate.plans import increments
from siltgate.plans.increments import Increments, compact, load_day, read_as_of, retire_states
from siltgate.sources.published import publish, read_state, remove_unreferenced
from siltgate.sources.snapshot import latest_prior_date, read_snapshot, snapshot_dates, write_snapshot
from siltgate.sources.storage import PARKED, entries, exists, join_path, sizes_below, write_note
from tests.helpers import bag, final_plan

ROW = "k long, v string, time_stamp timestamp"


def at(day, hour=0):
    return datetime(2024, 1, day, hour)


def held(spark, table):
    """Files that the newest state names, and their bytes."""
    names = sorted(read_state(spark, table.folder).files())
    folders = {n.rsplit("/", 1)[0] for n in names}
    sizes = {join_path(f, n): b for f in folders for n, b in sizes_below(spark, join_path(table.folder, f)).items()}
    return {n: sizes[n] for n in names}


def test_a_small_day_writes_little(spark, tmp_path):
    lines = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    key = ("l_orderkey", "l_linenumber")
    table = Increments(str(tmp_path), key, "l_shipdate", file_bytes=1 << 18)
    load_day(spark, table, lines, 20240101)
    base = compact(spark, table).bytes_written
    before = held(spark, table)
    day = lines.where("l_orderkey % 100 = 0").withColumn("l_shipdate", F.lit("2040-01-01").cast("timestamp_ntz"))
    state = load_day(spark, table, day, 20240102)
    assert state.days[20240102].bytes < 0.05 * base
    assert {n: b for n, b in held(spark, table).items() if n not in before} == {
        n: b for n, b in held(spark, table).items() if n in state.days[20240102].files
    }
    assert compact(spark, table) is None  # far under the share
    expected = latest_per_key(lines.unionByName(day), list(key), "l_shipdate")
    assert bag(read_as_of(spark, table)) == bag(expected)


def test_reading_does_not_move_the_state(spark, tmp_path):
    table = Increments(str(tmp_path), ("k",))
    load_day(spark, table, spark.range(5000).selectExpr("id k", "'a' v", "timestamp '2024-01-01' time_stamp"), 1)
    compact(spark, table)
    load_day(spark, table, spark.range(10).selectExpr("id k", "'b' v", "timestamp '2024-01-02' time_stamp"), 2)
    plan = final_plan(read_as_of(spark, table).where("v = 'a'"))
    assert "LeftAnti" in plan and "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    state = plan[plan.index("LeftAnti") : plan.index("BroadcastExchange")]
    assert "hashpartitioning" not in state


def test_only_touched_files_are_rewritten(spark, tmp_path):
    table = Increments(str(tmp_path), ("k",), file_bytes=2000)
    rows = spark.range(20_000).selectExpr("id k", "cast(id as string) v", "timestamp '2024-01-01' time_stamp")
    load_day(spark, table, rows, 1)
    compact(spark, table)
    first = read_state(spark, str(tmp_path)).bases[0].part
    assert len(first.files) > 10 and first.rows == 20_000
    load_day(spark, table, spark.createDataFrame([(5, "new", at(2)), (6, "old", at(1, 0)), (-1, "added", at(2))], ROW), 2)
    done = compact(spark, table, share=0)
    second = done.state.bases[-1].part
    taken = set(first.files) & set(second.files)
    assert done.kept_files == len(taken) == len(first.files) - done.rewritten_files and 1 <= done.rewritten_files <= 2
    assert second.rows == 20_001 and done.bytes_written < 0.3 * first.bytes
    assert bag(read_as_of(spark, table).where("k in (-1, 5, 7)"), ["k", "v"]) == {(-1, "added"): 1, (5, "new"): 1, (7, "7"): 1}
    assert read_as_of(spark, table, 1).where("v = 'new'").isEmpty()
    # Many files, few of them named any more once the first state is retired.
    retire_states(spark, table, 3)
    assert [b.date for b in read_state(spark, str(tmp_path)).bases] == [2]
    remove_unreferenced(spark, str(tmp_path))
    assert read_as_of(spark, table).count() == 20_001 and read_as_of(spark, table, 1).count() == 20_000


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_any_order_of_loads_and_compactions_reads_alike(spark, tmp_path, seed):
    """Late, repeated and corrected days with NULL keys, NULL stamps and ties, against all days merged at once."""
    random = np.random.default_rng(seed)
    table = Increments(str(tmp_path), ("k", "v2"), file_bytes=500, broadcast_bytes=-1 if seed == 3 else 1 << 20)
    schema, days = "k long, v2 string, v string, time_stamp timestamp", {}
    for step in range(7):
        date = int(random.choice([1, 2, 3, 5, 8]))
        n = int(random.integers(0, 40))
        rows = [
            (
                None if random.random() < 0.1 else int(random.integers(0, 15)),
                None if random.random() < 0.1 else str(random.integers(0, 2)),
                f"{step}-{i % 3}",
                None if random.random() < 0.1 else at(int(random.integers(1, 6))),
            )
            for i in range(n)
        ]
        days[date] = spark.createDataFrame(rows, schema)
        load_day(spark, table, days[date], date)
        if random.random() < 0.6:
            compact(spark, table, int(random.choice(list(days))), share=float(random.choice([0, 0.2])))
        for as_of in days:
            due = reduce(DataFrame.unionByName, [d for date, d in days.items() if date <= as_of])
            assert bag(read_as_of(spark, table, as_of)) == bag(latest_per_key(due, list(table.key)))


def test_a_failed_load_changes_nothing(spark, tmp_path):
    table = Increments(str(tmp_path), ("k",))
    load_day(spark, table, spark.createDataFrame([(1, "a", at(1))], ROW), 1)
    before = read_state(spark, str(tmp_path))
    bad = spark.range(1000).selectExpr("id k", "if(id = 999, raise_error('disk lost'), 'b') v", "timestamp '2024-01-01' time_stamp")
    with pytest.raises(PySparkException):
        load_day(spark, table, bad, 1)
    assert read_state(spark, str(tmp_path)) == before and bag(read_as_of(spark, table), ["k", "v"]) == {(1, "a"): 1}
    # What it left is named by no state; neither is a note that was never moved to its place.
    write_note(spark, f"{tmp_path}/_versions/_half", "{")
    assert remove_unreferenced(spark, str(tmp_path)) == 1
    assert read_state(spark, str(tmp_path)) == before and len(entries(spark, f"{tmp_path}/data")) == 1


def test_two_writers_both_count(spark, tmp_path):
    table, tries = Increments(str(tmp_path), ("k",)), []
    load_day(spark, table, spark.createDataFrame([(1, "a", at(1))], ROW), 1)

    def change(state):
        tries.append(state.version)
        if len(tries) == 1:  # another writer publishes meanwhile
            load_day(spark, table, spark.createDataFrame([(2, "b", at(2))], ROW), 2)
        return increments.replace(state, days={**state.days, 3: state.days[1]})

    assert publish(spark, str(tmp_path), change).version == 3 and tries == [1, 2]
    assert sorted(read_state(spark, str(tmp_path)).days) == [1, 2, 3]
    assert sorted(read_state(spark, str(tmp_path), 2).days) == [1, 2]


def test_compaction_gives_up_when_a_day_is_replaced_meanwhile(spark, tmp_path, monkeypatch):
    table = Increments(str(tmp_path), ("k",))
    load_day(spark, table, spark.createDataFrame([(1, "a", at(1))], ROW), 1)
    real = increments.publish

    def late(*args):
        monkeypatch.setattr(increments, "publish", real)
        load_day(spark, table, spark.createDataFrame([(1, "corrected", at(1))], ROW), 1)
        return real(*args)

    monkeypatch.setattr(increments, "publish", late)
    with pytest.raises(RuntimeError):
        compact(spark, table)
    assert bag(read_as_of(spark, table), ["v"]) == {("corrected",): 1}


def test_columns_of_days_may_differ(spark, tmp_path):
    table = Increments(str(tmp_path), ("k",))
    load_day(spark, table, spark.createDataFrame([(1, 10, at(1)), (2, 20, at(1))], "k int, n int, time_stamp timestamp"), 1)
    compact(spark, table)
    load_day(spark, table, spark.createDataFrame([(2**40, 2.5, "x", at(2))], "k long, N double, extra string, time_stamp timestamp"), 2)
    made = read_as_of(spark, table)
    assert made.schema["k"].dataType.simpleString() == "bigint" and made.schema["n"].dataType.simpleString() == "double"
    assert bag(made.drop("time_stamp")) == {(1, 10.0, None): 1, (2, 20.0, None): 1, (2**40, 2.5, "x"): 1}
    before = read_state(spark, str(tmp_path))
    with pytest.raises(TypeError, match="column n"):
        load_day(spark, table, spark.createDataFrame([(1, "ten", at(3))], "k long, n string, time_stamp timestamp"), 3)
    assert read_state(spark, str(tmp_path)) == before and len(entries(spark, f"{tmp_path}/data")) == 3
    compact(spark, table, share=0)
    assert bag(read_as_of(spark, table).drop("time_stamp")) == bag(made.drop("time_stamp"))


@pytest.mark.parametrize(
    ("one", "other", "both"),
    [
        ("int", "bigint", "bigint"), ("smallint", "tinyint", "smallint"), ("float", "double", "double"), ("int", "double", "double"),
        ("bigint", "double", None), ("int", "float", None), ("int", "decimal(12,2)", "decimal(12,2)"), ("bigint", "decimal(12,2)", "decimal(22,2)"),
        ("decimal(10,4)", "decimal(12,2)", "decimal(14,4)"), ("decimal(38,0)", "decimal(38,10)", None), ("date", "timestamp_ntz", "timestamp_ntz"),
        ("string", "int", None), ("boolean", "int", None), ("string", "string", "string"),
    ],
)
def test_wider_types(one, other, both):
    types = [StructType.fromDDL(f"x {t}")["x"].dataType for t in (one, other)]
    for pair in (types, types[::-1]):
        made = wider(*pair)
        assert (made and made.simpleString()) == both


def test_frames_alike_pass_as_they_are(spark):
    one, other = spark.range(3), spark.range(4)
    assert reconciled(one, other) == (one, other)


def test_a_failed_rerun_leaves_the_snapshot(spark, tmp_path):
    base = str(tmp_path)
    write_snapshot(spark.range(5), base, 20240101)
    bad = spark.range(1000).select(F.when(F.col("id") == 999, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(PySparkException):
        write_snapshot(bad, base, 20240101)
    assert read_snapshot(spark, base, 20240101).count() == 5 and entries(spark, base) == ["load_date=20240101"]
    # A run that died between parking the old folder and moving the new one: the next write of any day brings it back.
    (tmp_path / "load_date=20240101").rename(tmp_path / f"{PARKED}load_date=20240101")
    assert latest_prior_date(spark, base, 20240103) is None
    write_snapshot(spark.range(7), base, 20240102)
    assert snapshot_dates(spark, base) == [20240101, 20240102] and read_snapshot(spark, base, 20240101).count() == 5
    write_snapshot(spark.range(9), base, 20240102)
    assert read_snapshot(spark, base, 20240102).count() == 9 and not exists(spark, join_path(base, f"{PARKED}load_date=20240102"))
