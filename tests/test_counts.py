"""Counts observed while rows are written, sizes of files, headers by name, origins of rejected rows."""

import pytest
from pyspark.sql import functions as F

from siltgate.functions.rules import Blank, CodeLength, Corrupt, SpecialChar
from siltgate.operators.split import reason_counts, stage_split
from siltgate.plans.contracts import Contract
from siltgate.plans.daily import Layout, read_loaded, run_load
from siltgate.sources.feed import scan_csv, scan_csv_named
from siltgate.sources.quarantine import read_quarantine
from siltgate.sources.snapshot import read_note, write_snapshot
from siltgate.sources.storage import sizes_below
from tests.helpers import at, bag

RULES = [Corrupt("broken"), SpecialChar(("a", "b")), Blank(("a",)), CodeLength({"b": 2})]
ROWS = [("x", "ab", None), (None, "ab", None), ("-1", "a-", None), ("é", "abc", "line"), ("", None, None), ("ok", "é", None)]
EXPECTED = {
    "corrupt_record": 1, "special_char:a": 2, "special_char:b": 2, "blank:a": 3, "code_length:b": 3,
}


def test_reasons_are_counted_in_the_write(spark, tmp_path):
    df = spark.createDataFrame(ROWS, "a string, b string, broken string")
    counts = stage_split(df.repartition(3), RULES, str(tmp_path / "stage"))
    assert (counts.good_rows, counts.bad_rows, counts.by_reason) == (1, 5, EXPECTED)
    assert {r.reason: r.rows for r in reason_counts(df, RULES).collect()} == EXPECTED


@pytest.mark.parametrize("empty", ["filter", "list"])
def test_no_rows_are_counted_as_none(spark, tmp_path, empty):
    ddl = "a string, b string, broken string"
    df = spark.createDataFrame(ROWS, ddl).filter("false") if empty == "filter" else spark.createDataFrame([], ddl)
    counts = stage_split(df, RULES, str(tmp_path / "stage"))
    assert (counts.good_rows, counts.bad_rows) == (0, 0) and set(counts.by_reason.values()) == {0}
    write_snapshot(spark.range(5).where("id < 0"), str(tmp_path / "s"), 20240101)
    write_snapshot(spark.range(5).limit(0), str(tmp_path / "s"), 20240102)
    assert [read_note(spark, str(tmp_path / "s"), d)["rows"] for d in (20240101, 20240102)] == [0, 0]


def jobs(spark, work):
    spark.sparkContext.setJobGroup("counted", "")
    known = set(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
    work()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(set(spark.sparkContext.statusTracker().getJobIdsForGroup("counted")) - known)


def test_a_load_reports_reasons_and_runs_no_job_for_counts(spark, tmp_path):
    contract = Contract("s", "a string, b string", quality="blank", check_columns=("a",), code_lengths={"b": 2})
    layout = Layout(str(tmp_path / "in"), str(tmp_path / "lake"), str(tmp_path / "bad"))
    spark.createDataFrame(ROWS, "a string, b string, c string").select("a", "b").write.csv(layout.feed("s", 20240101))
    reports = []
    n = jobs(spark, lambda: reports.append(run_load(spark, contract, layout, 20240101, at(1))))
    assert (reports[0].good_rows, reports[0].bad_rows, reports[0].total_rows) == (1, 5, 1)
    assert reports[0].by_reason == {"blank:a": 3, "code_length:b": 3}
    assert n <= 4  # the judged stage, the quarantine, the snapshot, and one row for the form of the stamp
    assert read_loaded(spark, contract, layout, 20240101).count() == 1


def test_files_of_a_skewed_input_are_of_like_size(spark, tmp_path):
    rows = spark.range(400_000).select("id", F.xxhash64("id").alias("noise"), F.md5(F.col("id").cast("string")).alias("text"))
    skewed = rows.repartition(6, F.when(F.col("id") % 10 == 0, F.col("id") % 60).otherwise(0))
    path = write_snapshot(skewed, str(tmp_path), 20240101, file_bytes=2 << 20)
    sizes = sorted(b for n, b in sizes_below(spark, path).items() if n.endswith(".parquet"))
    assert len(sizes) > 4 and sizes[-1] <= 2 * sizes[1]  # one file may hold a rest
    assert spark.read.parquet(path).exceptAll(rows).isEmpty() and read_note(spark, str(tmp_path), 20240101)["rows"] == 400_000
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.parallelismFirst") == "true"


def test_columns_are_found_by_their_names(spark, tmp_path):
    files = {
        "a.csv": "id,a,b\n1,x,y\n", "b.csv": "﻿B, ID ,more,A\ny2,2,zzz,x2\n", "c.csv": "id,b\n3,lost\n", "d.csv": "id,a,b,A\n4,p,q,r\n",
        "e.csv": '"id","b","a"\n5,"y,5",x5\nsix,y6,x6\n', "f.csv": "id,a,b\n", "_hidden.csv": "id\n", "g.csv": "7,x7,y7\n",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    rows, refused = scan_csv_named(spark, str(tmp_path), "id int, a string, b string")
    assert rows.columns == ["id", "a", "b"]
    assert bag(rows) == {(1, "x", "y"): 1, (2, "x2", "y2"): 1, (5, "x5", "y,5"): 1, (None, "x6", "y6"): 1}
    assert {f.rsplit("/", 1)[-1]: why for f, why in refused.items()} == {
        "c.csv": "missing: a", "d.csv": "twice: a", "g.csv": "missing: id, a, b",
    }
    kept, _ = scan_csv_named(spark, str(tmp_path), "id int, a string, b string", keep_corrupt=True, origin=True)
    broken = kept.where("corrupt_line is not null").collect()
    assert [(r.corrupt_line, r._origin.rsplit("/", 1)[-1]) for r in broken] == [("six,y6,x6", "e.csv@0")]
    (tmp_path / "none").mkdir()
    rows, refused = scan_csv_named(spark, str(tmp_path / "none"), "id int")
    assert rows.columns == ["id"] and rows.isEmpty() and not refused


def test_origin_stays_out_of_the_snapshot(spark, tmp_path):
    layout = Layout(str(tmp_path / "in"), str(tmp_path / "lake"), str(tmp_path / "bad"))
    for mode, n in (("scd1", 1), ("append", 2), ("full", 3)):
        contract = Contract(mode, "k int, v string", merge_mode=mode, key=("k",), origin=True, keep_corrupt=mode != "full")
        (tmp_path / "in" / mode / "20240101").mkdir(parents=True)
        (tmp_path / "in" / mode / "20240101" / "f.csv").write_text("1,a\nx,b\n")
        run_load(spark, contract, layout, 20240101, at(1))
        assert read_loaded(spark, contract, layout, 20240101).columns == ["k", "v", "time_stamp"]
        if n < 3:
            bad = read_quarantine(spark, layout.quarantine(mode, 20240101), "k int, v string, line string, origin string, why string")
            assert [(r.line, r.origin.rsplit("/", 1)[-1]) for r in bad.collect()] == [("x,b", "f.csv@0")]
    plain = scan_csv(spark, str(tmp_path / "in" / "full" / "20240101"), "k int, v string")
    assert plain.columns == ["k", "v"]
