import shutil
from pathlib import Path
from types import SimpleNamespace

import pytest
from helpers import bag, plan
from pyspark.errors import AnalysisException
from pyspark.sql.types import StructType

from siltgate.sources import snapshot
from siltgate.sources.quarantine import read_quarantine, write_quarantine
from siltgate.sources.snapshot import (
    bucket_count,
    is_unique_on,
    latest_prior_date,
    read_bucketed,
    read_history,
    read_snapshot,
    snapshot_dates,
    write_snapshot,
)
from siltgate.sources.storage import exists, join_path, remove, scratch_folder, subfolders


@pytest.fixture
def base(tmp_path):
    return str(tmp_path / "Bronze's" / "carrier")


def rows(spark, n):
    return spark.range(n).withColumnRenamed("id", "k")


def test_dates_and_gaps(spark, base):
    assert snapshot_dates(spark, base) == []
    assert latest_prior_date(spark, base, 20240101) is None
    for day in (20231231, 20240105, 20240301):
        write_snapshot(rows(spark, 3), base, day)
    assert snapshot_dates(spark, base) == [20231231, 20240105, 20240301]
    assert latest_prior_date(spark, base, 20240301) == 20240105
    assert latest_prior_date(spark, base, 20240105) == 20231231
    assert latest_prior_date(spark, base, 20231231) is None


def die_half_way(spark, path):
    """Leave a folder as a job leaves it whose driver is lost while it commits."""
    remove(spark, join_path(path, "_SUCCESS"))
    (Path(path) / "_temporary" / "0").mkdir(parents=True)


def test_unfinished_snapshot_does_not_count(spark, base):
    write_snapshot(rows(spark, 3), base, 20240101)
    die_half_way(spark, write_snapshot(rows(spark, 5), base, 20240102))
    assert latest_prior_date(spark, base, 20240103) == 20240101
    assert read_history(spark, base).count() == 3
    write_snapshot(rows(spark, 7), base, 20240102, mode="errorifexists")
    assert latest_prior_date(spark, base, 20240103) == 20240102
    assert read_snapshot(spark, base, 20240102).count() == 7


def test_unfinished_quarantine_is_replaced(spark, base):
    write_quarantine(rows(spark, 3), base)
    write_quarantine(rows(spark, 4), base)
    assert read_quarantine(spark, base, "k bigint").count() == 3
    die_half_way(spark, base)
    write_quarantine(rows(spark, 4), base)
    assert read_quarantine(spark, base, "k bigint").count() == 4


@pytest.mark.parametrize("mode", ["ignore", "errorifexists"])
def test_files_of_unknown_origin_are_neither_replaced_nor_trusted(spark, base, mode):
    Path(base).mkdir(parents=True)
    (Path(base) / "theirs.csv").write_text("1\n")
    with pytest.raises(FileExistsError, match="no _SUCCESS"):
        write_quarantine(rows(spark, 3), base, mode=mode)
    assert (Path(base) / "theirs.csv").read_text() == "1\n"


def test_empty_folder_does_not_count(spark, base):
    Path(base).mkdir(parents=True)
    write_quarantine(rows(spark, 3), base)
    assert read_quarantine(spark, base, "k bigint").count() == 3


def test_overwrite_touches_one_date_only(spark, base):
    write_snapshot(rows(spark, 3), base, 20240101)
    write_snapshot(rows(spark, 5), base, 20240102)
    write_snapshot(rows(spark, 7), base, 20240102)
    assert [r["count"] for r in read_history(spark, base).groupBy("load_date").count().sort("load_date").collect()] == [
        3,
        7,
    ]
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        write_snapshot(rows(spark, 1), base, 20240102, mode="errorifexists")
    assert read_snapshot(spark, base, 20240102).count() == 7


def test_snapshot_built_from_an_earlier_one(spark, base):
    write_snapshot(rows(spark, 3), base, 20240101)
    write_snapshot(read_snapshot(spark, base, 20240101).union(rows(spark, 2)), base, 20240102)
    assert read_snapshot(spark, base, 20240102).count() == 5


def test_history_is_pruned_by_date(spark, base):
    for day in (20240101, 20240102):
        write_snapshot(rows(spark, 3), base, day)
    df = read_history(spark, base).filter("load_date = 20240102")
    assert "PartitionFilters: [isnotnull(load_date" in plan(df)
    assert df.count() == 3
    assert [r[0] for r in df.select("load_date").distinct().collect()] == [20240102]
    assert read_history(spark, base, as_of=20240101).count() == 3
    with pytest.raises(FileNotFoundError):
        read_history(spark, base, as_of=20230101)


def test_unique_note_is_kept_by_parquet_and_not_inherited(spark, base):
    write_snapshot(rows(spark, 3), base, 20240101, unique_on=["K"])
    noted = read_snapshot(spark, base, 20240101)
    assert is_unique_on(noted, ["k"]) and not is_unique_on(noted, ["k", "x"])
    write_snapshot(noted.union(noted), base, 20240102)
    assert not is_unique_on(read_snapshot(spark, base, 20240102), ["k"])
    assert bag(noted) == {(0,): 1, (1,): 1, (2,): 1}


def test_files_can_be_limited(spark, base):
    path = write_snapshot(rows(spark, 100).coalesce(1), base, 20240101, max_records_per_file=30)
    assert len(spark.read.parquet(path).inputFiles()) == 4


def test_empty_snapshot(spark, base):
    write_snapshot(rows(spark, 3).filter("k < 0"), base, 20240101)
    assert latest_prior_date(spark, base, 20240102) == 20240101
    assert read_snapshot(spark, base, 20240101).columns == ["k"]


def test_scratch_is_below_the_session_checkpoint_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_folder(spark), scratch_folder(spark)
    assert first != second and first.startswith(root) and exists(spark, first)
    assert first.rsplit("/", 1)[1] in subfolders(spark, root)
    remove(spark, first)
    assert not exists(spark, first) and exists(spark, second)


def test_bucketed_snapshot(spark, base):
    write_snapshot(rows(spark, 100).repartition(4, "k"), base, 20240101, unique_on=["k"], buckets=4)
    plain = read_snapshot(spark, base, 20240101)
    assert is_unique_on(plain, ["k"]) and bucket_count(plain) == 4
    assert latest_prior_date(spark, base, 20240102) == 20240101
    laid_out = read_bucketed(spark, base, 20240101)
    assert bag(laid_out) == bag(plain)
    assert "Exchange" not in plan(laid_out.groupBy("k").count())
    assert spark.sql("SHOW TABLES").filter("tableName LIKE 'siltgate%'").count() == 0
    with pytest.raises(FileExistsError):
        write_snapshot(rows(spark, 1), base, 20240101, mode="errorifexists", unique_on=["k"], buckets=4)
    write_snapshot(rows(spark, 5), base, 20240101, unique_on=["k"], buckets=4)
    assert read_bucketed(spark, base, 20240101).count() == 5
    write_snapshot(read_snapshot(spark, base, 20240101), base, 20240102)
    assert bucket_count(read_snapshot(spark, base, 20240102)) == 0


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077"])
def test_cluster_without_checkpoint_folder_is_refused(master):
    context = SimpleNamespace(getCheckpointDir=lambda: None, master=master)
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda name, default: default), sparkContext=context)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_folder(session)


def test_types_of_a_long_history_are_taken_from_the_notes(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    write_snapshot(spark.createDataFrame([(1, "a")], "k int, v string"), base, 20240101)
    for day in range(20240102, 20240301):
        shutil.copytree(tmp_path / "load_date=20240101", tmp_path / f"load_date={day}")
    schema = StructType.fromDDL("k int, v string, more double")
    with monkeypatch.context() as patched:
        patched.setattr(snapshot, "read_snapshot", lambda *_: pytest.fail("a data file was opened"))
        history = read_history(spark, base, schema=schema)
        assert history.count() == 200 and history.select("load_date").distinct().count() == 200
        with pytest.raises(TypeError, match="20240101: k is int"):
            read_history(spark, base, schema=StructType.fromDDL("k bigint"))
    # A day without a note is still judged, by its data.
    write_snapshot(spark.createDataFrame([(1.5,)], "k double"), base, 20240301)
    remove(spark, join_path(base, "load_date=20240301", snapshot.NOTE))
    with pytest.raises(TypeError, match="20240301: k is double"):
        read_history(spark, base, schema=schema)
