from dataclasses import replace
from decimal import Decimal
from pathlib import Path

import pytest
from helpers import at, bag
from samples import DAILY, SINGLE_FILE
from pyspark.errors import AnalysisException

from siltgate.plans import daily
from siltgate.plans.contracts import Contract
from siltgate.plans.daily import Layout, read_loaded, run_load
from siltgate.sources.quarantine import read_quarantine
from siltgate.sources.snapshot import bucket_count, is_unique_on, read_snapshot, snapshot_dates
from siltgate.sources.storage import exists, scratch_folder


@pytest.fixture
def layout(tmp_path):
    return Layout(str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "bad"))


def put(layout, source, day, *lines):
    folder = Path(layout.feed(source, day))
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{source}.csv").write_text("".join(line + "\n" for line in lines), encoding="utf-8")


def carrier(key, name="Air", short="AA", long="AAA", active="Y"):
    return f"{key},{name},\\N,{short},{long},CALL,Land,{active}"


def test_carrier_first_load_then_merges(spark, layout):
    contract = DAILY["carrier"]
    put(layout, "carrier", 20240101, carrier(1), carrier(1, "Twice"), carrier(2), carrier(3, short="TOO"),
        carrier(4, long=""), carrier(-1))
    first = run_load(spark, contract, layout, 20240101, at(1))
    assert (first.prior_date, first.good_rows, first.bad_rows, first.total_rows) == (None, 3, 3, 3)
    bad = read_quarantine(
        spark, layout.quarantine("carrier", 20240101), f"{contract.schema}, corrupt_line string, reject_reasons string"
    )
    assert {(r.carrier_id, r.reject_reasons) for r in bad.collect()} == {
        (3, "code_length:short"),
        (4, "blank:long; code_length:long"),
        (-1, "blank:carrier_id"),
    }

    put(layout, "carrier", 20240102, carrier(2, "New"), carrier(9))
    second = run_load(spark, contract, layout, 20240102, at(2))
    assert (second.prior_date, second.total_rows) == (20240101, 3)
    base = layout.snapshots("carrier")
    assert not is_unique_on(read_snapshot(spark, base, 20240101), ["carrier_id"])
    assert is_unique_on(read_snapshot(spark, base, 20240102), ["carrier_id"])

    put(layout, "carrier", 20240105, carrier(1, "Newest", active="N"))
    third = run_load(spark, contract, layout, 20240105, at(5), sort_by_key=True)
    assert (third.prior_date, third.good_rows, third.total_rows) == (20240102, 1, 3)
    now = read_loaded(spark, contract, layout, 20240131)
    assert bag(now, ["carrier_id", "name", "active", "time_stamp"]) == {
        (1, "Newest", False, at(5)): 1,
        (2, "New", True, at(2)): 1,
        (9, "Air", True, at(2)): 1,
    }
    assert read_loaded(spark, contract, layout, 20240104).filter("name = 'Newest'").count() == 0


def test_rerun_of_a_day_changes_only_that_day(spark, layout):
    contract = DAILY["carrier"]
    for day, name in ((1, "a"), (2, "b"), (3, "c")):
        put(layout, "carrier", 20240100 + day, carrier(1, name), carrier(10 + day))
        run_load(spark, contract, layout, 20240100 + day, at(day))
    base = layout.snapshots("carrier")
    before = {d: bag(read_snapshot(spark, base, d)) for d in snapshot_dates(spark, base)}
    again = run_load(spark, contract, layout, 20240102, at(2))
    assert again.prior_date == 20240101
    assert {d: bag(read_snapshot(spark, base, d)) for d in snapshot_dates(spark, base)} == before


def test_bucketed_source_gives_the_same_table(spark, layout, tmp_path):
    plain, bucketed = DAILY["carrier"], replace(DAILY["carrier"], buckets=4)
    other = Layout(layout.input_base, str(tmp_path / "out2"), str(tmp_path / "bad2"))
    for day in (1, 2, 3, 4):
        put(layout, "carrier", 20240100 + day, *[carrier(k, f"day{day}") for k in range(day, 12, day)], carrier(1))
        reports = [
            run_load(spark, contract, place, 20240100 + day, at(day))
            for contract, place in ((plain, layout), (bucketed, other))
        ]
        assert reports[0].total_rows == reports[1].total_rows
    base = other.snapshots("carrier")
    assert [bucket_count(read_snapshot(spark, base, 20240100 + d)) for d in (1, 2, 3, 4)] == [4, 4, 4, 4]
    assert bag(read_loaded(spark, plain, layout, 20240104)) == bag(read_loaded(spark, bucketed, other, 20240104))


def test_guarded_load_refuses_a_second_run(spark, layout):
    put(layout, "craft", 20240101, "A,B,C")
    run_load(spark, DAILY["craft"], layout, 20240101, at(1), snapshot_mode="errorifexists")
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        run_load(spark, DAILY["craft"], layout, 20240101, at(1), snapshot_mode="errorifexists")


def test_station(spark, layout):
    line = "{0},{1},City,Land,ABC,ABCD,-6.081689834590001,145.391998291,5282,10,U,Pacific/Port,station,Ours"
    put(layout, "station", 20240101, line.format(1, "Plain"), line.format(2, "Da-sh"), line.format(3, ""))
    report = run_load(spark, DAILY["station"], layout, 20240101, at(1))
    assert (report.good_rows, report.bad_rows) == (2, 1)
    got = read_loaded(spark, DAILY["station"], layout, 20240101).filter("station_id = 1").first()
    assert (got.latitude, got.longitude) == (Decimal("-6.081689835"), Decimal("145.391998291"))


def test_leg_appends_and_scrubs(spark, layout):
    lines = ["2B,410,AER,2965,KZN,2990,,0,CR2", "\\N,\\N,none,1,KZN,2,Y,0,\\N"]
    for day in (1, 2):
        put(layout, "leg", 20240100 + day, *lines)
        report = run_load(spark, DAILY["leg"], layout, 20240100 + day, at(day))
        assert (report.good_rows, report.bad_rows, report.total_rows) == (2, 0, 2 * day)
    run_load(spark, DAILY["leg"], layout, 20240102, at(2))
    now = read_loaded(spark, DAILY["leg"], layout, 20240102)
    assert bag(now, ["carrier", "carrier_id", "start", "shared", "equipment"]) == {
        ("2B", 410, "AER", "", "CR2"): 2,
        ("", None, "", "Y", ""): 2,
    }
    assert {r[0] for r in now.select("time_stamp").distinct().collect()} == {at(1), at(2)}
    assert read_loaded(spark, DAILY["leg"], layout, 20240101).count() == 2


def test_craft_passes_through_and_replaces(spark, layout):
    put(layout, "craft", 20240101, "A-1,\\N,", "B,B2,B22")
    put(layout, "craft", 20240102, "C,C2,C22")
    assert run_load(spark, DAILY["craft"], layout, 20240101, at(1)).total_rows == 2
    assert run_load(spark, DAILY["craft"], layout, 20240102, at(2)).total_rows == 1
    assert bag(read_loaded(spark, DAILY["craft"], layout, 20240101)) == {
        ("A-1", "\\N", None, at(1)): 1,
        ("B", "B2", "B22", at(1)): 1,
    }


def test_single_file_with_header(spark, layout, tmp_path):
    path = tmp_path / "craft.csv"
    path.write_text("Name,Short code,Long code\nBig,B1,B11\n,B2,B22\nSmall,-1,S11\n")
    contract = SINGLE_FILE["craft"]
    for _ in range(2):
        report = run_load(spark, contract, layout, 20240101, at(1), input_path=str(path))
        assert (report.good_rows, report.bad_rows) == (1, 2)
    schema = f"{contract.schema}, reject_reasons string"
    bad = read_quarantine(spark, layout.quarantine("craft", 20240101), schema, header=True)
    assert {r.reject_reasons for r in bad.collect()} == {"blank:Name", "blank:short_code"}


def test_corrupt_lines_go_to_quarantine_when_wanted(spark, layout):
    contract = replace(DAILY["carrier"], keep_corrupt=True)
    put(layout, "carrier", 20240101, carrier(1), carrier("x"), "2,short")
    report = run_load(spark, contract, layout, 20240101, at(1))
    assert (report.good_rows, report.bad_rows) == (1, 2)
    schema = f"{contract.schema}, corrupt_line string, reject_reasons string"
    bad = read_quarantine(spark, layout.quarantine("carrier", 20240101), schema)
    assert {r.corrupt_line for r in bad.collect()} == {carrier("x"), "2,short"}
    assert all(r.reject_reasons.startswith("corrupt_record") for r in bad.collect())


@pytest.mark.parametrize("lines", [[], [carrier(1, short="")]])
def test_day_without_good_rows_keeps_the_table(spark, layout, lines):
    contract = DAILY["carrier"]
    put(layout, "carrier", 20240101, carrier(1))
    put(layout, "carrier", 20240102, *lines)
    run_load(spark, contract, layout, 20240101, at(1))
    report = run_load(spark, contract, layout, 20240102, at(2))
    assert (report.good_rows, report.bad_rows, report.total_rows) == (0, len(lines), 1)
    put(layout, "carrier", 20240103, *lines)
    assert run_load(spark, contract, layout, 20240103, at(3)).total_rows == 1


def test_stage_is_removed_even_when_the_load_fails(spark, layout, monkeypatch):
    made = []
    monkeypatch.setattr(daily, "scratch_folder", lambda s: made.append(scratch_folder(s)) or made[-1])
    monkeypatch.setattr(daily, "write_snapshot", lambda *a, **k: 1 / 0)
    put(layout, "carrier", 20240101, carrier(1))
    with pytest.raises(ZeroDivisionError):
        run_load(spark, DAILY["carrier"], layout, 20240101, at(1))
    assert len(made) == 1 and not exists(spark, made[0])


def test_scd1_contract_needs_a_key():
    with pytest.raises(ValueError, match="needs a key"):
        Contract("x", "a int", merge_mode="scd1")
