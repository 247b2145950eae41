from decimal import Decimal

import pytest
from helpers import bag

from siltgate.operators.split import split
from siltgate.functions.rules import Corrupt
from samples import DAILY, SINGLE_FILE
from siltgate.sources.feed import declared_schema, parse_declaration, scan_csv
from siltgate.sources.quarantine import read_quarantine, write_quarantine

DDL = "id int, name string, size decimal(18,9)"


def feed(tmp_path, *lines, name="feed.csv"):
    tmp_path.mkdir(exist_ok=True)
    path = tmp_path / name
    path.write_text("".join(line + "\n" for line in lines), encoding="utf-8")
    return str(path)


def test_folder_without_headers(spark, tmp_path):
    feed(tmp_path, "1,a,1.5", name="one.csv")
    feed(tmp_path, "2,b,151.211", name="two.csv")
    rows = bag(scan_csv(spark, str(tmp_path), DDL))
    assert rows == {(1, "a", Decimal("1.500000000")): 1, (2, "b", Decimal("151.211000000")): 1}


def test_header_is_skipped_and_names_go_by_position(spark, tmp_path):
    path = feed(tmp_path, "Name,Short code,Long code", "Big One,B1,\\N", ",,X")
    df = scan_csv(spark, path, DAILY["craft"].schema, header=True)
    assert df.columns == ["Name", "short_code", "long_code"]
    assert bag(df) == {("Big One", "B1", "\\N"): 1, (None, None, "X"): 1}


def test_misfits_are_null_by_default(spark, tmp_path):
    path = feed(tmp_path, "x,a,1", "2,b", "3,c,4,5")
    assert [tuple(r) for r in scan_csv(spark, path, DDL).collect()] == [
        (None, "a", Decimal(1)),
        (2, "b", None),
        (3, "c", Decimal(4)),
    ]


@pytest.mark.parametrize("columns", [["name"], ["id"], ["size"], ["id", "name", "size"]])
def test_corrupt_lines_are_the_same_whatever_is_selected(spark, tmp_path, columns):
    path = feed(tmp_path, "1,a,1", "x,b,1", "2,c", "3,d,4,5", "4,e,six", "5,f,7")
    good, bad = split(scan_csv(spark, path, DDL, keep_corrupt=True), [Corrupt()], None)
    assert good.select(*columns).count() == 2
    assert len(good.select(*columns).collect()) == 2
    assert bad.count() == 4
    assert {r[0] for r in bad.select("corrupt_line").collect()} == {"x,b,1", "2,c", "3,d,4,5", "4,e,six"}
    assert "corrupt_line" not in good.columns


def test_flags_are_read_as_words(spark, tmp_path):
    path = feed(tmp_path, "1,Y", "2,N", "3,true", "4,?")
    df = scan_csv(spark, path, "id int, active boolean", keep_corrupt=True, flags=["ACTIVE"])
    assert df.schema["active"].dataType.typeName() == "boolean"
    assert [tuple(r) for r in df.collect()] == [(1, True, None), (2, False, None), (3, True, None), (4, None, "4,?")]


def test_declared_schema(spark):
    schema = declared_schema(
        [("i", "Integer\n"), ("s", "string"), ("d", "double"), ("b", "boolean"), ("x", "decimal"),
         ("y", "decimal(10,8)"), ("z", "geometry")]
    )
    assert [f.dataType.simpleString() for f in schema] == [
        "int", "string", "double", "boolean", "decimal(18,9)", "decimal(10,8)", "string",
    ]
    assert all(f.nullable for f in schema)


@pytest.mark.parametrize("contracts", [DAILY, SINGLE_FILE])
def test_contracts_name_real_columns(spark, contracts):
    for contract in contracts.values():
        df = spark.createDataFrame([], contract.schema)
        names = [*contract.check_columns, *contract.key, *contract.flags, *contract.code_lengths]
        assert df.select(*names).count() == 0
        quality = {"special_char": 1, "blank": 1}.get(contract.quality, 0)
        assert len(contract.rules) == quality + bool(contract.code_lengths) + (contract.merge_mode == "scd1")


def test_quarantine_round_trip_of_awkward_texts(spark, tmp_path):
    texts = ["", None, " lead", "trail ", 'say "hi"', "a,b", "back\\", 'mix\\"ed, ', "\\N", '""', "'", "#x", "é",
             "\x01", "tab\t", 'a "quoted," part', '"', ',"', '",']
    rows = [(i, t, ["blank:a", "x;y"]) for i, t in enumerate(texts)]
    bad = spark.createDataFrame(rows, "id int, a string, reject_reasons array<string>")
    for header in (True, False):
        path = str(tmp_path / f"bad{header}")
        write_quarantine(bad, path, header=header)
        back = read_quarantine(spark, path, "id int, a string, reject_reasons string", header=header)
        assert {r.id: r.a for r in back.collect()} == dict(enumerate(texts))
        assert {r.reject_reasons for r in back.collect()} == {"blank:a; x;y"}


def test_declaration_text(spark):
    schema, checked = parse_declaration("id integer\n\nname string col\nprice, decimal(10,2), col\nshape geometry\n")
    assert [(f.name, f.dataType.simpleString()) for f in schema] == [
        ("id", "int"), ("name", "string"), ("price", "decimal(10,2)"), ("shape", "string"),
    ]
    assert checked == ["name", "price"]
    with pytest.raises(ValueError, match="needs a name and a type"):
        parse_declaration("lonely")
