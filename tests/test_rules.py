from datetime import date, datetime
from itertools import product

import pytest
from helpers import at, bag, plan
from pyspark.sql import functions as F

from siltgate.functions.rules import (
    Blank, CodeLength, SpecialChar, boolean_flag, rejected, reject_reasons, scrub, special_chars,
)
from siltgate.functions.dates import business_date, date_key, previous_date_key, run_date_for
from siltgate.operators.split import special_char_split, split, split_counts


def one(spark, ddl, *values):
    return spark.createDataFrame([values], ddl)


@pytest.mark.parametrize(
    "text, found",
    [
        ("plain Text 09", ""),
        ("tab\tand | and *", ""),
        ("", ""),
        (None, ""),
        ("A-B_C", "-"),
        ("under_score", "_"),
        ("dot.", "."),
        ("(x", "("),
        ("Zürich", "ü"),
        ("back\\slash", "\\"),
        ("no break", " "),
        ("plane \U0001f6e9 -", "\U0001f6e9"),
        ("two\nlines\r\n-", "-"),
        ("\x0b\x0c\x85", "\x85"),
        ("word " * 2000 + "é", "é"),
    ],
)
def test_special_char(spark, text, found):
    df = one(spark, "a string", text)
    assert df.select(special_chars(["a"])).first()[0] == found
    assert df.select(rejected([SpecialChar(("a",))], df.schema)).first()[0] is (found != "")


def test_special_chars_are_joined_in_column_order(spark):
    df = one(spark, "a string, b string, c string, n int", "x#-", None, "é.", -7)
    assert df.select(special_chars(["c", "a", "b", "n"])).first()[0] == "é#-"


def test_special_char_split_keeps_rows_with_null(spark):
    df = spark.createDataFrame([(1, None, "ok"), (2, "a#", "b-"), (3, "fine", "fine")], "k int, a string, b string")
    good, bad = special_char_split(df, ["a", "b"], at(1))
    assert bag(good) == bag(spark.createDataFrame([(1, None, "ok", at(1)), (3, "fine", "fine", at(1))], good.schema))
    assert [tuple(r) for r in bad.collect()] == [(2, "a#", "b-", "#-")]


@pytest.mark.parametrize("position", [0, 1, 2])
@pytest.mark.parametrize("value", [None, "", "-1"])
def test_blank_in_any_checked_column(spark, position, value):
    values = ["x", "y", "z"]
    values[position] = value
    df = one(spark, "a string, b string, c string", *values)
    good, bad = split(df, [Blank(("a", "b", "c"))], at(1))
    assert good.count() == 0
    assert bad.first()["reject_reasons"] == [f"blank:{'abc'[position]}"]
    assert tuple(bad.first())[:3] == tuple(values)


@pytest.mark.parametrize("value", ["none", "\\N", " ", "-1 ", "--1", "0"])
def test_other_texts_are_not_blank(spark, value):
    df = one(spark, "a string", value)
    assert df.select(rejected([Blank(("a",))], df.schema)).first()[0] is False


def test_blank_compares_numbers_by_value_and_leaves_other_types(spark):
    df = spark.createDataFrame(
        [(-1, 1.0, True), (1, -1.0, True), (1, 1.0, None), (1, 1.0, False), (None, 1.0, True)],
        "i int, d double, b boolean",
    )
    flags = [r[0] for r in df.select(rejected([Blank(("i", "d", "b"))], df.schema)).collect()]
    assert flags == [True, True, True, False, True]


def test_blank_on_decimal(spark):
    df = spark.sql("SELECT explode(array(-1.0, 2.5, NULL)) AS d")
    assert [r[0] for r in df.select(rejected([Blank(("d",))], df.schema)).collect()] == [True, False, True]


@pytest.mark.parametrize(
    "iata, icao, reasons",
    [
        ("AB", "ABC", []),
        ("A", "ABC", ["code_length:IATA"]),
        ("ABC", "ABC", ["code_length:IATA"]),
        ("AB", "AB", ["code_length:ICAO"]),
        ("AB", "ABCD", ["code_length:ICAO"]),
        (None, None, ["code_length:IATA", "code_length:ICAO"]),
    ],
)
def test_code_length_with_names_in_other_case(spark, iata, icao, reasons):
    df = one(spark, "iata string, icao string", iata, icao)
    assert df.select(reject_reasons([CodeLength({"IATA": 2, "ICAO": 3})], df.schema)).first()[0] == reasons


def test_rule_on_a_missing_column_is_an_error(spark):
    df = one(spark, "a string", "x")
    with pytest.raises(ValueError, match="no column 'b'"):
        rejected([Blank(("b",))], df.schema)


def test_scrub(spark):
    df = spark.createDataFrame(
        [("\\N", "none", 1), (None, None, None), ("", "-1", 2), ("x\\N", "None", 3)], "a string, b string, n int"
    )
    assert [tuple(r) for r in scrub(df, ["a", "b", "n"]).collect()] == [
        ("", "", 1),
        ("", "", None),
        ("", "-1", 2),
        ("x\\N", "None", 3),
    ]


def test_no_rule_accepts_all(spark):
    df = one(spark, "a string", None)
    good, bad = split(df, [], at(1))
    assert (good.count(), bad.count()) == (1, 0)


def test_split_conserves_every_row(spark):
    values = [None, "", "-1", "\\N", "none", "AB", "A-B", "Ä", "a|*\t"]
    df = spark.createDataFrame(list(product(values, values)) * 2, "a string, b string")
    for rules in (
        [SpecialChar(("a", "b"))],
        [Blank(("a", "b"))],
        [CodeLength({"a": 2})],
        [SpecialChar(("b",)), Blank(("a",)), CodeLength({"a": 2, "b": 2})],
    ):
        good, bad = split(df, rules, at(1))
        assert bag(good, ["a", "b"]) + bag(bad, ["a", "b"]) == bag(df)
        assert bad.filter("size(reject_reasons) = 0").count() == 0
        counts = split_counts(df, rules).first()
        assert (counts.good_rows, counts.bad_rows) == (good.count(), bad.count())


def test_boolean_words(spark):
    words = ["Y", "n", " TRUE ", "false", "1", "maybe", None, ""]
    df = spark.createDataFrame([(w,) for w in words], "a string")
    flags = [r[0] for r in df.select(boolean_flag("a")).collect()]
    assert flags == [True, False, True, False, None, None, None, None]


def test_dates(spark):
    assert run_date_for(datetime(2024, 1, 1, 0, 30)) == 20231230
    assert previous_date_key(20240301) == 20240229
    assert date_key(date(2024, 2, 3)) == 20240203
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 00:30:00' AS ts")
    assert df.select(business_date(F.col("ts"))).first()[0] == 20231230


def test_null_and_placeholder_tests_reach_the_parquet_scan(spark, tmp_path):
    one(spark, "a string, b string", "x", "yy").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    good, _ = split(df, [Blank(("a",)), CodeLength({"b": 2})], at(1))
    text = plan(good)
    pushed = text[text.index("PushedFilters") : text.index("ReadSchema")]
    assert "IsNotNull(a)" in pushed and "IsNotNull(b)" in pushed and "Not(" in pushed
    assert "Exchange" not in text
