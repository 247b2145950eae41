"""Rules and merges against plain Python on random input."""

import re
from collections import Counter

from helpers import at, bag
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from siltgate.functions.rules import Blank, CodeLength, SpecialChar
from siltgate.operators.difference import multiset_difference
from siltgate.operators.split import split

FEW = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
text = st.one_of(
    st.none(),
    st.sampled_from(["", "-1", "\\N", "none", "AB", "|*", "\t", "\x0b"]),
    st.text(st.characters(exclude_categories=["Cs"]), max_size=4),
)
rows = st.lists(st.tuples(text, text), min_size=1, max_size=60)


def reasons(row):
    """What the three rules say about a row, one character and one cell at a time."""
    found = []
    for name, value in zip("ab", row):
        odd = [c for c in value or "" if not re.fullmatch(r"[A-Za-z0-9|* \t\n\x0b\f\r]", c)]
        if odd:
            found.append(f"special_char:{name}:{odd[0]}")
    if row[0] in (None, "", "-1"):
        found.append("blank:a")
    if row[1] is None or len(row[1]) != 2:
        found.append("code_length:b")
    return tuple(found)


@FEW
@given(rows)
def test_split(spark, data):
    df = spark.createDataFrame(data, "a string, b string")
    good, bad = split(df, [SpecialChar(("a", "b")), Blank(("a",)), CodeLength({"b": 2})], at(1))
    assert bag(good, ["a", "b"]) == Counter(r for r in data if not reasons(r))
    assert bag(bad) == Counter((*r, reasons(r)) for r in data if reasons(r))


@FEW
@given(rows, rows, st.integers(1, 4))
def test_multiset_difference(spark, left, right, chunk):
    a, b = (spark.createDataFrame(d, "a string, b string") for d in (left, right))
    assert bag(multiset_difference(a, b, chunk)) == Counter(left) - Counter(right)
