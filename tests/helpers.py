"""Small helpers shared by the tests."""

import contextlib
import io
from collections import Counter
from datetime import datetime


def bag(df, columns=None):
    """Rows of a frame as a multiset, lists made hashable."""
    rows = df.select(*(columns or df.columns)).collect()
    return Counter(tuple(tuple(v) if isinstance(v, list) else v for v in r) for r in rows)


def plan(df, mode="simple"):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


def final_plan(df):
    """The plan as adaptive execution ended it."""
    df._jdf.collectToPython()
    text = plan(df)
    return text.split("== Initial Plan ==")[0]


def at(day, hour=6):
    return datetime(2024, 1, day, hour)
