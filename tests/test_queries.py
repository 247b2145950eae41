"""Every registered query against its SQL twin."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_point
from siltgate.plans import catalog

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()
QUERIES, SQL = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module", params=["sf0.001", "sf0.01"])
def tables(request):
    folder = f"/root/testdata/{request.param}"
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    yield folder, connection
    connection.close()


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for name in frame.columns:
        if pd.api.types.is_datetime64_any_dtype(frame[name]):
            frame[name] = frame[name].astype("datetime64[us]").astype("string")
        elif frame[name].dtype == object or pd.api.types.is_string_dtype(frame[name]):
            frame[name] = frame[name].map(lambda v: None if v is None or v is pd.NA or v != v else str(v))
    order = frame.astype("string").fillna("\0")
    return frame.loc[order.sort_values(list(order.columns), kind="stable").index].reset_index(drop=True)


def test_every_query_has_sql():
    assert set(SQL) >= set(catalog.QUERIES)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_sql(spark, tables, name):
    folder, connection = tables
    result = QUERIES[name](spark, folder)
    expected = connection.execute(SQL[name]).df()
    actual = result.toPandas()
    assert len(actual) > 0
    assert sorted(actual.columns) == sorted(expected.columns)
    assert len(actual) == len(expected)
    pd.testing.assert_frame_equal(normal(actual), normal(expected), check_dtype=False)


def test_entry_runs(spark):
    assert entry_point.entry(spark).count() > 0
