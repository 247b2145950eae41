"""Queries of the text operators against their SQL."""

import duckdb
import pandas as pd
import pytest

from siltgate.llm import queries


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, folder, name):
    connection = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    expected, actual = connection.execute(queries.SQL[name]).df(), queries.QUERIES[name](spark, folder).toPandas()
    assert len(actual) > 0 and set(actual.columns) == set(expected.columns)
    names = sorted(actual.columns)
    both = [f[names].sort_values(names, ignore_index=True) for f in (actual, expected)]
    pd.testing.assert_frame_equal(*both, check_dtype=False)
