"""Every registered query against its SQL twin: names, types and values."""

import pytest
from compare import connect, spark_rows, sql_rows, sql_types

import __spark_entry__ as entry
from meterlab.catalog import QUERIES, SQL


@pytest.fixture(scope="module")
def con(tables):
    return connect(tables)


def test_twins_belong_to_queries():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, tables, name):
    df = QUERIES[name](spark, tables)
    if name not in SQL:
        assert df.count() > 0
        return
    names, rows = spark_rows(df)
    expected_names, expected = sql_rows(con, SQL[name])
    assert names == expected_names
    assert sorted(df.dtypes) == sql_types(con, SQL[name])
    assert len(rows) == len(expected)
    differing = [(a, b) for a, b in zip(rows, expected, strict=True) if a != b]
    assert not differing, differing[:3]
