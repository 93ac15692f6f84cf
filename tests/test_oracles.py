"""Each registered query against its SQL counterpart in DuckDB, on the smallest test tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def normal(value):
    if value is None or isinstance(value, str | bool):
        return value
    return None if math.isnan(value) else float(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


#: Queries of the monitoring library; the others are tested beside their package.
OWN = [name for name, query in entry.queries().items() if query.__module__ == entry.__name__]


def test_every_query_has_a_counterpart():
    assert set(OWN) <= entry.oracle_sql().keys() and len(OWN) >= 35


@pytest.mark.parametrize("name", OWN)
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF_DIR)
    con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in con.description]
    assert sorted(df.columns) == sorted(columns)
    expected = rows_of(columns, con.fetchall())
    assert expected
    assert rows_of(df.columns, df.collect()) == expected


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
