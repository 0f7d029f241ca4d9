"""Every registered query against its SQL on the smallest tables."""

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = os.environ.get("WORKLOAD_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = entry.QUERIES, entry.SQL
TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "boolean": "BOOLEAN"}

pytestmark = pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="no test tables")


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert SQL.keys() == QUERIES.keys()


def test_flagship(spark):
    assert not entry.entry(spark).isEmpty()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, tables, name):
    found = QUERIES[name](spark, FOLDER)
    columns = sorted(found.columns)
    result = tables.execute(SQL[name])
    types = {c[0]: str(c[1]) for c in result.description}
    assert {c: TYPES[t] for c, t in found.dtypes} == types
    places = [list(types).index(c) for c in columns]
    expected = [tuple(row[p] for p in places) for row in result.fetchall()]
    actual = [tuple(row) for row in found.select(columns).collect()]
    assert sorted(actual, key=str) == sorted(expected, key=str)
    assert actual
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "NestedLoopJoin" not in plan
