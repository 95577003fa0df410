"""Registered queries against their SQL."""

from pathlib import Path

import pytest

from advisorbook.llm.queries import ORACLE, QUERIES

SF_DIR = Path("/root/testdata/sf0.001")
TABLES = ("documents", "pages", "benchmark", "conversations")
NATIVE = ("op1_", "op6_", "op7_", "op8_")

pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, str(SF_DIR))
    cursor = duck.execute(ORACLE[name])
    columns = sorted(c[0] for c in cursor.description)
    order = sorted(range(len(cursor.description)), key=lambda i: cursor.description[i][0])
    expected = sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=repr)
    assert sorted(got.columns) == columns
    assert expected and sorted((tuple(r) for r in got.select(*columns).collect()), key=repr) == expected


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.startswith(NATIVE)))
def test_native_queries_run_no_python(spark, name):
    plan = QUERIES[name](spark, str(SF_DIR))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
