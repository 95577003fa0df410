"""Every registered query against its SQL, and the shape of the plans."""

import math
from pathlib import Path

import pytest

import __spark_entry__ as contract
from testbed.oracle import ORACLE
from testbed.queries import QUERIES

SF_DIR = Path("/root/testdata/sf0.001")
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return connection


def plain(value):
    return "nan" if isinstance(value, float) and math.isnan(value) else value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.items() <= contract.queries().items()
    assert ORACLE.items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, str(SF_DIR))
    plan = got._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert operator not in plan
    cursor = duck.execute(ORACLE[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(got.columns) == sorted(columns)
    expected = sorted_rows(columns, cursor.fetchall())
    assert expected and sorted_rows(got.columns, got.collect()) == expected


def test_entry_runs(spark):
    rows = contract.entry(spark).collect()
    assert rows and "total_aum" in rows[0].asDict()
