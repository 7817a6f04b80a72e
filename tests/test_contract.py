"""Every named query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from inkmill.plans import REGISTRY
from tools.check import TABLES, rows_of

DIR = os.environ.get("CONTRACT_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{DIR}/{name}.parquet')")
    return con


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_sql_belongs_to_queries():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, db, name):
    frame = contract.queries()[name](spark, DIR)
    got = frame.collect()
    assert got
    sql = contract.oracle_sql().get(name)
    if sql:
        cursor = db.execute(sql)
        want = rows_of([c[0] for c in cursor.description], cursor.fetchall())
        assert rows_of(frame.columns, got) == want
