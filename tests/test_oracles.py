"""Every registered query against its SQL counterpart on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as registry
from docweave.plans.oracles import ORACLES
from docweave.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for name in ("events", "part"):
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def _rows(table):
    table = table.select(sorted(table.column_names))
    return sorted(tuple(map(str, r.values())) for r in table.to_pylist())


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(registry.queries()) and set(ORACLES) <= set(registry.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, tables, name):
    ours, theirs = QUERIES[name](spark, SF_DIR).toArrow(), tables.sql(ORACLES[name]).to_arrow_table()
    assert sorted(ours.column_names) == sorted(theirs.column_names)
    assert _rows(ours) == _rows(theirs)


def test_entry(spark):
    assert registry.entry(spark).count() > 0
