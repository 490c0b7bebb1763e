"""Registered batch queries against DuckDB; drained streams have their own tests."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from fixtures.cases import CASES
from fixtures.oracles import ORACLES
from tests.conftest import SMALL

NAMES = [name for name in CASES if not name.startswith("stream_") or name == "stream_update_metrics"]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in ("events", "customer", "nation"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    # The text queries, where they are registered, have their own tests.
    assert set(CASES) == set(ORACLES)
    assert set(CASES) <= set(entry_points.queries()) and set(ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    found = entry_points.queries()[name](spark, SMALL)
    columns = sorted(found.columns)
    expected = duck.execute(entry_points.oracle_sql()[name])
    names = [d[0] for d in expected.description]
    assert sorted(names) == columns
    wanted = sorted(str([row[names.index(c)] for c in columns]) for row in expected.fetchall())
    assert wanted and sorted(str([row[c] for c in columns]) for row in found.collect()) == wanted


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
