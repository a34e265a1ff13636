"""Every query of the library against its SQL on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import check_oracles
from __spark_entry__ import entry, oracle_sql, queries
from cartmill.catalog import load_catalog
from cartmill.session import clear_scratch

SF = "/root/testdata/sf0.001"
QUERIES, SQL = load_catalog()


@pytest.fixture(autouse=True)
def scratch(spark):
    """What a query stored on the way goes once its result is compared."""
    yield
    clear_scratch(spark)


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    connection.execute("SET TimeZone='UTC'")
    for t in check_oracles.TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES) <= set(queries())
    assert all(oracle_sql()[q] == SQL[q] for q in SQL)


def test_entry(spark):
    df = entry(spark)
    assert "segment" in df.columns and df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, name):
    problems, _, _ = check_oracles.compare(name, QUERIES[name](spark, SF), SQL[name], con)
    assert problems == []
