"""Every named query against its SQL equivalent in another engine."""

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL
from txnmart.queries import QUERIES

TABLES = ["orders", "customer", "lineitem", "events", "part", "supplier", "nation", "region"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return con


def normal(value):
    return float(f"{value:.10g}") if isinstance(value, float) else value


def table(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(normal(row[i]) for i in order) for row in rows), key=repr)


def test_all_queries_have_an_equivalent():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, str(SMALL))
    rows = df.collect()
    result = duck.execute(entry.oracle_sql()[name])
    columns = [column[0] for column in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert table(df.columns, rows) == table(columns, result.fetchall())


def test_entry(spark):
    assert entry.entry(spark).columns[0] == "week_start"
