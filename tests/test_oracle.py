"""Every registered query against DuckDB on the smallest data set."""

import duckdb
import pytest

import __spark_entry__ as driver

SMALL = "/root/testdata/sf0.001"
QUERIES = driver._own_queries()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW events AS SELECT * FROM '{SMALL}/events.parquet'")
    return connection


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        tuple(f"{r[i]:.9g}" if isinstance(r[i], float) else str(r[i]) for i in order) for r in rows
    )


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    found = QUERIES[name](spark, SMALL)
    result = duck.execute(driver.oracles.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(found.columns) == sorted(columns)
    assert canonical(found.columns, map(tuple, found.collect())) == canonical(columns, result.fetchall())
