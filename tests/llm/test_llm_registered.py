"""Every registered operator with SQL against DuckDB; the others give their rows."""

import glob
import os

import duckdb
import pytest
from llm_cases import SMALL
from test_oracle import canonical

from spanfold.llm import queries as llm


QUERIES = llm.queries()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_against_sql(spark, duck, name):
    found = QUERIES[name](spark, SMALL)
    result = duck.execute(llm.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(found.columns) == sorted(columns)
    assert canonical(found.columns, map(tuple, found.collect())) == canonical(columns, result.fetchall())


def test_all_operators():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
