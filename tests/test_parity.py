"""Every registered query against its SQL, run by DuckDB on the same files."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from tradeledger import catalog

QUERIES = contract.queries()
ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for file in sorted(os.listdir(sf_dir)):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{file}'")
    yield connection
    connection.close()


def _order(row):
    return tuple((value is not None, value if value is not None else 0) for value in row)


def test_every_report_has_an_oracle():
    assert set(ORACLES) <= set(QUERIES)
    assert set(catalog.queries()) <= set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_parity(spark, duck, sf_dir, name):
    result = QUERIES[name](spark, sf_dir)
    ours = [tuple(r) for r in result.collect()]
    answer = duck.execute(ORACLES[name])
    names = [d[0] for d in answer.description]
    assert sorted(names) == sorted(result.columns)
    at = [names.index(c) for c in result.columns]
    theirs = [tuple(row[i] for i in at) for row in answer.fetchall()]
    assert ours, "a query over the test tables returns something"
    assert sorted(ours, key=_order) == sorted(theirs, key=_order)


def test_entry(spark):
    result = contract.entry(spark)
    assert result.count() == 1
    assert len(result.columns) == 15
