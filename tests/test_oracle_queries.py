"""Every registered query against its DuckDB oracle on the smallest scale factor."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from oracles import ORACLES
from queries_impl import QUERIES
from tools.compare_oracle import TABLES, compare_one

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    problems, _ = compare_one(spark, con, E.queries()[name], E.oracle_sql()[name], SF)
    assert not problems, problems


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert rows and df.columns == ["ano", "o_orderpriority", "n_orders", "total_price"]
