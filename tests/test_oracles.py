"""Every registered query against its SQL answer on the smallest tables."""

import os

import duckdb
import pytest

from workloads import QUERIES_AND_ORACLES
from workloads.check import TABLES, compare

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = QUERIES_AND_ORACLES()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def test_every_query_has_an_answer():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.skipif(not os.path.isdir(SF), reason="tables not present")
@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    note, _, ok = compare(spark, con, SF, name, QUERIES[name], ORACLES[name])
    assert ok, note
