"""Every registered query against its SQL in DuckDB."""

import os

import pytest

from tests.oracle_check import compare
from tickflow.plans.oracle import ORACLE_SQL
from tickflow.plans.queries import QUERIES

DATA = "/root/testdata"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("stream_")])
def test_batch_query_equals_sql(spark, name):
    assert compare(spark, name, f"{DATA}/sf0.01") is None


@pytest.mark.parametrize("name", [n for n in QUERIES if n.startswith("stream_")])
def test_stream_query_equals_sql(spark, name):
    assert compare(spark, name, f"{DATA}/sf0.001") is None


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE_SQL.keys()


def test_entry_gives_rows(spark):
    import __spark_entry__ as contract
    assert contract.entry(spark).count() > 0
    assert QUERIES.keys() <= contract.queries().keys()
    assert ORACLE_SQL.keys() <= contract.oracle_sql().keys() <= contract.queries().keys()
