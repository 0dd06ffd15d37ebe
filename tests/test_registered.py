"""Every registered query against its SQL at the smallest scale."""

import pytest

import __spark_entry__ as contract
from helpers import SMALL
from workload.check import compare, connect
from workload.oracle import all_oracles
from workload.queries import all_queries


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_is_callable_and_named():
    queries, oracles = contract.queries(), contract.oracle_sql()
    assert set(oracles) <= set(queries)
    assert set(all_queries()) == set(all_oracles())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(spark, con, name):
    outcome = compare(spark, con, SMALL, name)
    assert outcome.startswith(("ok", "ROWS")), outcome


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() == 26
