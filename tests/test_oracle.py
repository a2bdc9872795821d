"""Every registered query against the same question asked of DuckDB."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from tallyhouse.workload.oracles import ORACLES
from tallyhouse.workload.queries import QUERIES
from tests.compare import assert_same, connect


@pytest.fixture(scope="module")
def duck(medium):
    connection = connect(medium)
    yield connection
    connection.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, medium, duck, name):
    assert_same(QUERIES[name](spark, medium), duck, ORACLES[name])


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.count() == 198
