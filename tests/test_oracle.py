"""Every query against its SQL oracle at the smallest scale."""

import pytest
from oracle_check import compare, connect

import __spark_entry__ as contract
from tidemark.plans.catalogue import QUERIES
from tidemark.plans.oracle import ORACLE


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", [q for q in QUERIES if q in ORACLE])
def test_query_equals_oracle(spark, duck, sf_dir, name):
    assert compare(QUERIES[name](spark, sf_dir), duck, ORACLE[name]) is None


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() == 10
