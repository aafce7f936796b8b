"""Every query against its SQL twin."""

from __future__ import annotations

import pytest
from conftest import SF

import __spark_entry__ as entry
from bindings.oracle import ORACLE
from bindings.queries import QUERIES
from compare import connect, differences


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_a_twin():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= entry.queries().keys()
    assert entry.oracle_sql().keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, ORACLE[name]) == []


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns == ["customer_id", "customer_name", "region", "total_policy_amt"]
    assert not result.isEmpty()
