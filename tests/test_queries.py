"""Every registered query against its SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from suite import all_queries
from tests.compare import compare, connect


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(spark, con, sf_dir, name):
    sql = contract.oracle_sql()[name]
    result = compare(spark, con, sf_dir, contract.queries()[name], sql)
    assert not result["problems"]
    assert result["rows"] > 0


def test_entry(spark, sf_dir):
    assert contract.entry(spark).limit(1).count() == 1
