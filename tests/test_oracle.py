"""Every registered query with SQL gives the same rows as the SQL."""

import pytest

import __spark_entry__ as contract
from modelpulse.plans.catalogue import ORACLE, QUERIES
from tests.oracle import compare


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, sf_dir, name):
    assert compare(QUERIES[name](spark, sf_dir), duck, ORACLE[name]) is None


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() == 4
