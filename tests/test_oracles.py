"""Every query with an oracle gives the same rows, columns and types as its SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from oracle import connect, difference

SF_DIR = "/root/testdata/sf0.001"
ROWS_ONLY = set(contract.queries()) - set(contract.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_same_as_sql(spark, con, name):
    query = contract.queries()[name]
    assert difference(query(spark, SF_DIR), contract.oracle_sql()[name], con) is None


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_gives_rows(spark, name):
    """Every column of every row is made; a count alone would leave columns out."""
    assert contract.queries()[name](spark, SF_DIR).collect()


def test_entry(spark):
    assert contract.entry(spark).count() == 5
