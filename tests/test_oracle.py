"""Every registered query against its SQL counterpart, on the smallest test tables."""

import pytest
from conftest import SF_DIR
from oracle_check import connect, differences

from salesloom import oracle
from salesloom.plans import catalog

QUERIES = catalog.queries()
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(SQL))
def test_same_result(spark, duck, name):
    assert differences(QUERIES[name](spark, SF_DIR), duck.sql(SQL[name])) == []
