"""Every registered query against its SQL, on the smallest tables."""

import pytest

from __spark_entry__ import SMOKE_DATA, entry, oracle_sql, queries
from checks.oracle import ORACLE
from checks.queries import REGISTERED
from checks.compare import connect, difference


@pytest.fixture(scope="module")
def db():
    return connect(SMOKE_DATA)


@pytest.mark.parametrize("name", REGISTERED)
def test_query_equals_sql(spark, db, name):
    assert difference(queries()[name](spark, SMOKE_DATA), db, oracle_sql()[name]) is None


def test_every_query_has_sql():
    assert REGISTERED.keys() == ORACLE.keys()
    assert REGISTERED.items() <= queries().items() and ORACLE.items() <= oracle_sql().items()


def test_entry(spark):
    assert entry(spark).columns == ["log_date", "status_code", "request_count", "total_bytes"]
    assert entry(spark).count() > 0
