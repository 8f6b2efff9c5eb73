"""Every registered query against its SQL."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import connect, difference
from checks.queries import QUERIES
from checks.twins import TWINS
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(TWINS) == set(QUERIES)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
@pytest.mark.filterwarnings("ignore::UserWarning")
def test_query_equals_sql(spark, duck, name):
    assert difference(queries()[name](spark, SMALL), duck, oracle_sql()[name]) is None


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0
