"""The queries that SQL can express, against that SQL."""

from __future__ import annotations

import pytest

from checks.compare import connect, difference
from obslake.llm.queries import QUERIES
from obslake.llm.twins import TWINS
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(TWINS))
def test_query_equals_sql(spark, duck, name):
    assert difference(QUERIES[name](spark, SMALL), duck, TWINS[name]) is None
