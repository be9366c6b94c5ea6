"""Queries with SQL against it, at the smallest scale."""

import pytest

from fleetwatt.llm.queries import QUERIES
from fleetwatt.llm.sql import ORACLE
from tests.compare import database, difference
from tests.conftest import SF_DIR


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_equals_sql(spark, key):
    assert difference(QUERIES[key](spark, SF_DIR), database(SF_DIR), ORACLE[key]) is None
