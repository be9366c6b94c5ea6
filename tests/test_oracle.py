"""Every registered query against its SQL, at the smallest scale."""

import pytest

import __spark_entry__ as entry_points
from tests.compare import database, difference
from tests.conftest import SF_DIR

ORACLE = {k: v for k, v in entry_points.oracle_sql().items() if k not in entry_points.LLM_QUERIES}
QUERIES = {k: v for k, v in entry_points.queries().items() if k not in entry_points.LLM_QUERIES}


@pytest.fixture(scope="module")
def con():
    return database(SF_DIR)


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLE) == {"d16_isolation_outliers"}


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_equals_sql(spark, con, key):
    assert difference(QUERIES[key](spark, SF_DIR), con, ORACLE[key]) is None


def test_entry(spark, con):
    """The mart over all readings; 432 of its rows are not before the staging model's first date."""
    mart = entry_points.entry(spark)
    assert mart.count() == len(con.sql(ORACLE["b16_violations_mart"]).fetchall())
    assert mart.where("timestamp >= timestamp_ntz'2024-01-01'").count() == 432
