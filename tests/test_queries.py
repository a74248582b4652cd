"""Every query against its SQL on the smallest tables."""

import __spark_entry__ as entry_points
import compare
import pytest

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return compare.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_query_matches_sql(spark, connection, name):
    query, sql = entry_points.queries()[name], entry_points.oracle_sql()[name]
    assert compare.differences(spark, name, query, sql, SF_DIR, connection) is None


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).count() > 0
