"""Every query with SQL gives the rows DuckDB gives on the same tables."""

import pytest

from duewatch.catalog import CHECKS, QUERIES
from tests.compare import connection, difference

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_matches_sql(spark, name):
    assert difference(spark, connection(SMALL), SMALL, QUERIES[name], CHECKS[name]) is None
