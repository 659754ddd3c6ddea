"""Every query with SQL against DuckDB on the smallest tables."""

import os

import pytest

from locuspark.plans import registry
from tests.oracle import connect, normal

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_matches_sql(spark, name):
    got = registry.QUERIES[name](spark, SF).toPandas()
    want = connect(SF).execute(registry.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) > 0
    assert normal(got) == normal(want)


def test_every_query_is_callable_and_has_known_sql():
    assert set(registry.ORACLE_SQL) <= set(registry.QUERIES)
    assert len(registry.QUERIES) > 150
