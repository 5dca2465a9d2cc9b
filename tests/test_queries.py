"""Every query with SQL returns the rows that DuckDB returns; the others return rows."""

import pytest

from lodeweave.plans import registry
from tests import oracle


@pytest.fixture(scope="module")
def con(sf):
    return oracle.connect(sf)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, sf, con, name):
    df = registry.queries()[name](spark, sf)
    sql = registry.oracle_sql().get(name)
    if sql:
        oracle.same(df, con, sql)
    else:
        assert df.count() > 0


def test_entry_points(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0
