from __future__ import annotations

import pytest
from oracle import SF_DIR, assert_same

from helmtrack.plans import registry


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_has_the_rows_of_its_sql(spark, name):
    assert_same(registry.QUERIES[name](spark, SF_DIR), registry.ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_query_without_sql_has_rows(spark, name):
    """Their results are held against loops in the tests of their operators."""
    rows = registry.QUERIES[name](spark, SF_DIR).collect()
    assert rows and len({len(r) for r in rows}) == 1
    assert all(any(v is not None for v in column) for column in zip(*rows))
