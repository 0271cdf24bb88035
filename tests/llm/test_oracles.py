from __future__ import annotations

import pytest
from oracle import SF_DIR, assert_same

from helmtrack.llm import queries as Q


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_has_the_rows_of_its_sql(spark, name):
    assert_same(Q.queries()[name](spark, SF_DIR), Q.oracle_sql()[name])
