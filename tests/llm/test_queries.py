"""Every query of the subpackage at the smallest scale."""

import pytest

from tests.oracle import assert_same
from weftline.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, small, name):
    assert_same(spark, small, QUERIES[name], SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_runs(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0
