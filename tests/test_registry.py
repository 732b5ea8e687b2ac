"""Every core query against its SQL at the smallest scale, and the driver's entry point."""

import pytest

import weftline.plans.corpus  # noqa: F401
import weftline.plans.entities  # noqa: F401
from tests.oracle import assert_same
from weftline.plans.registry import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, small, name):
    assert_same(spark, small, QUERIES[name], SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_repeats(spark, small, name):
    """These have tests of their own; here: rows, and the same ones however the session is set."""
    once = sorted(map(repr, QUERIES[name](spark, small).collect()))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        again = sorted(map(repr, QUERIES[name](spark, small).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert once and once == again


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 1500
    assert set(e.oracle_sql()) <= set(e.queries())
