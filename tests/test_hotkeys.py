"""Eager joins against joined rows."""

from pyspark.sql import functions as F

from weftline.operators.hotkeys import eager_join, roll_up, with_share
from weftline.plans import corpus


def test_eager_join_equals_the_joined_rows(spark):
    left = spark.createDataFrame([(1, 10, "x")] * 500 + [(2, 5, None), (2, 7, "y"), (3, 1, "z"), (None, 9, "n"), (None, 9, "n")], "k long, v long, key string")
    right = spark.createDataFrame([(1, 2, "i"), (1, 3, "j"), (2, 4, "i"), (2, 4, "i"), (9, 1, "i"), (None, 8, "i")], "k long, w long, industry string")
    e = eager_join(left, right, "k", "k", left_sums={"sv": F.col("v")}, right_sums={"sw": F.col("w")})
    got = {r.key: (r.left_rows, r.right_rows, r.joined_rows, r.sv, r.sw) for r in e.collect()}
    assert got == {1: (500, 2, 1000, 10000, 2500), 2: (2, 2, 4, 24, 16), 3: (1, 0, 0, 0, 0), None: (2, 0, 0, 0, 0)}
    by = roll_up(eager_join(left, right, "k", "k", right_sums={"sw": F.col("w")}, right_also=("industry",)), "industry", ("sw",))
    assert {tuple(r) for r in by.collect()} == {("i", 504, 1016), ("j", 500, 1500)}
    hot = with_share(e, 0.02).where("dominates").collect()
    assert [r.key for r in hot] == [1]


def test_empty(spark):
    t = spark.createDataFrame([], "k long, v long")
    assert eager_join(t, t, "k", "k", left_sums={"s": F.col("v")}).count() == 0
    assert with_share(eager_join(t, t, "k", "k"), 0.02).count() == 0


def test_dominating_keys_come_through_the_join(spark, small):
    plan = corpus.p2_found(spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan and "roles.parquet" in plan and "organizations.parquet" in plan
