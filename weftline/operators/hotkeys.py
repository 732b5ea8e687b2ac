"""Per-key results when a few keys hold most rows: eager aggregation through a join."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_states(table: DataFrame, key: str, states: dict[str, Column], also: tuple[str, ...] = ()) -> DataFrame:
    """One compact row for each key (and value of the columns in also): its number of rows and the given states.

    Each task folds its own rows of a key before anything moves, so a key with most rows sends one row from each task.
    """
    return table.groupBy(F.col(key).alias("key"), *also).agg(F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in states.items()])


def eager_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, *, left_sums: dict[str, Column] | None = None, right_sums: dict[str, Column] | None = None, left_states: dict[str, Column] | None = None, right_also: tuple[str, ...] = ()) -> DataFrame:
    """The join of two tables, aggregated by key, without forming the joined rows.

    Both inputs are aggregated by key first and their states are joined. A pair (l, r) of joined rows exists for every
    row of l with every row of r, so counts multiply, and a sum over one side is multiplied by the other side's rows.
    left_states (minima, maxima, distinct counts of the left side) are carried as they are. right_also are further
    columns by which the right side is grouped, for a roll-up along them.

    (key, *right_also, left_rows, right_rows, joined_rows, *left_sums, *right_sums, *left_states); keys only in left are
    kept with right_rows 0 and sums over the join of 0; the null key is kept as one row and joins nothing.
    """
    ls = {f"l_{n}": F.sum(c) for n, c in (left_sums or {}).items()}
    rs = {f"r_{n}": F.sum(c) for n, c in (right_sums or {}).items()}
    l = key_states(left, left_key, ls | (left_states or {})).withColumnRenamed("rows", "left_rows")
    r = key_states(right.where(F.col(right_key).isNotNull()), right_key, rs, right_also).withColumnRenamed("rows", "right_rows")
    joined = l.join(r, "key", "left").withColumn("right_rows", F.coalesce("right_rows", F.lit(0)))
    zero = lambda c: F.coalesce(c, F.lit(0))
    return joined.select(
        "key",
        *right_also,
        "left_rows",
        "right_rows",
        (F.col("left_rows") * F.col("right_rows")).alias("joined_rows"),
        *[zero(F.col(f"l_{n}") * F.col("right_rows")).alias(n) for n in left_sums or {}],
        *[zero(F.col(f"r_{n}") * F.col("left_rows")).alias(n) for n in right_sums or {}],
        *(left_states or {}),
    )


def roll_up(joined: DataFrame, by: str, sums: tuple[str, ...]) -> DataFrame:
    """Totals of an eager join by one of its columns; keys that joined nothing are left out."""
    return joined.where("right_rows > 0").groupBy(by).agg(F.sum("joined_rows").alias("joined_rows"), *[F.sum(s).alias(s) for s in sums])


def with_share(joined: DataFrame, hot_share: float) -> DataFrame:
    """Adds each key's share of all rows and whether it dominates: not null, and over hot_share.

    All figures come from the joined states: the rows of a key are the joined rows over its parents (its own rows where it
    has none), and the total is the sum of them, so no table is read again. The sum is a scalar subquery over the
    same exchanges as the join.
    """
    rows = F.when(F.col("right_rows") > 0, F.expr("joined_rows div right_rows")).otherwise(F.col("left_rows"))
    total = F.coalesce(joined.select(rows.alias("n")).agg(F.sum("n")).scalar(), F.lit(0))
    hot = rows > F.lit(Decimal(str(hot_share))) * total  # exact, as a key may hold just that share
    return joined.withColumns({"share": rows / F.greatest(total, F.lit(1)), "dominates": F.col("key").isNotNull() & hot})
