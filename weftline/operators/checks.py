"""Checks of tables and documents: duplicates, counts, comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def duplicates(table: DataFrame, *keys: str) -> DataFrame:
    """(*keys, rows) of key values held by several rows."""
    return table.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def surplus(table: DataFrame, key: str) -> DataFrame:
    """One row: rows, distinct keys, and rows beyond the first of each key."""
    per = table.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return per.agg(zero("n").alias("rows"), F.count(F.lit(1)).alias("keys"), zero(F.col("n") - 1).alias("surplus"))


def last_wins(table: DataFrame, key: str, *order: Column) -> DataFrame:
    """One row for each key: the one that is last in the order, as an upsert of the rows in that order leaves it.

    Each task keeps only its own last row of a key before rows move, and only the columns asked for later are read.
    """
    w = Window.partitionBy(key).orderBy(*[o.desc_nulls_last() for o in order])
    return table.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def differing(left: DataFrame, right: DataFrame, key: str, doc: str) -> DataFrame:
    """(key, kind) of documents that are missing on one side or differ. Nulls are compared as values."""
    l, r = left.select(key, F.col(doc).alias("l"), F.lit(1).alias("in_l")), right.select(key, F.col(doc).alias("r"), F.lit(1).alias("in_r"))
    kind = F.when(F.col("in_l").isNull(), "only right").when(F.col("in_r").isNull(), "only left").when(~F.col("l").eqNullSafe(F.col("r")), "differs")
    return l.join(r, key, "full").select(key, kind.alias("kind")).where("kind is not null")


def digest(table: DataFrame, *columns: str) -> DataFrame:
    """One row: number of rows and a digest of their contents that doesn't depend on their order.

    Each row's values are written with their lengths (null apart from an empty text) and hashed; 60 bits of each hash
    are summed. So repeated rows count, and no value can be told as part of its neighbour.
    """
    text = [F.col(c).cast("string") for c in columns]
    h = F.md5(F.concat(*[F.coalesce(F.concat(F.char_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]))
    return table.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.conv(F.substring(h, 1, 15), 16, 10).cast("decimal(38,0)")), F.lit(0)).cast("string").alias("digest"))
