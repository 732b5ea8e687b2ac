"""Deterministic samples and batches over ordered groups."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def numbered(table: DataFrame, group: str, *order: Column, name: str = "line") -> DataFrame:
    """Adds each row's place from 1 within its group."""
    return table.withColumn(name, F.row_number().over(Window.partitionBy(group).orderBy(*order)).cast("long"))


def stride(table: DataFrame, line: str = "line", every: int = 16, last: int = 2048) -> DataFrame:
    """The lines 1, 1 + every, ... up to last of each group."""
    return table.where(((F.col(line) - 1) % every == 0) & (F.col(line) <= last))


def bottom_k(table: DataFrame, group: str, key: str, k: int) -> DataFrame:
    """k rows of each group, those with the smallest md5 of their key: a uniform sample that any run repeats."""
    h = F.md5(F.col(key).cast("string"))
    return table.withColumn("_n", F.row_number().over(Window.partitionBy(group).orderBy(h, key))).where(F.col("_n") <= k).drop("_n")


def first_of_each(table: DataFrame, group: str, kind: str, order: str) -> DataFrame:
    """The first row of each class within each group."""
    rest = [c for c in table.columns if c not in (group, kind)]
    return table.groupBy(group, kind).agg(F.min_by(F.struct(*rest), order).alias("r")).select(group, kind, "r.*")


def split_held_out(table: DataFrame, group: str, *order: Column, every: int = 4) -> DataFrame:
    """Adds `part`: every fourth row of a group, from the first on, is `train`, the rest `held_out`."""
    n = numbered(table, group, *order, name="_n")
    return n.withColumn("part", F.when((F.col("_n") - 1) % every == 0, "train").otherwise("held_out")).drop("_n")


def batch_by_count(table: DataFrame, group: str, size: int, *order: Column) -> DataFrame:
    """Adds `batch` from 0: runs of `size` rows of each group."""
    n = numbered(table, group, *order, name="_n")
    return n.withColumn("batch", F.floor((F.col("_n") - 1) / size).cast("long")).drop("_n")


def batch_greedy(table: DataFrame, group: str, order: str, size: str, most_bytes: int, most_rows: int) -> DataFrame:
    """(group, order, size, batch): rows in order go into a batch until the next one would exceed the bytes, or it has
    most_rows rows. A row larger than the limit gets a batch of its own.

    The state is a running sum, so a group's rows are read as a stream in order and only counters are held.
    """
    rows = table.select(group, order, size).repartition(group).sortWithinPartitions(group, order)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, batch, used, count = object(), 0, 0, 0
        for pdf in frames:
            out = []
            for g, s in zip(pdf[group], pdf[size]):
                if g != current:
                    current, batch, used, count = g, 0, 0, 0
                elif count and (used + s > most_bytes or count >= most_rows):
                    batch, used, count = batch + 1, 0, 0
                used += s
                count += 1
                out.append(batch)
            yield pdf.assign(batch=out)

    return rows.mapInPandas(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields) + ", batch long")


def within_budget(table: DataFrame, group: str, order: str, size: str, budget: int) -> DataFrame:
    """The rows of each group that fit a byte budget, taken in order; one that doesn't fit is passed over."""
    rows = table.repartition(group).sortWithinPartitions(group, order)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, left = object(), 0
        for pdf in frames:
            keep = []
            for g, s in zip(pdf[group], pdf[size]):
                if g != current:
                    current, left = g, budget
                fits = s <= left
                left -= s if fits else 0
                keep.append(fits)
            yield pdf[keep]

    return rows.mapInPandas(run, rows.schema)


def counter_delta(table: DataFrame, group: str, order: str, counter: str) -> DataFrame:
    """(group, delta): growth of a running counter from its first to its last reading; null if it was ever reset."""
    w = Window.partitionBy(group).orderBy(order)
    steps = table.select(group, order, counter, (F.col(counter) < F.lag(counter).over(w)).alias("reset"))
    per = steps.groupBy(group).agg(F.max_by(counter, order).alias("last"), F.min_by(counter, order).alias("first"), F.coalesce(F.bool_or("reset"), F.lit(False)).alias("reset"))
    return per.select(group, F.when(~F.col("reset"), F.col("last") - F.col("first")).alias("delta"))
