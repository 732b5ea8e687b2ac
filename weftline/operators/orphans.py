"""References to records that do not exist, found with compressed bitmaps per key range and period."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.instants import utc_month
from weftline.plans.runtime import settle, ship, shuffle_partitions

RANGE_BITS = 16


def compress(low: np.ndarray) -> bytes:
    """A set of numbers under 65,536: sorted 16-bit values, or a bit for every number where that is shorter."""
    low = np.unique(low.astype(np.uint16))
    if len(low) <= 4096:
        return b"a" + low.tobytes()
    bits = np.zeros(1 << RANGE_BITS, np.uint8)
    bits[low] = 1
    return b"b" + np.packbits(bits, bitorder="little").tobytes()


def expand(data: bytes) -> np.ndarray:
    """A compressed bitmap as a bit for every number of its range, packed into bytes."""
    body = np.frombuffer(data, np.uint8, offset=1)
    if data[:1] == b"b":
        return body
    bits = np.zeros(1 << RANGE_BITS, np.uint8)
    bits[body.view(np.uint16)] = 1
    return np.packbits(bits, bitorder="little")


def decode(bits: np.ndarray) -> np.ndarray:
    """The numbers whose bit is set."""
    return np.flatnonzero(np.unpackbits(bits, bitorder="little"))


def dictionary(*keys: DataFrame) -> DataFrame:
    """(key, code): a dense integer code for each distinct key of the given one-column tables, of any type that has an order.

    Keys are range-partitioned and sorted; a code is the key's place in its range below the range's number. So however
    sparse or long the keys are, 65,536 neighbours fill a bitmap range, and codes follow the order of the keys. Codes
    must not change between reads, so they are settled.
    """
    spark = keys[0].sparkSession
    every = keys[0].select(F.col(keys[0].columns[0]).alias("key"))
    for k in keys[1:]:
        every = every.unionByName(k.select(F.col(k.columns[0]).alias("key")))
    distinct = every.where("key is not null").distinct()
    ordered = distinct.repartitionByRange(shuffle_partitions(spark), "key").sortWithinPartitions("key")
    return settle(ordered.select("key", F.monotonically_increasing_id().alias("code")))


def bitmaps(keys: DataFrame, *periods: str) -> DataFrame:
    """(code_range, *periods, bits): a compressed bitmap of the codes of each code range and period, from (code, *periods).

    The high bits of a code name the range, the low 16 bits the bit. Repeats fall away in each task before anything
    moves, and a range has at most 65,536 codes, so a key with most rows weighs one bit.
    """
    coded = keys.select(F.shiftright("code", RANGE_BITS).alias("code_range"), F.col("code").bitwiseAND((1 << RANGE_BITS) - 1).cast("int").alias("low"), *periods)
    sets = coded.groupBy("code_range", *periods).agg(F.collect_set("low").alias("low"))

    @F.pandas_udf("binary")
    def pack(low: pd.Series) -> pd.Series:
        return low.map(lambda x: compress(np.asarray(x)))

    return sets.select("code_range", *periods, pack("low").alias("bits"))


def surviving(references: DataFrame, parents: DataFrame) -> DataFrame:
    """(source_table, period, key, certain): referenced keys that no parent of an earlier period covers.

    references: (key, source_table, period), distinct; parents: (key, period), the period a parent is first there. Keys of
    both are dictionary-encoded. Within a code range, periods go by in order: each period's references AND NOT all
    parents of earlier periods leave the survivors, which are decoded. A survivor is certain unless a parent turns up
    within the same period, which only instants can settle.
    """
    ship(references.sparkSession)
    codes = dictionary(references.select("key"), parents.select("key"))

    def and_not(refs: pa.Table, held: pa.Table) -> pa.Table:
        found = []  # source, period, keys, certain
        present = np.zeros(1 << (RANGE_BITS - 3), np.uint8)
        arrivals = sorted(zip(held["period"].to_pylist(), held["bits"].to_pylist()))
        at = 0
        for period, source, code_range, bits in sorted(zip(*(refs[c].to_pylist() for c in ("period", "source_table", "code_range", "bits")))):
            while at < len(arrivals) and arrivals[at][0] < period:
                present = present | expand(arrivals[at][1])
                at += 1
            left = expand(bits) & ~present
            same = expand(arrivals[at][1]) if at < len(arrivals) and arrivals[at][0] == period else np.zeros_like(present)
            for group, certain in ((left & ~same, True), (left & same, False)):
                found.append((source, period, (code_range << RANGE_BITS) + decode(group), certain))
        times = [len(k) for _, _, k, _ in found]
        repeat = lambda i, t: pa.array(np.repeat(np.array([f[i] for f in found], object), times), t)
        keys = np.concatenate([k for _, _, k, _ in found]) if found else np.zeros(0, np.int64)
        return pa.table({"source_table": repeat(0, pa.string()), "period": repeat(1, pa.string()), "code": pa.array(keys.astype(np.int64)), "certain": repeat(3, pa.bool_())})

    r = bitmaps(references.join(codes, "key").select("code", "source_table", "period"), "source_table", "period").groupBy("code_range")
    p = bitmaps(parents.join(codes, "key").select("code", "period"), "period").groupBy("code_range")
    left = r.cogroup(p).applyInArrow(and_not, "source_table string, period string, code long, certain boolean")
    return left.join(codes, "code").select("source_table", "period", "key", "certain")


def first_instants(parents: DataFrame, removals: DataFrame | None = None) -> DataFrame:
    """(key, first_at) of parents that are there: from (key, at), without those whose last removal no later row follows.

    removals: (key, removed_at). A parent of which no row has a readable instant is there from the beginning of time
    unless it was removed.
    """
    seen = parents.where("key is not null").groupBy("key").agg(F.min("at").alias("first_at"), F.max("at").alias("last_at"))
    if removals is not None:
        gone = removals.where("key is not null").groupBy("key").agg(F.max("removed_at").alias("removed_at"))
        seen = seen.join(gone, "key", "left").where("removed_at is null or last_at > removed_at")
    return seen.select("key", F.coalesce("first_at", F.to_timestamp(F.lit("0001-01-01 00:00:00"))).alias("first_at"))


def latest_references(references: DataFrame) -> DataFrame:
    """(source_table, row_id, key, at, period): the distinct keys of each referring id, with its latest instant.

    From (source_table, row_id, key, at) with repeated deliveries; an id without a readable instant has no period.
    """
    pairs = references.groupBy("source_table", "row_id", "key").agg(F.max("at").alias("at"))
    latest = F.max("at").over(Window.partitionBy("source_table", "row_id"))
    return pairs.withColumn("at", latest).where("key is not null").withColumn("period", F.coalesce(utc_month(F.col("at")), F.lit("")))


def orphans(references: DataFrame, parents: DataFrame, removals: DataFrame | None = None) -> DataFrame:
    """(source_table, row_id, key, period) of references whose parent is missing, removed, or first there later.

    references: (source_table, row_id, key, at); parents: (key, at); removals: (key, removed_at); repeats allowed, null
    keys refer to nothing. Bitmaps of references AND NOT parents, by key range and month, leave the keys that can be
    orphans; only references to those are looked at again, with instants where the month alone does not decide. A
    reference without a readable instant comes before every parent with one (its period is empty).
    """
    refs = settle(latest_references(references))
    there = settle(first_instants(parents, removals))
    left = surviving(refs.select("key", "source_table", "period").distinct(), there.select("key", utc_month(F.col("first_at")).alias("period")))
    hit = refs.join(left, ["source_table", "period", "key"])
    late = hit.join(there, "key", "left").where("certain or at is null or first_at > at")
    return late.select("source_table", "row_id", "key", F.nullif("period", F.lit("")).alias("period"))
