"""Frequency of every distinct term of a collection, by range-partitioned sorting and run-length scanning."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.plans.runtime import shuffle_partitions, ship

RARE_RECORDS = 2
COMMON_SHARE = 0.08


def clean_term(value: Column) -> Column:
    """Lower case, without outer spaces, inner runs of spaces made one."""
    return F.trim(F.regexp_replace(F.lower(value), r"\s+", " "))


def term_pairs(table: DataFrame, record: str, fields: dict[str, str]) -> DataFrame:
    """(field_name, term, record): a row for each occurrence. fields names the column (array or plain) of each field."""
    parts = []
    for name, column in fields.items():
        kind = table.schema[column].dataType.typeName()
        value = F.explode(F.col(column)) if kind == "array" else F.col(column).cast("string")
        pairs = table.select(F.lit(name).alias("field_name"), F.col(record).alias("record"), value.alias("value"))
        parts.append(pairs.select("field_name", clean_term(F.col("value").cast("string")).alias("term"), "record").where("term <> ''"))
    return reduce(DataFrame.unionByName, parts)


def scan_sorted(batches):
    """Run lengths over sorted (field_name, term, record): a row for each run of a term, carried over batch borders."""
    schema = pa.schema([("field_name", pa.string()), ("term", pa.string()), ("occurrences", pa.int64()), ("records", pa.int64())])
    last: list | None = None  # field, term, occurrences, records, record of the run that may go on

    for batch in batches:
        n = len(batch)
        if not n:
            continue
        field, term, record = batch.columns
        differs = lambda c: pc.fill_null(pc.not_equal(c.slice(1), c.slice(0, n - 1)), True).to_numpy(zero_copy_only=False)
        begins = np.concatenate([[True], differs(term) | differs(field)])
        new = np.concatenate([[True], differs(record)]) | begins
        new &= record.is_valid().to_numpy(zero_copy_only=False)
        at = np.flatnonzero(begins)
        occurrences = np.diff(np.append(at, n))
        records = np.add.reduceat(new.astype(np.int64), at)
        fields, terms = field.take(pa.array(at)).to_pylist(), term.take(pa.array(at)).to_pylist()
        rows = [list(x) for x in zip(fields, terms, occurrences.tolist(), records.tolist())]
        if last:
            if rows[0][:2] == last[:2]:
                same = record[0].is_valid and record[0].as_py() == last[4]
                rows[0][2] += last[2]
                rows[0][3] += last[3] - same
            else:
                rows.insert(0, last[:4])
        last = [*rows.pop(), record[n - 1].as_py()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
    if last:
        yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(last, schema.types)], schema=schema)


def scan_runs(pairs: DataFrame) -> DataFrame:
    """(field_name, term, occurrences, records) of all terms in pairs (field_name, term, record).

    The pairs are range-partitioned by field, term and record and sorted outside memory, so a term with a third of all
    rows spreads over as many partitions as it needs, while a record's repeats of a term stay together: what the
    partitions count of a term can be added up. Each partition is scanned once, and only a row for each run goes on.
    A null record counts as no record, but its occurrences count.
    """
    ship(pairs.sparkSession)
    parts = shuffle_partitions(pairs.sparkSession)
    ordered = pairs.repartitionByRange(parts, "field_name", "term", "record").sortWithinPartitions("field_name", "term", "record")
    runs = ordered.mapInArrow(scan_sorted, "field_name string, term string, occurrences long, records long")
    return runs.groupBy("field_name", "term").agg(F.sum("occurrences").alias("occurrences"), F.sum("records").alias("records"))


def term_frequencies(tables: list[tuple[DataFrame, str, dict[str, str]]], *, rare_records: int = RARE_RECORDS, common_share: float = COMMON_SHARE) -> DataFrame:
    """(field_name, term, occurrences, records, mark) of every term of every field.

    tables: (table, id column, fields). Records are distinct ids. mark is `rare` up to rare_records records, `common`
    above common_share of the table's distinct ids, else null; a term that is both is rare. Null and blank values are
    skipped, also inside arrays; an empty table gives no rows.
    """
    totals = reduce(
        DataFrame.unionByName,
        [t.select(F.col(i).alias("record")).distinct().agg(F.count("record").alias("ids")).select(F.explode(F.array(*map(F.lit, fields))).alias("field_name"), "ids") for t, i, fields in tables],
    )  # one row for each field that the call names
    pairs = reduce(DataFrame.unionByName, [term_pairs(*t) for t in tables])
    mark = F.when(F.col("records") <= rare_records, "rare").when(F.col("records") > F.lit(Decimal(str(common_share))) * F.col("ids"), "common")  # exact, as a term may have just that share
    return scan_runs(pairs).join(F.broadcast(totals), "field_name").select("field_name", "term", "occurrences", "records", mark.alias("mark"))
