"""Audit of feeds: presence, types, shapes, references."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.strict_json import strict_loads, texts_of
from weftline.operators.nested import JSON_START
from weftline.plans.runtime import ship

DATE_SHAPES = {
    "datetime Z": r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d\.\d+ Z$",
    "datetime offset": r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d\.\d+ [+-]\d{4}$",
    "datetime without fraction": r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d( .*)?$",
    "iso datetime": r"^\d{4}-\d\d-\d\dT.*$",
    "date": r"^\d{4}-\d\d-\d\d$",
    "year and month": r"^\d{4}-\d\d\z",
    "year": r"^\d{4}\z",
}


def date_shape(value: Column) -> Column:
    """The shape in which a date is written."""
    shape = F.when(value.isNull(), "null").when(value == "", "empty")
    for name, pattern in DATE_SHAPES.items():
        shape = shape.when(value.rlike(pattern), name)
    return shape.otherwise("other")


def canonical_id(value: Column) -> Column:
    """A string of digits alone as an integer; null for anything else, a sign too, and for what no bigint holds."""
    return F.when(value.rlike(r"\A[0-9]+\z"), value.try_cast("bigint"))


def presence(table: DataFrame) -> DataFrame:
    """(field, filled, nulls) of each column."""
    counts = table.agg(*[F.count(c).alias(c) for c in table.columns], F.count(F.lit(1)).alias("$rows"))
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"`{c}`").alias("filled")) for c in table.columns])
    return counts.select(F.explode(pairs).alias("x"), "$rows").select("x.field", "x.filled", (F.col("$rows") - F.col("x.filled")).alias("nulls"))


def kind_of(variant: Column) -> Column:
    """The JSON type of a VARIANT: object, array, string, integer, number, boolean or null."""
    s = F.schema_of_variant(variant)
    return (
        F.when(s.isNull(), "missing").when(s == "VOID", "null").when(s.startswith("OBJECT"), "object").when(s.startswith("ARRAY"), "array").when(s == "STRING", "string").when(s == "BOOLEAN", "boolean")
        .when((s == "BIGINT") | s.rlike(r"^DECIMAL\(\d+,0\)$"), "integer").otherwise("number")
    )


def type_histogram(table: DataFrame, json_col: str) -> DataFrame:
    """(field, kind, n): JSON types of the fields of objects held as JSON text; other text counts as field `$`."""
    v = table.select(F.try_parse_json(json_col).alias("v")).withColumn("top", kind_of(F.col("v")))
    fields = v.where("top = 'object'").select("v").lateralJoin(v.sparkSession.tvf.variant_explode(F.col("v").outer())).select(F.col("key").alias("field"), kind_of(F.col("value")).alias("kind"))
    rest = v.where("top <> 'object'").select(F.lit("$").alias("field"), F.when(F.col("v").isNull(), "malformed").otherwise(F.col("top")).alias("kind"))
    return fields.unionByName(rest).groupBy("field", "kind").agg(F.count(F.lit(1)).alias("n"))


def schema_profile(nodes: DataFrame) -> DataFrame:
    """(child, objects, parents, most): for each nested path of a node table its objects, holders and longest array.

    Objects alone: null elements after the last object don't count for most; path_profile has every path and true lengths.
    """
    per = nodes.groupBy("child", "owner", "parent_pos").agg(F.count(F.lit(1)).alias("n"), F.max("pos").alias("last"))
    return per.groupBy("child").agg(F.sum("n").alias("objects"), F.count(F.lit(1)).alias("parents"), (F.max("last") + 1).cast("long").alias("most"))


JSON_KINDS = {dict: "object", list: "array", str: "string", bool: "boolean", int: "integer", float: "number", type(None): "null"}
PROFILE_CHARS = 4_000_000


class PathCounts:
    """How often each path has each JSON type, and the greatest length of its arrays."""

    def __init__(self):
        self.size = 0
        self.held: dict[tuple[str, str], list[int]] = {}

    def add(self, path: str, kind: str, n: int = 1, longest: int = 0) -> None:
        at = self.held.get((path, kind))
        if at is None:
            self.held[path, kind] = [n, longest]
            self.size += len(path) + 50
        else:
            at[0] += n
            at[1] = max(at[1], longest)

    def value(self, path: str, value) -> None:
        todo = [(path, value)]
        while todo:
            path, value = todo.pop()
            if type(value) is dict:
                self.add(path, "object")
                todo += [(f"{path}.{k}", v) for k, v in value.items()]
            elif type(value) is list:
                self.add(path, "array", 1, len(value))
                todo += [(f"{path}[]", v) for v in value]
            else:
                self.add(path, JSON_KINDS.get(type(value), "string"))

    def text(self, path: str, text: str | bytes | None) -> None:
        """A JSON text; of JSON written as a JSON string, what it holds."""
        if text is None:
            return self.add(path, "null")
        try:
            value = strict_loads(text) if isinstance(text, str) else None
        except ValueError:
            return self.add(path, "malformed")
        if isinstance(text, bytes):
            return self.add(path, "malformed")
        while isinstance(value, str) and value.lstrip(" \t\n\r").startswith(JSON_START):
            try:
                value = strict_loads(value)
            except ValueError:
                break
        self.value(path, value)

    def column(self, path: str, values: pa.Array) -> None:
        """A typed column, level by level without Python values."""
        if values.null_count:
            self.add(path, "null", values.null_count)
            values = values.drop_null()
        t = values.type
        if not len(values):
            return
        if pa.types.is_struct(t):
            self.add(path, "object", len(values))
            for i in range(t.num_fields):
                self.column(f"{path}.{t.field(i).name}", values.field(i))
        elif pa.types.is_list(t) or pa.types.is_large_list(t):
            self.add(path, "array", len(values), pc.max(pc.list_value_length(values)).as_py())
            self.column(f"{path}[]", values.flatten())
        elif pa.types.is_map(t):
            for pairs in values.to_pylist():
                self.value(path, dict(pairs))
        else:
            kind = "boolean" if pa.types.is_boolean(t) else "integer" if pa.types.is_integer(t) else "number" if pa.types.is_floating(t) or pa.types.is_decimal(t) else "string"
            self.add(path, kind, len(values))

    def flush(self) -> pa.RecordBatch:
        held, self.held, self.size = self.held, {}, 0
        paths = [p.encode("utf-8", "backslashreplace").decode() for p, _ in held]
        longest = [m if k == "array" else None for (_, k), (_, m) in held.items()]
        return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array([k for _, k in held], pa.string()), pa.array([n for n, _ in held.values()], pa.int64()), pa.array(longest, pa.int64())], names=["path", "kind", "n", "longest"])


def path_profile(records: DataFrame, json_cols: tuple[str, ...] = ()) -> DataFrame:
    """(path, kind, n, longest): how often each path of the records has each JSON type; for arrays the greatest length.

    Every column is a path, the fields of its objects are `path.field`, the elements of its arrays `path[]`, at any depth,
    scalars and nulls too. JSON columns are read as the JSON they hold, unreadable text counts as `malformed`. Every row
    counts, repeated ones too. Counts are folded where records are read; only those move.
    """
    ship(records.sparkSession)

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = PathCounts()
        for batch in batches:
            for name, values in zip(batch.schema.names, batch.columns):
                if name not in json_cols:
                    seen.column(name, values)
                    continue
                for text in texts_of(values):
                    seen.text(name, text)
                    if seen.size > PROFILE_CHARS:
                        yield seen.flush()
        yield seen.flush()

    found = records.withColumns({c: F.col(c).cast("string") for c in json_cols}).mapInArrow(profile, "path string, kind string, n long, longest long")
    return found.groupBy("path", "kind").agg(F.sum("n").alias("n"), F.max("longest").alias("longest"))


def dangling(references: DataFrame, ref: str, known: DataFrame, key: str) -> DataFrame:
    """(ref): distinct references that nothing known has."""
    return references.select(ref).where(F.col(ref).isNotNull()).distinct().join(known.select(F.col(key).alias(ref)), ref, "left_anti")


def reference_counts(references: DataFrame, ref: str, known: DataFrame, key: str) -> DataFrame:
    """One row: known ids, distinct references, and how many of those are resolved and not."""
    refs = references.select(F.col(ref).alias("id")).where("id is not null").distinct().withColumn("is_ref", F.lit(1))
    ids = known.select(F.col(key).alias("id")).where("id is not null").distinct().withColumn("is_id", F.lit(1))
    j = refs.join(ids, "id", "full")
    n = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    a, b = F.col("is_ref") == 1, F.col("is_id") == 1
    return j.agg(n(b).alias("known"), n(a).alias("referenced"), n(a & b).alias("resolved"), n(a & F.col("is_id").isNull()).alias("unresolved"))


def byte_stats(table: DataFrame, column: str) -> DataFrame:
    """One row: number, total and greatest size of a column's values in bytes."""
    size = F.octet_length(F.col(column).cast("string")).cast("long")
    return table.agg(F.count(column).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes"), F.coalesce(F.max(size), F.lit(0)).alias("most"))
