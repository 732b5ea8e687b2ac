"""Nested records as flat tables of nodes, linked by interval labels."""

from __future__ import annotations

import sys
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.functions.strict_json import compact_json, storable, strict_loads, texts_of
from weftline.plans.runtime import ship

JSON_START = ("{", "[", '"')
NODE = ["id", "delivery", "child", "pos", "parent", "parent_pos", "pre", "post", "level", "data"]


def object_arrays(schema: T.StructType) -> list[str]:
    """Names of the fields that are arrays of structs."""
    return [f.name for f in schema.fields if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType)]


def skeleton(value: Column, struct: T.StructType, payload: bool) -> Column:
    """An element reduced to what the walk needs: its nested arrays, and with payload its other fields as JSON."""
    nested = object_arrays(struct)
    parts = [skeletons(value[n], struct[n].dataType.elementType, payload).alias(n) for n in nested]
    if payload:
        rest = [value[f.name].alias(f.name) for f in struct.fields if f.name not in nested]
        parts.append((F.to_json(F.struct(*rest)) if rest else F.lit("{}")).alias("$"))
    whole = F.struct(*parts) if parts else F.lit(True)
    return F.when(value.isNotNull(), whole)


def skeletons(values: Column, struct: T.StructType, payload: bool) -> Column:
    return F.transform(values, lambda x: skeleton(x, struct, payload))


def decoded(value):
    """A value with JSON text in strings taken as that JSON; text that can't be read stays what it is."""
    while isinstance(value, str) and value.lstrip(" \t\n\r").startswith(JSON_START):
        try:
            value = strict_loads(value)
        except ValueError:
            break
    return value


class Walk:
    """Numbers the objects of records depth first: pre on arrival, post on departure, counted through; see labels."""

    def __init__(self):
        self.pre_count = self.post_count = 0
        self.row, self.pos, self.level, self.post = (array("q") for _ in range(4))
        self.path: list[str] = []
        self.data: list[str | None] = []

    def member(self, row: int, path: str, value, level: int, text: bool) -> None:
        """A field's value: an array's objects get a node each; an object counts as an array's only element."""
        if text:
            value = decoded(value)
        if isinstance(value, dict):
            value = [value]
        elif not isinstance(value, list):
            return
        for pos, element in enumerate(value):
            if text:
                element = decoded(element)
            if isinstance(element, dict) or element is True and not text:
                node = self.pre_count
                self.pre_count += 1
                self.row.append(row)
                self.pos.append(pos)
                self.level.append(level)
                self.path.append(path)
                self.post.append(-1)
                self.data.append(None)
                if element is not True:
                    if text:
                        for k, v in element.items():
                            if type(v) in (list, dict, str):
                                self.member(row, f"{path}.{k}", v, level + 1, True)
                    else:
                        for k, v in element.items():
                            if k == "$":
                                self.data[node] = v
                            elif v:
                                self.member(row, f"{path}.{k}", v, level + 1, False)
                self.post[node] = self.post_count
                self.post_count += 1
                if text:
                    self.data[node] = element

    def parents(self) -> np.ndarray:
        """The parent of each node by interval containment, -1 at the top.

        Nodes of one level have disjoint intervals, so of the level above only the last one that begins before a node
        can contain it; it does if it ends after the node.
        """
        level, post = np.frombuffer(self.level, np.int64), np.frombuffer(self.post, np.int64)
        parent = np.full(len(level), -1, np.int64)
        for deep in range(2, int(level.max(initial=1)) + 1):
            own, above = np.flatnonzero(level == deep), np.flatnonzero(level == deep - 1)
            found = above[np.searchsorted(above, own) - 1]
            if not (post[found] > post[own]).all():
                raise AssertionError("a node lies outside its parent's interval")
            parent[own] = found
        return parent


    def labels(self) -> tuple[np.ndarray, np.ndarray]:
        """pre and post of each node within its own record; 0 is left for the pre of the record itself."""
        row = np.frombuffer(self.row, np.int64)
        first = np.searchsorted(row, row)  # nodes of a record stand together, and none of another is open meanwhile
        return np.arange(len(row)) - first + 1, np.frombuffer(self.post, np.int64) - first


def strings(values: list[str]) -> pa.Array:
    try:
        return pa.array(values, pa.string())
    except UnicodeEncodeError:  # keys of JSON may have halves of surrogate pairs
        return pa.array([storable(v) for v in values], pa.string())


def own_fields(element: dict) -> str:
    """An object's own fields as JSON: all but objects, JSON texts holding some, and arrays of nothing else.

    In an array that holds other values too, null stands for each object, as those are nodes of their own.
    """
    out = {}
    for k, v in element.items():
        held = decoded(v)
        if isinstance(held, list):
            plain = [None if isinstance(decoded(x), dict) else x for x in held]
            if not held or any(x is not None for x in plain):
                out[k] = plain
        elif not isinstance(held, dict):
            out[k] = v
    return compact_json(out)


def node_table(records: DataFrame, id_col: str, json_cols: tuple[str, ...] = (), *, payload: bool = True) -> DataFrame:
    """(id, delivery, child, pos, parent, parent_pos, pre, post, level, data): a row for each object inside the arrays of a
    record, and with payload one for the record itself (child is empty, level 0, pre 0).

    Looked at are the columns that are arrays of structs, at any depth, and the JSON columns, whose keys stand at the top
    level. child is the dotted field path, parent that of the element that holds the array (null at the top, parent_pos
    -1); pos counts null and non-object elements, which give no row. pre and post label each node with an interval, counted
    from 0 within its record: of the nodes of one delivery, a lies inside b exactly if b.pre < a.pre and a.post <
    b.post. delivery is a hash of the record's id and content, so it tells deliveries of one id apart and is the same
    however the table is partitioned; copies of a delivery have equal rows. data has the object's other fields as JSON.
    Without payload the records themselves, delivery and data are left out (null), and less is read. Arrays directly inside arrays,
    empty and null arrays and unreadable JSON give no rows. Each record is walked on its own where it is read: no
    shuffle.
    """
    ship(records.sparkSession)
    arrays = object_arrays(records.schema)
    columns = [skeletons(F.col(n), records.schema[n].dataType.elementType, payload).alias(f"a{i}") for i, n in enumerate(arrays)]
    texts = [F.col(n).cast("string").alias(f"t{i}") for i, n in enumerate(json_cols)]
    delivery = F.xxhash64(F.col(id_col), *columns, *texts) if payload else F.lit(None).cast("long")
    rows = records.select(F.col(id_col).alias("id"), delivery.alias("delivery"), *columns, *texts)
    n_arrays = len(arrays)

    def walk(batches):
        sys.setrecursionlimit(max(sys.getrecursionlimit(), 1_000_000))  # records may be nested deeply
        for batch in batches:
            for at in range(0, len(batch), 2000):
                part = batch.slice(at, 2000)
                w = Walk()
                lists = [texts_of(c) if pa.types.is_string(c.type) else c.to_pylist() for c in part.columns[2:]]
                for row in range(len(part)):
                    for name, values in zip(arrays, lists):
                        if values[row]:
                            w.member(row, name, values[row], 1, False)
                    for values in lists[n_arrays:]:
                        body = decoded(values[row])
                        if isinstance(body, dict):
                            for k, v in body.items():
                                if type(v) in (list, dict, str):
                                    w.member(row, k, v, 1, True)
                if payload:
                    sizes = np.bincount(np.frombuffer(w.row, np.int64), minlength=len(part))
                    n = len(part)
                    plain = [pa.array([x] * n, t) for x, t in (("", pa.string()), (0, pa.int32()), (None, pa.string()), (-1, pa.int32()), (0, pa.int64()))]
                    yield pa.RecordBatch.from_arrays([*part.columns[:2], *plain, pa.array(sizes.astype(np.int64)), pa.array([0] * n, pa.int32()), pa.array([None] * n, pa.string())], names=NODE)
                if not w.pre_count:
                    continue
                parent = w.parents()
                pre, post = w.labels()
                pos = np.frombuffer(w.pos, np.int64)
                path = strings(w.path)
                held = pa.array(parent, mask=parent < 0)
                owner = pa.array(np.frombuffer(w.row, np.int64))
                data = [own_fields(d) if isinstance(d, dict) else d for d in w.data] if payload else [None] * len(pos)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(owner), part.column(1).take(owner), path, pa.array(pos.astype(np.int32)), path.take(held), pa.array(np.where(parent < 0, -1, pos[parent]).astype(np.int32)), pa.array(pre), pa.array(post), pa.array(np.frombuffer(w.level, np.int64).astype(np.int32)), pa.array(data, pa.string())],
                    names=NODE,
                )

    kind = records.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(walk, f"id {kind}, delivery long, child string, pos int, parent string, parent_pos int, pre long, post long, level int, data string").withColumnRenamed("id", id_col)


def child_table(nodes: DataFrame, child: str, fields: str) -> DataFrame:
    """The flat table of one type of node: keys and labels, then the fields given as a DDL schema."""
    body = F.from_json("data", fields).alias("body")
    keys = [c for c in nodes.columns if c not in ("data", "child", "parent")]
    return nodes.where(F.col("child") == child).select(*keys, body).select(*keys, "body.*")
