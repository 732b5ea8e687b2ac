"""Envelope feeds: folders of (compressed) files with one JSON document a line, read strictly and with line numbers."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.functions.strict_json import compact_json, is_id, strict_loads, texts_of
from weftline.operators.rejects import check_body
from weftline.plans.runtime import settle, ship

MAX_LINE_BYTES = 16 * 1024 * 1024
#: Of an organization's body as compact JSON, which is embedded as often as it is referred to.
MAX_BODY_BYTES = 16 * 1024 * 1024


class FeedError(ValueError):
    """A feed that may not be loaded; the message names file, line and reason, never content."""


def feed_files(spark: SparkSession, path: str, pattern: str = "*.json*") -> list[str]:
    """The files of a feed, sorted; an empty feed is an error."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    glob = hadoop.Path(f"{path}/{pattern}")
    found = glob.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(glob)
    files = sorted(str(f.getPath().toString()) for f in found or [])
    if not files:
        raise FeedError(f"no files match {path}/{pattern}")
    return files


#: Splits whose line counts are broadcast at most; of more, they are joined by a shuffle.
MOST_BROADCAST_SPLITS = 100_000


def feed_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, line, bytes, text): every line of the files, blank ones too, numbered from 1 within its file.

    Only a line feed ends a line. Lines are counted as they are read, so nothing is shuffled. Only of files that can be
    read in several splits the lines of each split are counted first, and a line's number is its place in its split
    plus the lines of the file's splits before it. bytes counts the line feed.
    """
    ship(spark)
    raw = spark.read.option("lineSep", "\n").text(paths).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"))

    def number(batches):
        at, n = None, 0
        for batch in batches:
            place = []
            for key in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                at, n = key, n + 1 if key == at else 1
                place.append(n)
            yield batch.append_column("place", pa.array(place, pa.int64()))

    lines = raw.mapInArrow(number, "value string, file string, split long, place long")
    line = F.col("place")
    if not all(f.endswith(".gz") for f in raw.inputFiles()):
        before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        splits = settle(raw.groupBy("file", "split").agg(F.count(F.lit(1)).alias("n")).select("file", "split", before.alias("before")))
        lines = lines.join(F.broadcast(splits) if splits.count() <= MOST_BROADCAST_SPLITS else splits, ["file", "split"])
        line = line + F.col("before")
    return lines.select("file", line.alias("line"), (F.octet_length("value") + 1).alias("bytes"), F.col("value").alias("text"))


def check_person(body: dict) -> str | None:
    """What is wrong with the references of a person's body."""
    roles = body.get("roles", [])
    if not isinstance(roles, list):
        return "roles is not an array"
    for role in roles:
        if not isinstance(role, dict):
            return "a role is not an object"
        ref = role.get("organization_id")
        if ref is not None and not is_id(ref):
            return "a role's organization_id is not an integer from 0 to 2^63-1"
    return None


#: Members of a person's document that enrichment writes.
OWN = ("roles", "organizations", "unresolved_organization_ids", "has_unresolved_organizations")
FLAG = "organization_unresolved"


def taken_apart(body: dict) -> tuple[str, list[tuple[int | None, str]]]:
    """A person's members but OWN as JSON without braces, and of each role its reference and its JSON up to the flag."""
    roles = []
    for role in body.get("roles", ()):
        inner = compact_json({k: v for k, v in role.items() if k != FLAG})[1:-1]
        roles.append((role.get("organization_id"), f"{{{inner}," if inner else "{"))
    return compact_json({k: v for k, v in body.items() if k not in OWN})[1:-1], roles


def part_arrays(rows: list[tuple]) -> list[pa.Array]:
    """id, rest, roles and reason of read lines (id, taken apart, reason)."""
    roles = [body[1] if body else [] for _, body, _ in rows]
    ends = [0]
    for r in roles:
        ends.append(ends[-1] + len(r))
    flat = pa.StructArray.from_arrays([pa.array([ref for r in roles for ref, _ in r], pa.int64()), pa.array([head for r in roles for _, head in r], pa.string())], names=["ref", "head"])
    return [pa.array([i for i, _, _ in rows], pa.int64()), pa.array([body and body[0] for _, body, _ in rows], pa.string()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat), pa.array([r for _, _, r in rows], pa.string())]


def envelopes(lines: DataFrame, kind: str = "organization", *, parts: bool = False) -> DataFrame:
    """(file, line, bytes, id, body, reason) of lines (file, line, bytes, text): the body as compact JSON, or the reason.

    A line is one strict JSON object with an integer id, an object serialized_data whose forager_id, if it has one, equals
    the id, and at most 16 MiB; an organization's body has at most 16 MiB as compact JSON. Bodies of kind `person` must also have well-formed role references.
    """
    ship(lines.sparkSession)
    longest = MAX_BODY_BYTES

    def read(text: str | bytes | None, size: int) -> tuple:
        if size > MAX_LINE_BYTES:
            return None, None, "record is too long"
        if isinstance(text, bytes) or text is None or not text.strip(" \t\r\n"):
            return None, None, "malformed JSON record"
        try:
            envelope = strict_loads(text)
        except ValueError:
            return None, None, "malformed JSON record"
        if not isinstance(envelope, dict):
            return None, None, "record is not an object"
        ident, body = envelope.get("id"), envelope.get("serialized_data")
        if not is_id(ident):
            return None, None, "id is not an integer from 0 to 2^63-1"
        wrong = check_body(body, ident)
        reason = wrong[1] if wrong else check_person(body) if kind == "person" else None
        if reason:
            return None, None, reason
        if parts:
            return ident, taken_apart(body), None
        compact = compact_json(body)
        if kind == "organization" and len(compact.encode()) > longest:
            return None, None, "serialized_data is too long"
        return ident, compact, None

    def load(batches):
        for batch in batches:
            rows = [read(t, s) for t, s in zip(texts_of(batch.column(3)), batch.column(2).to_pylist())]
            if parts:
                yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), *part_arrays(rows)], names=["file", "line", "bytes", "id", "rest", "roles", "reason"])
                continue
            out = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.string(), pa.string()))] if rows else [pa.array([], t) for t in (pa.int64(), pa.string(), pa.string())]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), *out], names=["file", "line", "bytes", "id", "body", "reason"])

    rows = lines.select(F.col("file").cast("string"), F.col("line").cast("long"), F.col("bytes").cast("long"), "text")
    body = "rest string, roles array<struct<ref: bigint, head: string>>" if parts else "body string"
    return rows.mapInArrow(load, f"file string, line long, bytes long, id long, {body}, reason string")


def demand_valid(loaded: DataFrame) -> DataFrame:
    """(file, line, bytes, id, body); raises for the first line that fails, by file and line."""
    first = loaded.where("reason is not null").orderBy("file", "line").select("file", "line", "reason").head()
    if first:
        raise FeedError(f"{first.file.rsplit('/', 1)[-1]}:{first.line}: {first.reason}")
    return loaded.drop("reason")


def demand_unique(loaded: DataFrame, what: str) -> DataFrame:
    """The same rows; raises if an id comes twice."""
    twice = loaded.groupBy("id").count().where("count > 1").orderBy("id").head()
    if twice:
        raise FeedError(f"duplicate {what} id {twice.id}")
    return loaded
