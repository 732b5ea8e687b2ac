"""Sinks for documents: Parquet with reconciled counts, and a bulk HTTP index with selective retries."""

from __future__ import annotations

import json
import os
import random
import time
import urllib.error
import urllib.request
from dataclasses import dataclass
from http.client import HTTPException

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

RETRIED = frozenset((429, 502, 503, 504))
MAX_DOC_BYTES = 32 * 1024 * 1024


class SinkError(RuntimeError):
    """A write that failed for good; the message names ids and types, never content."""


def write_table(docs: DataFrame, path: str, id_col: str = "id", *, reset: bool = False) -> dict[str, int]:
    """Writes documents as Parquet and reads the counts back; an existing table is refused unless reset.

    Ids must be unique: the rows written must equal the distinct ids read.
    """
    seen = Observation()
    docs.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite" if reset else "errorifexists").parquet(path)
    acknowledged = int(seen.get["n"])
    held = docs.sparkSession.read.parquet(path).select(id_col).distinct().count()
    if held != acknowledged:
        raise SinkError(f"count mismatch: sink={held}, acknowledged={acknowledged}")
    return {"acknowledged": acknowledged, "indexed": held}


def _request(url: str, data: bytes, method: str = "POST") -> tuple[int, bytes]:
    headers = {"Content-Type": "application/x-ndjson"}
    with urllib.request.urlopen(urllib.request.Request(url, data=data, headers=headers, method=method), timeout=60) as r:
        return r.status, r.read()


def pause_before(attempt: int, pause: float) -> float:
    """Seconds to wait before a repeat: twofold each time up to 30 s, with jitter so that tasks don't come at once."""
    return min(30.0, pause * 2 ** (attempt - 1)) * random.uniform(0.75, 1.25)


def sort_reply(reply: bytes, ids: list[str]) -> tuple[list[int], tuple[str, str] | None]:
    """(places of documents to send again, id and reason of the first one refused for good) from the reply to a bulk request.

    An error if the reply doesn't answer the request item by item, or contradicts itself: success may not come with an
    error, and the flag for errors must be a boolean that agrees with the items.
    """
    try:
        body = json.loads(reply)
    except ValueError:
        raise SinkError("bulk reply can't be read") from None
    items = body.get("items") if isinstance(body, dict) else None
    results = [x["index"] for x in items if isinstance(x, dict) and list(x) == ["index"] and isinstance(x["index"], dict)] if isinstance(items, list) else []
    if not isinstance(items, list) or not len(items) == len(results) == len(ids) or any(type(r.get("status")) is not int for r in results):
        raise SinkError("bulk reply doesn't fit the request")
    good = [r["status"] // 100 == 2 for r in results]
    if any(ok and "error" in r for ok, r in zip(good, results)) or body.get("errors") is not (not all(good)):
        raise SinkError("bulk reply contradicts itself about errors")
    again = [i for i, r in enumerate(results) if r["status"] in RETRIED]
    refused = next((i for i, ok in enumerate(good) if not ok and results[i]["status"] not in RETRIED), None)
    if refused is None:
        return again, None
    error = results[refused].get("error")
    return again, (ids[refused], str(error.get("type", "unknown")) if isinstance(error, dict) else "unknown")


def send_bulk(url: str, index: str, docs: list[tuple[str, bytes]], *, retries: int = 6, pause: float = 0.5, request=_request, sleep=time.sleep) -> dict[str, int]:
    """Upserts documents (id, JSON) by id. Only refused ones are sent again; a lost or cut reply resends all of them.

    A permanent refusal or a reply that doesn't fit the request is an error, which names the id and never the content.
    """
    left, figures = docs, {"indexed": len(docs), "retried": 0, "requests": 0, "sent_bytes": 0}
    for attempt in range(retries + 1):
        if attempt:
            sleep(pause_before(attempt, pause))
            figures["retried"] += len(left)
        payload = b"".join(json.dumps({"index": {"_index": index, "_id": i}}).encode() + b"\n" + d + b"\n" for i, d in left)
        figures["requests"] += 1
        figures["sent_bytes"] += len(payload)
        try:
            status, reply = request(f"{url}/_bulk", payload)
        except urllib.error.HTTPError as e:
            status, reply = e.code, b""
        except (OSError, HTTPException):
            continue
        if status in RETRIED:
            continue
        if status != 200:
            raise SinkError(f"bulk request refused with status {status}")
        again, refused = sort_reply(reply, [i for i, _ in left])
        if refused:
            raise SinkError(f"document {refused[0]} refused: {refused[1]}")
        left = [left[i] for i in again]
        if not left:
            return figures
    raise SinkError(f"{len(left)} documents not accepted after {retries} retries")


def batches(rows, most_bytes: int, most_docs: int):
    """Lists of (id, JSON) of at most so many bytes and documents."""
    held, used = [], 0
    for ident, doc in rows:
        raw = doc.encode()
        if len(raw) + 96 > MAX_DOC_BYTES:
            raise SinkError(f"document {ident} is too long")
        if held and (used + len(raw) > most_bytes or len(held) >= most_docs):
            yield held
            held, used = [], 0
        held.append((str(ident), raw))
        used += len(raw)
    if held:
        yield held


@dataclass
class Sent(WriterCommitMessage):
    indexed: int
    retried: int


class BulkWriter(DataSourceWriter):
    def __init__(self, options: dict[str, str]):
        self.url, self.index = options["url"].rstrip("/"), options["index"]
        self.most_bytes, self.most_docs = int(options.get("mostbytes", 8 * 1024 * 1024)), int(options.get("mostdocs", 2000))

    def write(self, rows) -> Sent:
        indexed = retried = 0
        for batch in batches(((r[0], r[1]) for r in rows), self.most_bytes, self.most_docs):
            done = send_bulk(self.url, self.index, batch)
            indexed, retried = indexed + done["indexed"], retried + done["retried"]
        return Sent(indexed, retried)

    def commit(self, messages: list) -> None:
        """Upserts are idempotent; there is nothing to publish."""

    def abort(self, messages: list) -> None:
        """A failed write leaves what was acknowledged; a repeat overwrites it by id."""


class BulkIndex(DataSource):
    """`df.select("id", "doc").write.format("bulk_index").option("url", ...).option("index", ...).mode("append").save()`"""

    @classmethod
    def name(cls) -> str:
        return "bulk_index"

    def schema(self) -> str:
        return "id string, doc string"

    def writer(self, schema, overwrite: bool) -> BulkWriter:
        return BulkWriter(self.options)


def write_metrics(path: str, metrics: dict) -> None:
    """Replaces a metrics file at once, so that readers see the old or the new one whole."""
    held = f"{path}.tmp"
    with open(held, "w") as f:
        json.dump(metrics, f, indent=2, sort_keys=True)
    os.replace(held, path)
