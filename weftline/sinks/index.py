"""A search index over HTTP as the target of a run: created with its mapping, filled in bulk, completed and counted."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from dataclasses import dataclass
from http.client import HTTPException

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators.search import SCHEMA, Field
from weftline.plans.runtime import ship
from weftline.sinks.documents import RETRIED, SinkError, batches, pause_before, send_bulk


def field_mapping(field: Field) -> dict:
    """How one searchable field is indexed: no norms or positions, and columns only where a search needs them."""
    if field.kind == "text":
        keyword = {"fields": {"keyword": {"type": "keyword", "ignore_above": field.ignore_above}}} if field.term else {}
        return {"type": "text", "norms": False, "index_options": "docs", **keyword}
    if field.kind == "long":
        return {"type": "long", "doc_values": False, **({} if field.term else {"index": False})}
    return {"type": field.kind, **({"ignore_above": field.ignore_above} if field.ignore_above else {})}


def index_body(schema: dict[str, Field] = SCHEMA, shards: int = 4) -> dict:
    """Settings and mapping of an index; fields that the schema doesn't name are kept but not searched.

    While it is filled nothing is refreshed; an accepted bulk request is on disk.
    """
    properties: dict = {}
    for path, field in schema.items():
        *outer, leaf = path.split(".")
        at = properties
        for name in outer:
            at = at.setdefault(name, {"type": "object", "dynamic": False, "properties": {}})["properties"]
        at[leaf] = field_mapping(field)
    settings = {"number_of_shards": shards, "number_of_replicas": 0, "refresh_interval": "-1", "translog.durability": "request"}
    return {"settings": settings, "mappings": {"dynamic": False, "properties": properties}}


def http(method: str, url: str, data: bytes | None) -> tuple[int, bytes]:
    request = urllib.request.Request(url, data=data, method=method, headers={"Content-Type": "application/json"})
    try:
        with urllib.request.urlopen(request, timeout=60) as r:
            return r.status, r.read()
    except urllib.error.HTTPError as e:
        return e.code, e.read()


@dataclass
class SearchIndex:
    """One index behind an address. Control requests are repeated while the service is busy or out of reach; errors name the
    step and never repeat what the service says, as that may hold documents."""

    url: str
    name: str
    retries: int = 6
    pause: float = 0.5
    request: object = http
    sleep: object = time.sleep

    def ask(self, step: str, method: str, path: str, body: dict | None = None) -> tuple[int, bytes]:
        data = None if body is None else json.dumps(body).encode()
        why = "is out of reach"
        for attempt in range(self.retries + 1):
            if attempt:
                self.sleep(pause_before(attempt, self.pause))
            try:
                status, reply = self.request(method, f"{self.url.rstrip('/')}/{path}", data)
            except (OSError, HTTPException):
                continue
            if status not in RETRIED:
                return status, reply
            why = f"answers with status {status}"
        raise SinkError(f"{step}: the index {why}")

    def do(self, step: str, method: str, path: str, body: dict | None = None) -> dict:
        """A request that must succeed wholly: acknowledged where that is said, and on every shard."""
        status, reply = self.ask(step, method, path, body)
        if status // 100 != 2:
            raise SinkError(f"{step}: status {status}")
        try:
            said = json.loads(reply)
        except ValueError:
            said = None
        if not isinstance(said, dict):
            raise SinkError(f"{step}: the reply is no JSON object")
        if said.get("acknowledged", True) is not True:
            raise SinkError(f"{step}: not acknowledged")
        if "_shards" in said:
            shards = said["_shards"] if isinstance(said["_shards"], dict) else {}
            total, done, failed = (shards.get(k) for k in ("total", "successful", "failed"))
            if any(type(n) is not int or n < 0 for n in (total, done, failed)) or failed or done != total:
                raise SinkError(f"{step}: not done on all shards")
        return said

    def create(self, body: dict, *, reset: bool = False) -> None:
        """Makes the index. One that exists is refused, and with reset replaced; no other index is touched."""
        status, _ = self.ask("look for the index", "HEAD", self.name)
        if status == 200:
            if not reset:
                raise SinkError(f"the index {self.name} exists; only a run with reset replaces it")
            self.do("delete the index", "DELETE", self.name)
        elif status != 404:
            raise SinkError(f"look for the index: status {status}")
        self.do("create the index", "PUT", self.name, body)

    def finish(self, acknowledged: int) -> int:
        """Makes everything searchable and durable and returns the count, which must be what was acknowledged."""
        self.do("set the refresh interval", "PUT", f"{self.name}/_settings", {"index": {"refresh_interval": "1s"}})
        self.do("flush", "POST", f"{self.name}/_flush?wait_if_ongoing=true")
        self.do("refresh", "POST", f"{self.name}/_refresh")
        count = self.do("count", "GET", f"{self.name}/_count").get("count")
        if type(count) is not int or count < 0:
            raise SinkError("count: the reply has no count")
        if count != acknowledged:
            raise SinkError(f"count mismatch: index={count}, acknowledged={acknowledged}")
        return count


FIGURES = ("indexed", "retried", "requests", "sent_bytes")


def send_documents(docs: DataFrame, url: str, index: str, *, most_bytes: int = 8 * 1024 * 1024, most_docs: int = 2000) -> dict[str, int]:
    """Sends documents (id, doc) from every task and returns the sums of FIGURES.

    A task that runs again sends its documents again, which replaces them by id; its figures count once.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col("id").cast("string").alias("id"), "doc")

    def send(arrow):
        sums = dict.fromkeys(FIGURES, 0)
        pairs = (p for b in arrow for p in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        for batch in batches(pairs, most_bytes, most_docs):
            for k, v in send_bulk(url.rstrip("/"), index, batch).items():
                sums[k] += v
        yield pa.RecordBatch.from_arrays([pa.array([sums[k]], pa.int64()) for k in FIGURES], names=list(FIGURES))

    done = rows.mapInArrow(send, ", ".join(f"{k} long" for k in FIGURES))
    return {k: v or 0 for k, v in done.agg(*[F.sum(k).alias(k) for k in FIGURES]).first().asDict().items()}
