"""The search index as a target: against a small server that keeps documents by id."""

import json
import threading
from http.client import RemoteDisconnected
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from tests.test_feeds import envelope
from tests.test_pipeline import folders, metrics
from weftline.operators import search
from weftline.plans.config import RunConfig
from weftline.plans.pipeline import ingest, report
from weftline.sinks.documents import SinkError, send_bulk, sort_reply
from weftline.sinks.index import SearchIndex, index_body, send_documents


class Service:
    """Indices by name: their bodies and documents. busy holds how often each bulk item is put off first."""

    def __init__(self, lose=()):
        self.indices, self.lose, self.busy, self.log = {}, set(lose), {}, []
        service = self

        class Handler(BaseHTTPRequestHandler):
            def handle_any(self):
                raw = self.rfile.read(int(self.headers.get("Content-Length") or 0))
                status, body = service.answer(self.command, self.path.split("?")[0].strip("/"), raw)
                data = b"" if self.command == "HEAD" else json.dumps(body).encode()
                self.send_response(status)
                self.send_header("Content-Length", str(len(data)))
                self.end_headers()
                self.wfile.write(data)

            do_GET = do_HEAD = do_PUT = do_POST = do_DELETE = handle_any

            def log_message(self, *a):
                pass

        self.server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        self.url = f"http://127.0.0.1:{self.server.server_port}"

    def answer(self, method, path, raw):
        self.log.append(f"{method} {path}")
        if path == "_bulk":
            lines = raw.splitlines()
            items = []
            for head, doc in zip(lines[::2], lines[1::2]):
                at = json.loads(head)["index"]
                wait = self.busy.get(at["_id"], 0)
                self.busy[at["_id"]] = wait - 1
                if wait <= 0 and at["_id"] not in self.lose:
                    self.indices[at["_index"]]["docs"][at["_id"]] = json.loads(doc)
                items.append({"index": {"status": 429, "error": {"type": "busy"}} if wait > 0 else {"status": 201}})
            return 200, {"errors": any(x["index"]["status"] > 299 for x in items), "items": items}
        name, _, rest = path.partition("/")
        held = self.indices.get(name)
        if method == "PUT" and not rest:
            self.indices[name] = {"body": json.loads(raw), "docs": {}}
        elif held is None:
            return 404, {}
        elif method == "DELETE":
            del self.indices[name]
        elif rest == "_settings":
            held["settings"] = json.loads(raw)
        elif rest == "_count":
            return 200, {"count": len(held["docs"]), "_shards": {"total": 4, "successful": 4, "failed": 0}}
        return 200, {"acknowledged": True}


@pytest.fixture
def service():
    s = Service()
    yield s
    s.server.shutdown()


def test_a_run_fills_a_new_index(spark, tmp_path, service):
    config = folders(tmp_path, [[envelope(i, roles=[{"organization_id": 8}]) for i in range(k, k + 20)] for k in (0, 100)], [[envelope(8, name="h")]])
    settings = {"persons": config.persons, "organizations": config.organizations, "bulk_url": service.url, "bulk_docs": 7, "index_shards": 2}
    service.busy = {"3": 2, "104": 1}
    service.indices["other"] = {"docs": {"1": {}}}
    done = ingest(spark, RunConfig(out=str(tmp_path / "out"), **settings))
    held = service.indices["persons"]
    assert held["body"] == index_body(shards=2) and held["settings"] == {"index": {"refresh_interval": "1s"}}
    assert len(held["docs"]) == 40 and held["docs"]["105"]["organizations"] == [{"forager_id": 8, "name": "h"}]
    assert (done["bulk_indexed"], done["index_count"], done["bulk_retried"]) == (40, 40, 3) and done["bulk_requests"] >= 9 and done["bulk_sent_bytes"] > 0
    assert [x for x in service.log if "_bulk" not in x] == ["HEAD persons", "PUT persons", "PUT persons/_settings", "POST persons/_flush", "POST persons/_refresh", "GET persons/_count"]
    assert done["task_seconds"] > 0 and "bulk_retried" in report(str(tmp_path / "out/metrics.json"))

    with pytest.raises(SinkError, match="exists"):
        ingest(spark, RunConfig(out=str(tmp_path / "again"), **settings))
    assert len(service.indices["persons"]["docs"]) == 40
    service.indices["persons"]["docs"]["old"] = {}
    assert ingest(spark, RunConfig(out=str(tmp_path / "again"), reset=True, **settings))["index_count"] == 40
    assert "old" not in service.indices["persons"]["docs"] and service.indices["other"]["docs"] == {"1": {}}


def test_a_lost_document_fails_the_run(spark, tmp_path, service):
    service.lose = {"1"}
    config = folders(tmp_path, [[envelope(i) for i in range(3)]], [[envelope(8)]])
    with pytest.raises(SinkError, match="count mismatch: index=2, acknowledged=3"):
        ingest(spark, RunConfig(config.persons, config.organizations, config.out, bulk_url=service.url))
    assert metrics(tmp_path)["status"] == "failed" and metrics(tmp_path)["persons_per_second"] == 0


def test_no_documents(spark, service):
    service.answer("PUT", "persons", b"{}")
    assert send_documents(spark.createDataFrame([], "id long, doc string"), service.url, "persons") == {"indexed": 0, "retried": 0, "requests": 0, "sent_bytes": 0}
    assert SearchIndex(service.url, "persons").finish(0) == 0


def test_mapping_follows_the_search_schema():
    fields = index_body()["mappings"]["properties"]
    for path, field in search.SCHEMA.items():
        outer, _, leaf = path.rpartition(".")
        made = (fields[outer]["properties"] if outer else fields)[leaf]
        assert made["type"] == field.kind
        assert field.term == ("keyword" in made.get("fields", {}) if field.kind == "text" else made.get("index", True))
        assert field.ignore_above in (None, made.get("ignore_above"), made.get("fields", {}).get("keyword", {}).get("ignore_above"))


def scripted(*answers):
    left, asked = list(answers), []

    def request(*a):
        asked.append(a)
        x = left.pop(0)
        if isinstance(x, Exception):
            raise x
        return x

    return request, asked


def test_control_requests_are_repeated_while_the_service_is_away():
    request, asked = scripted(OSError(), RemoteDisconnected(), (502, b"secret"), (200, b"{}"))
    waits = []
    assert SearchIndex("http://x/", "i", pause=1.0, request=request, sleep=waits.append).do("flush", "POST", "i/_flush") == {}
    assert len(asked) == 4 and asked[0][1] == "http://x/i/_flush" and all(0.75 * 2**k <= w <= 1.25 * 2**k for k, w in enumerate(waits))
    request, asked = scripted(*[(503, b"secret")] * 3)
    with pytest.raises(SinkError, match="^flush: the index answers with status 503$"):
        SearchIndex("http://x", "i", retries=2, request=request, sleep=waits.append).do("flush", "POST", "i/_flush")


@pytest.mark.parametrize(
    "status,reply",
    [
        (400, b"{}"), (200, b"secret"), (200, b"[]"), (200, b'{"acknowledged":false}'), (200, b'{"acknowledged":1}'), (200, b'{"_shards":3}'), (200, b'{"_shards":{"total":2,"successful":1,"failed":0}}'),
        (200, b'{"_shards":{"total":2,"successful":2,"failed":1}}'), (200, b'{"_shards":{"total":true,"successful":true,"failed":0}}'), (200, b'{"_shards":{"total":2,"successful":2}}'),
    ],
)
def test_half_done_requests_are_errors(status, reply):
    with pytest.raises(SinkError) as e:
        SearchIndex("http://x", "i", request=lambda *a: (status, reply)).do("count", "GET", "i/_count")
    assert "secret" not in str(e.value)


@pytest.mark.parametrize("said", [{}, {"count": -1}, {"count": True}, {"count": 4.0}, {"count": "4"}, {"count": 5}])
def test_counts_must_be_what_was_acknowledged(said):
    with pytest.raises(SinkError, match="count"):
        SearchIndex("http://x", "i", request=lambda m, u, d: (200, json.dumps(said if "_count" in u else {}).encode())).finish(4)


def items(*results, **more):
    return json.dumps({"items": [{"index": r} for r in results], **more}).encode()


def test_replies_are_sorted():
    assert sort_reply(items({"status": 200}, {"status": 504}, {"status": 502, "error": {}}, errors=True), ["a", "b", "c"]) == ([1, 2], None)
    assert sort_reply(items({"status": 429}, {"status": 409, "error": {"type": "kept", "reason": "secret"}}, errors=True), ["a", "b"]) == ([0], ("b", "kept"))
    assert sort_reply(items({"status": 413, "error": "secret"}, errors=True), ["a"]) == ([], ("a", "unknown"))
    assert sort_reply(items(errors=False), []) == ([], None)


@pytest.mark.parametrize(
    "reply",
    [
        b"", b"[1]", b"{}", items({"status": 200}), items({"status": 200}, errors="false"), items({"status": 200}, errors=0), items({"status": 200}, errors=True), items({"status": 503}, errors=False), items({"status": 200, "error": {"type": "x"}}, errors=False),
        items({"status": 200}, {"status": 200}, errors=False), items({"status": "200"}, errors=False), items({}, errors=False), b'{"errors":false,"items":[{"create":{"status":200}}]}', b'{"errors":false,"items":[{"index":{"status":200},"x":1}]}', b'{"errors":false,"items":{"index":{"status":200}}}',
    ],
)
def test_replies_that_do_not_answer_are_errors(reply):
    with pytest.raises(SinkError):
        sort_reply(reply, ["a"])


def test_a_cut_reply_sends_all_again():
    request, asked = scripted(RemoteDisconnected(), (200, items({"status": 201}, {"status": 200}, errors=False)))
    done = send_bulk("http://x", "i", [("a", b"{}"), ("b", b"{}")], request=request, sleep=lambda s: None)
    assert done["indexed"] == 2 and done["retried"] == 2 and done["requests"] == 2 and asked[0] == asked[1]
