"""Feed files, validation, enrichment of documents, sinks and the stream."""

import gzip
import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from weftline.operators import checks
from weftline.operators.enrich import enrich, enrich_documents, enrich_parts, totals
from weftline.sinks import documents as sink
from weftline.sources import feeds
from weftline.streaming.ingest import start_ingest


def write(path, *lines, cut=0):
    raw = gzip.compress("".join(x + "\n" for x in lines).encode())
    path.write_bytes(raw[: len(raw) - cut])


def envelope(ident, **body):
    return json.dumps({"id": ident, "date_updated": "2024-01-01", "serialized_data": {"forager_id": ident, **body}})


def test_lines_are_numbered_in_each_file(spark, tmp_path):
    write(tmp_path / "b.json.gz", *[f"x{i}" for i in range(1, 701)])
    write(tmp_path / "a.json.gz", "one", "", "three\rstill three")
    plain = tmp_path / "c.json"
    plain.write_text("".join(f"p{i}\n" for i in range(1, 5001)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        rows = feeds.feed_lines(spark, feeds.feed_files(spark, str(tmp_path))).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    by = {(r.file.rsplit("/", 1)[-1], r.line): r for r in rows}
    assert len(by) == len(rows) == 700 + 3 + 5000
    compressed = feeds.feed_lines(spark, [f for f in feeds.feed_files(spark, str(tmp_path)) if f.endswith(".gz")])
    assert {(r.file, r.line, r.text) for r in compressed.collect()} == {(r.file, r.line, r.text) for r in rows if r.file.endswith(".gz")}
    assert "Exchange" not in compressed._jdf.queryExecution().executedPlan().toString()
    assert all(by["b.json.gz", i].text == f"x{i}" for i in range(1, 701))
    assert all(by["c.json", i].text == f"p{i}" for i in range(1, 5001))
    assert by["a.json.gz", 2].text == "" and by["a.json.gz", 3].text == "three\rstill three" and by["a.json.gz", 3].bytes == 18
    with pytest.raises(feeds.FeedError):
        feeds.feed_files(spark, str(tmp_path / "none"))


#: One line for each rule of an envelope, broken alone: the document, its shape, each kind of id, the body, the two ids.
BROKEN = [
    '{"id": 4, "serialized_data": {"secret"', '{"id": 4, "serialized_data": {}} {"secret": 0}', "\t", '"secret"', "17", '[{"id": 4, "serialized_data": {}}]',
    '{"serialized_data": {"secret": 1}}', '{"id": null, "serialized_data": {}}', '{"id": "four", "serialized_data": {}}', '{"id": 4.0, "serialized_data": {}}', '{"id": false, "serialized_data": {}}', '{"id": -4, "serialized_data": {}}', '{"id": 18446744073709551616, "serialized_data": {}}',
    '{"id": 4}', '{"id": 4, "serialized_data": null}', '{"id": 4, "serialized_data": "secret"}', '{"id": 4, "serialized_data": [{}]}', '{"id": 4, "serialized_data": {"forager_id": "4"}}', '{"id": 4, "serialized_data": {"forager_id": 40}}',
]


@pytest.mark.parametrize("bad", BROKEN)
def test_first_bad_line_is_named_without_content(spark, tmp_path, bad):
    write(tmp_path / "f.json.gz", envelope(1), bad)
    with pytest.raises(feeds.FeedError) as e:
        feeds.demand_valid(feeds.envelopes(feeds.feed_lines(spark, str(tmp_path))))
    assert str(e.value).startswith("f.json.gz:2: ") and "secret" not in str(e.value)


def test_truncated_file_is_an_error(spark, tmp_path):
    write(tmp_path / "f.json.gz", *[envelope(i) for i in range(50)], cut=8)
    with pytest.raises((PySparkException, Exception)):
        feeds.feed_lines(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("roles,ok", [([], True), ([{"organization_id": 8}, {"organization_id": None}, {}], True), ([{"organization_id": "8"}], False), ([{"organization_id": True}], False), ([{"organization_id": {}}], False), ([{"organization_id": 8.5}], False), ([5], False), (None, False), ({}, False)])
def test_person_references(roles, ok):
    assert (feeds.check_person({"roles": roles}) is None) == ok


def test_long_organization_bodies_are_refused(spark, monkeypatch):
    lines = spark.createDataFrame([("f", 1, 9, envelope(1, x="y" * 99)), ("f", 2, 9, envelope(2))], "file string, line long, bytes long, text string")
    monkeypatch.setattr(feeds, "MAX_BODY_BYTES", 60)
    assert {r.line: r.reason for r in feeds.envelopes(lines).collect()} == {1: "serialized_data is too long", 2: None}
    assert feeds.envelopes(lines, "person").where("reason is not null").count() == 0


def test_duplicate_ids_are_an_error(spark):
    rows = spark.createDataFrame([(8, "{}"), (8, "{}"), (3, "{}")], "id long, body string")
    with pytest.raises(feeds.FeedError, match="duplicate organization id 8"):
        feeds.demand_unique(rows, "organization")


PERSON = {"forager_id": 1, "x": {"deep": [1, 2]}, "organizations": [777], "roles": [{"organization_id": 8, "k": "v"}, {"organization_id": 3}, {"organization_id": 8}, {"organization_id": 999}, {"organization_id": 999}, {"organization_id": None}, {"no": 1}]}


def feed(spark, persons, orgs):
    df = lambda rows: spark.createDataFrame([(i, json.dumps(b)) for i, b in rows], "id long, body string")
    return enrich_documents(df(persons), df(orgs)).withColumn("doc", F.to_json("doc"))


def test_documents_keep_everything_and_embed_once_in_order(spark):
    out = {r.id: r for r in feed(spark, [(1, PERSON), (2, {"roles": [], "a": None}), (3, {"b": 1})], [(3, {"name": "c", "z": [1]}), (8, {"name": "h"}), (30, {})]).collect()}
    doc = json.loads(out[1].doc)
    assert doc["organizations"] == [{"name": "h"}, {"name": "c", "z": [1]}] and doc["x"] == {"deep": [1, 2]}
    assert [r["organization_unresolved"] for r in doc["roles"]] == [False, False, False, True, True, False, False] and doc["roles"][0]["k"] == "v"
    assert doc["unresolved_organization_ids"] == [999] and doc["has_unresolved_organizations"] is True
    assert (out[1].n_roles, out[1].n_resolved, out[1].n_unresolved) == (7, 3, 2)
    assert json.loads(out[2].doc) == {"a": None, "roles": [], "organizations": [], "unresolved_organization_ids": [], "has_unresolved_organizations": False}
    assert json.loads(out[3].doc)["roles"] == [] and json.loads(out[3].doc)["b"] == 1


def test_documents_from_parts_equal_documents(spark):
    people = [PERSON, {}, {"roles": []}, {"b": 1, "has_unresolved_organizations": "old", "roles": [{"organization_unresolved": 5}, {"organization_id": 3, "t": ["é", {}]}]}, {"big": 10**30, "s": "\\ \" x", "roles": [{"organization_id": 5}] * 4100}]
    orgs = [(3, {"name": "c", "z": [1]}), (8, {"name": "h"}), (30, {})]
    lines = spark.createDataFrame([("f", i, 9, json.dumps({"id": i, "serialized_data": b | {"forager_id": i}})) for i, b in enumerate(people, 1)], "file string, line long, bytes long, text string")
    bodies = spark.createDataFrame([(i, json.dumps(b)) for i, b in orgs], "id long, body string")
    whole = {r.id: r for r in enrich_documents(feeds.envelopes(lines, "person"), bodies).withColumn("doc", F.to_json("doc")).collect()}
    for n in (1, 5):
        got = {r.id: r for r in enrich_parts(feeds.envelopes(lines, "person", parts=True).repartition(n), bodies.repartition(n)).collect()}
        assert {i: (json.loads(r.doc), r[2:]) for i, r in got.items()} == {i: (json.loads(r.doc), r[2:]) for i, r in whole.items()} and len(got) == 5
    bad = spark.createDataFrame([("f", 1, 9, "{"), ("f", 2, 9, '{"id":2,"serialized_data":{"a":"\\ud800","n":1e999}}')], lines.schema)
    rows = feeds.envelopes(bad, "person", parts=True).orderBy("line").collect()
    assert [(r.id, r.rest, r.roles) for r in rows] == [(None, None, []), (2, '"a":"\\ud800","n":1e999', [])] and rows[0].reason


def test_typed_enrichment_equals_documents(spark):
    people = [(1, [(8,), (3,), (8,), (999,), (999,), (None,)]), (2, []), (3, None), (4, [(5,)] * 4100)]
    p = spark.createDataFrame(people, "id long, roles array<struct<organization_id:long>>")
    o = spark.createDataFrame([(8, "h"), (3, "c"), (5, "f")], "forager_id long, name string")
    for parts in (1, 7):
        rows = {r.id: r for r in enrich(p.repartition(parts), o.repartition(parts)).collect()}
        assert [x.name for x in rows[1].organizations] == ["h", "c"] and rows[1].unresolved_organization_ids == [999]
        assert [r.organization_unresolved for r in rows[1].roles] == [False, False, False, True, True, False]
        assert rows[3].roles == [] and rows[3].organizations == [] and not rows[3].has_unresolved_organizations
        assert rows[4].n_resolved == 4100 and len(rows[4].organizations) == 1
    t = totals(enrich(p, o)).head()
    assert (t.persons, t.roles, t.resolved_org_refs, t.unresolved_org_refs, t.persons_with_unresolved_orgs) == (4, 4106, 4103, 2, 1)
    assert totals(enrich(p.limit(0), o)).head().unresolved_percent == 0


def test_table_sink_reconciles_counts(spark, tmp_path):
    good = spark.createDataFrame([(1, "a"), (2, "b")], "id long, doc string")
    assert sink.write_table(good, str(tmp_path / "t")) == {"acknowledged": 2, "indexed": 2}
    with pytest.raises(PySparkException):
        sink.write_table(good, str(tmp_path / "t"))
    with pytest.raises(sink.SinkError, match="sink=1, acknowledged=2"):
        sink.write_table(spark.createDataFrame([(1, "first"), (1, "second")], "id long, doc string"), str(tmp_path / "t"), reset=True)


def reply(*statuses, errors=None):
    items = [{"index": {"status": s, **({"error": {"type": "boom"}} if s >= 300 else {})}} for s in statuses]
    return 200, json.dumps({"errors": any(s >= 300 for s in statuses) if errors is None else errors, "items": items}).encode()


def test_only_refused_documents_are_sent_again():
    sent = []
    answers = iter([reply(504, 200, 502), OSError("lost"), reply(200, 201)])

    def request(url, payload):
        sent.append(payload)
        a = next(answers)
        if isinstance(a, Exception):
            raise a
        return a

    docs = [(str(i), b"{}") for i in (1, 2, 3)]
    assert sink.send_bulk("http://x", "persons", docs, request=request, sleep=lambda s: None)["indexed"] == 3
    assert [p.count(b"_id") for p in sent] == [3, 2, 2] and sent[1] == sent[2] and b'"_id": "2"' not in sent[1]


@pytest.mark.parametrize("answer", [reply(201), (200, b"no json"), reply(201, 201, errors=True), reply(200, 404)])
def test_bad_replies_are_errors(answer):
    with pytest.raises(sink.SinkError):
        sink.send_bulk("http://x", "persons", [("1", b'{"secret":1}'), ("2", b"{}")], request=lambda u, p: answer, sleep=lambda s: None)


def test_bulk_data_source(spark):
    held = {}

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            lines = self.rfile.read(int(self.headers["Content-Length"])).decode().splitlines()
            ids = [json.loads(x)["index"]["_id"] for x in lines[::2]]
            held.update(zip(ids, lines[1::2]))
            body = reply(*[201] * len(ids))[1]
            self.send_response(200)
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *a):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        spark.dataSource.register(sink.BulkIndex)
        df = spark.range(250).select(F.col("id").cast("string").alias("id"), F.lit('{"a":1}').alias("doc"))
        df.write.format("bulk_index").option("url", f"http://127.0.0.1:{server.server_port}").option("index", "persons").option("mostdocs", "40").mode("append").save()
    finally:
        server.shutdown()
    assert len(held) == 250 and held["7"] == '{"a":1}'


def test_batches_and_metrics(tmp_path):
    assert [len(b) for b in sink.batches(((i, "x" * 10) for i in range(7)), 30, 100)] == [3, 3, 1]
    assert [len(b) for b in sink.batches(((i, "x") for i in range(7)), 10**6, 2)] == [2, 2, 2, 1]
    sink.write_metrics(str(tmp_path / "m.json"), {"b": 1})
    assert json.loads((tmp_path / "m.json").read_text()) == {"b": 1}


def test_stream_ingest(spark, tmp_path):
    src = tmp_path / "person"
    src.mkdir()
    write(src / "a.json.gz", envelope(1, roles=[{"organization_id": 8}]), "broken")
    orgs = spark.createDataFrame([(8, '{"name":"h"}')], "id long, body string")
    for _ in range(2):  # the second run finds nothing new
        q = start_ingest(spark, str(src), orgs, str(tmp_path / "out"), str(tmp_path / "cp"), once=True)
        q.awaitTermination(120)
    docs = spark.read.parquet(str(tmp_path / "out/documents")).collect()
    assert len(docs) == 1 and json.loads(docs[0].doc)["organizations"] == [{"name": "h"}]
    assert spark.read.parquet(str(tmp_path / "out/rejects")).count() == 1


def test_differing_documents(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (3, "z"), (4, "q")], "id long, doc string")
    b = spark.createDataFrame([(1, "x"), (2, None), (3, "y"), (5, "q")], "id long, doc string")
    assert {(r.id, r.kind) for r in checks.differing(a, b, "id", "doc").collect()} == {(3, "differs"), (4, "only left"), (5, "only right")}
