"""Queries that SQL can't state, against plain loops over the whole tables of the smallest scale."""

import json

import pytest

from weftline.plans import corpus, entities


def no_constant(name):
    raise ValueError(name)


def parsed(text):
    """The value of a JSON text, None if it is none; texts that hold JSON count as it."""
    while isinstance(text, str):
        try:
            text = json.loads(text, parse_constant=no_constant)
        except ValueError:
            return None
    return text


def objects(owner, path, value, above, out):
    value = parsed(value)
    for i, element in enumerate([value] if isinstance(value, dict) else value if isinstance(value, list) else []):
        element = parsed(element)
        if isinstance(element, dict):
            out.append((owner, path, above, i, element))
            for k, v in element.items():
                objects(owner, f"{path}.{k}", v, i, out)


@pytest.fixture(scope="module")
def nodes(spark, small):
    out = []
    for p in spark.read.parquet(f"{small}/persons.parquet").collect():
        for name in ("roles", "organizations"):
            objects(p.id, name, [x and x.asDict(recursive=True) for x in p[name] or []], -1, out)
        body = parsed(p.serialized_data)
        for k, v in body.items() if isinstance(body, dict) else ():
            objects(p.id, k, v, -1, out)
    return out


def test_nodes(spark, small, nodes):
    got = [tuple(r) for r in corpus.p3_found(spark, small).select("person_id", "child", "parent_pos", "pos").collect()]
    assert len(got) == len(set(got)) > 1000
    assert set(got) == {n[:4] for n in nodes}


@pytest.mark.parametrize("name", sorted(corpus.CHILD_TABLES))
def test_child_tables(spark, small, nodes, name):
    path, fields = corpus.CHILD_TABLES[name]
    columns = [f.split()[0] for f in fields.split(", ")]
    got = {tuple(r) for r in corpus.QUERIES[name](spark, small).select("holder_id", "parent_pos", "pos", *columns).collect()}
    assert got == {(owner, above, pos, *(e.get(c) if not isinstance(e.get(c), (dict, list)) else None for c in columns)) for owner, p, above, pos, e in nodes if p == path} and got


def csv_columns(line):
    """The columns of a CSV line, None if its quoting is broken."""
    out, at = [], 0
    while True:
        if line[at : at + 1] == '"':
            value, at = "", at + 1
            while True:
                end = line.find('"', at)
                if end < 0:
                    return None
                value, at = value + line[at:end], end + 1
                if line[at : at + 1] != '"':
                    break
                value, at = value + '"', at + 1
        else:
            end = line.find(",", at)
            value, at = (line[at:], len(line)) if end < 0 else (line[at:end], end)
            if '"' in value:
                return None
        out.append(value)
        if at == len(line):
            return out
        if line[at] != ",":
            return None
        at += 1


def loads(text):
    return json.loads(text, parse_constant=no_constant)


def loadable(file, line):
    try:
        if file.endswith(".csv"):
            columns = csv_columns(line.rstrip("\r\n")) or []
            if len(columns) != 3 or not (columns[0].isascii() and columns[0].isdigit()):
                return False
            ident, body = int(columns[0]), loads(columns[2])
        else:
            envelope = loads(line)
            ident, body = envelope["id"], envelope["serialized_data"]
        right = type(ident) is int and 0 <= ident < 2**63 and isinstance(body, dict)
        return right and ("forager_id" not in body or type(body["forager_id"]) is int and body["forager_id"] == ident)
    except (ValueError, KeyError, TypeError):
        return False


def test_rejects(spark, small):
    rows = spark.read.parquet(f"{small}/feed_lines.parquet").collect()
    bad = {(r.feed_file, r.line_no) for r in rows if not loadable(r.feed_file, r.raw_line or "")}
    assert {tuple(r) for r in corpus.p7_found(spark, small).select("feed_file", "line_no").collect()} == bad and bad
    loaded = corpus.p7_loaded(spark, small).collect()
    assert {(r.feed_file, r.line_no) for r in loaded} == {(r.feed_file, r.line_no) for r in rows} - bad
    text = {(r.feed_file, r.line_no): r.raw_line for r in rows}
    assert all(r.body in text[r.feed_file, r.line_no] for r in loaded if not r.feed_file.endswith(".csv"))
    assert sum(r.lines for r in corpus.p7_reasons(spark, small).collect()) == len(bad)


def test_envelopes(spark, small):
    """A line stops a load of persons exactly if it fails alone or has a malformed reference."""
    got = {(r.file, r.line): r.reason for r in entities.validate_envelopes(spark, small).collect()}
    lines = [r for r in spark.read.parquet(f"{small}/feed_lines.parquet").collect() if r.feed_file.endswith(".ndjson")]

    def good(r):
        if not loadable(r.feed_file, r.raw_line or ""):
            return False
        roles = loads(r.raw_line)["serialized_data"].get("roles", [])
        refs = [x.get("organization_id") if isinstance(x, dict) else "" for x in roles] if isinstance(roles, list) else [""]
        return all(x is None or type(x) is int and 0 <= x < 2**63 for x in refs)

    assert {k for k, reason in got.items() if reason is None} == {(r.feed_file, r.line_no) for r in lines if good(r)} and len(got) == len(lines)
