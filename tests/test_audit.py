"""Audit operators against plain Python."""

import json
from collections import defaultdict

import weftline.plans.entities  # noqa: F401
from weftline.operators import audit, checks
from weftline.plans.registry import QUERIES

RECORDS = "id long, ok boolean, share double, skills array<string>, roles array<struct<title:string,tags:array<struct<t:string>>>>, facts map<string,bigint>, body string"
ROWS = [
    (1, True, 0.5, ["a", None, "b", None], [("x", [("p",), None]), None, None], {"m": 1}, '{"certs":[{"name":"n","by":null},5,"s",null,[1,[]],null],"o":{"k":1.5,"l":{"deep":[{"z":[]}]}},"e":[],"t":true}'),
    (1, True, 0.5, ["a", None, "b", None], [("x", [("p",), None]), None, None], {"m": 1}, None),
    (2, None, None, [], [], None, json.dumps(json.dumps({"certs": {"name": "{see"}, "odd": "[1, 2"}))),
    (None, False, 1.0, None, None, {}, '{"broken": [{'),
    (3, None, None, [None], [(None, None), ("y", [])], {"m": None, "w": 2}, '[{"certs":1},2]'),
    (4, None, None, None, None, None, '{"certs":["{\\"inside\\":1}"],"\\ud800":NaN}'),
    (5, None, None, None, None, None, '{"\\ud800":12345678901234567890123}'),
    (6, None, None, None, None, None, ""),
    (7, None, None, None, None, None, "null"),
]


def brute(rows):
    n, longest = defaultdict(int), {}

    def go(path, v):
        kind = {"dict": "object", "list": "array", "str": "string", "bool": "boolean", "int": "integer", "float": "number", "NoneType": "null"}[type(v).__name__]
        n[path, kind] += 1
        for k, x in v.items() if kind == "object" else ():
            go(f"{path}.{k}", x)
        if kind == "array":
            longest[path] = max(longest.get(path, 0), len(v))
            for x in v:
                go(f"{path}[]", x)

    def refuse(name):
        raise ValueError(name)

    for ident, ok, share, skills, roles, facts, body in rows:
        typed = roles and [r and {"title": r[0], "tags": r[1] and [t and {"t": t[0]} for t in r[1]]} for r in roles]
        for path, v in (("id", ident), ("ok", ok), ("share", share), ("skills", skills), ("roles", typed), ("facts", facts)):
            go(path, v)
        try:
            v = None if body is None else json.loads(body, parse_constant=refuse)
            go("body", json.loads(v) if isinstance(v, str) else v)
        except ValueError:
            n["body", "malformed"] += 1
    return {(p.replace("\ud800", "\\ud800"), k, c, longest.get(p) if k == "array" else None) for (p, k), c in n.items()}


def test_path_profile_matches_brute_force(spark):
    for parts in (1, 3):
        got = [tuple(r) for r in audit.path_profile(spark.createDataFrame(ROWS, RECORDS).repartition(parts), ("body",)).collect()]
        assert len(got) == len(set(got)) and set(got) == brute(ROWS)
    assert {("skills", "array", 4, 4), ("skills[]", "null", 5, None), ("roles", "array", 4, 3), ("body.certs", "array", 1, 6), ("body.certs", "object", 1, None)} <= set(got)
    assert audit.path_profile(spark.createDataFrame([], RECORDS), ("body",)).count() == 0


def test_path_profile_flushes_many_and_deep_paths(spark, monkeypatch):
    monkeypatch.setattr(audit, "PROFILE_CHARS", 100)
    n = 2000
    rows = [(json.dumps({f"k{i}": [i], "same": None}),) for i in range(50)] + [('{"a":' + '[{"a":' * n + "1" + "}]" * n + "}",)]
    got = {(r.path, r.kind): (r.n, r.longest) for r in audit.path_profile(spark.createDataFrame(rows, "body string"), ("body",)).collect()}
    assert got["body", "object"] == (51, None) and got["body.same", "null"] == (50, None) and got["body.k7", "array"] == (1, 1)
    assert got["body.a" + "[].a" * n, "integer"] == (1, None) and len(got) == 2 + 100 + 2 * n + 1


def test_path_profile_of_the_whole_table(spark, small):
    rows = spark.read.parquet(f"{small}/persons.parquet").collect()
    got = {(r.path, r.kind): (r.n, r.longest) for r in QUERIES["schema_paths"](spark, small).collect()}
    assert got["roles", "array"] == (sum(r.roles is not None for r in rows), max(len(r.roles) for r in rows if r.roles is not None))
    assert got["skills[]", "string"][0] == sum(s is not None for r in rows for s in r.skills or [])
    assert any(p.startswith("serialized_data.patents[].linkedin_inventors[].") for p, _ in got)
    assert sum(n for (p, _), (n, _) in got.items() if p == "serialized_data") == len(rows)


def test_every_date_shape(spark):
    shapes = {
        "2020-01-02 03:04:05.678 Z": "datetime Z", "2020-01-02 03:04:05.6 +0100": "datetime offset", "2020-01-02 03:04:05": "datetime without fraction", "2020-01-02T03:04:05Z": "iso datetime", "2020-01-02": "date",
        "2020-01": "year and month", "2020": "year", "": "empty", None: "null", "2020-1": "other", "20201": "other", "2020-01-": "other", "in 2020": "other", "2020\n": "other",
    }
    df = spark.createDataFrame([(v,) for v in shapes], "v string")
    assert {r.v: r.s for r in df.select("v", audit.date_shape(df.v).alias("s")).collect()} == shapes


def test_keyword_agg_keeps_values_of_one_document(spark, small):
    assert any(r.docs == 1 for r in QUERIES["keyword_agg"](spark, small).collect())


def test_canonical_ids_are_digits_alone(spark):
    ids = {"5": 5, "007": 7, "-5": None, "+5": None, "5.0": None, "": None, None: None, "x5": None, "5\n": None, "٥": None, "9223372036854775808": None, "9223372036854775807": 2**63 - 1}
    df = spark.createDataFrame([(v,) for v in ids], "v string")
    assert {r.v: r.i for r in df.select("v", audit.canonical_id(df.v).alias("i")).collect()} == ids


def test_text_that_is_no_utf8_is_malformed(spark):
    df = spark.sql("select cast(unhex('7BFF7D') as string) body")
    assert [tuple(r) for r in audit.path_profile(df, ("body",)).collect()] == [("body", "malformed", 1, None)]


def test_digest_tells_values_and_neighbours_apart(spark):
    of = lambda *rows: checks.digest(spark.createDataFrame(rows, "a string, b string"), "a", "b").head().digest
    assert of(("x", "y"), ("p", None)) == of(("p", None), ("x", "y"))
    assert len({of(("x", "y")), of(("xy", "")), of(("", "xy")), of((None, "xy")), of(("x", "y"), ("x", "y")), of(("1:x", "y"))}) == 6
