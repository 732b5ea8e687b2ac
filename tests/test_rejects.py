"""Strict JSON, envelope lines and CSV lines."""

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from weftline.functions.strict_json import _deep, compact_json, is_id, object_members, strict_loads
from weftline.operators.rejects import load_csv_lines, load_json_line, load_lines

BODY = '{"forager_id":5}'


@pytest.mark.parametrize(
    "line,ok",
    [
        ('{"id":5,"serialized_data":{"forager_id":5}}', True),
        ('  {"id":5,"serialized_data":{}} \r', True),
        ('{"id":5,"id":6,"serialized_data":{"forager_id":6}}', True),
        ('{"id":9223372036854775807,"serialized_data":{}}', True),
        ('{"id":0,"serialized_data":{"x":1e400,"y":"\\ud800"}}', True),
        ('{"id":5,"serialized_data":{"deep":' + "[" * 3000 + "]" * 3000 + "}}", True),
        ('{"id":9223372036854775808,"serialized_data":{}}', False),
        ('{"id":-1,"serialized_data":{}}', False),
        ('{"id":5.0,"serialized_data":{}}', False),
        ('{"id":1e2,"serialized_data":{}}', False),
        ('{"id":true,"serialized_data":{}}', False),
        ('{"id":"5","serialized_data":{}}', False),
        ('{"serialized_data":{}}', False),
        ('{"id":5}', False),
        ('{"id":5,"serialized_data":[]}', False),
        ('{"id":5,"serialized_data":"{}"}', False),
        ('{"id":5,"serialized_data":{"forager_id":null}}', False),
        ('{"id":5,"serialized_data":{"forager_id":5.0}}', False),
        ('{"id":1,"serialized_data":{"forager_id":true}}', False),
        ('{"id":5,"serialized_data":{}} x', False),
        ('{"id":5,"serialized_data":{},}', False),
        ('{"id":5,"serialized_data":{"a":NaN}}', False),
        ("{'id':5,'serialized_data':{}}", False),
        ('{"id":05,"serialized_data":{}}', False),
        ('{"id":5,"serialized_data":{"a":"b\tc"}}', False),
        ('﻿{"id":5,"serialized_data":{}}', False),
        ('[{"id":5,"serialized_data":{}}]', False),
        ("null", False),
    ],
)
def test_json_lines(line, ok):
    assert (load_json_line(line)[-1] is None) == ok


def csv(*lines):
    return {at: (reason, ident) for at, ident, _, _, _, reason in load_csv_lines(list(enumerate(lines)))}


def test_csv_lines():
    q = '"' + BODY.replace('"', '""') + '"'
    good = [f"5,d,{q}", f'"5","d",{q}', "5,,{}", f"005,d,{q}", f"5,d,{q}\r", f'5,"a\nb",{q}', '5,"a ""b"" , c",{}']
    bad = [f"5,d,{q},", f"5,{q}", f"-5,d,{q}", f"5.0,d,{q}", f" 5,d,{q}", f",d,{q}", "9223372036854775808,d,{}", f"6,d,{q}", f"5,d,{q} ", f'5,d,x"y", {q}', '5,"d,{}', f"5,d,{BODY}", "5,d,[]", "5,d,{]", "٥,d,{}"]
    out = csv(*good, *bad)
    assert all(out[i] == (None, 5) for i in range(len(good))), out
    assert all(out[i][0] for i in range(len(good), len(good) + len(bad))), out
    assert len(out) == len(good) + len(bad)


@settings(max_examples=300, deadline=None)
@given(st.recursive(st.none() | st.booleans() | st.integers() | st.floats(allow_nan=False, allow_infinity=False) | st.text(), lambda c: st.lists(c) | st.dictionaries(st.text(), c), max_leaves=12), st.text(alphabet='[]{},:"1e.-ntu\\ ', max_size=3), st.integers(0, 40))
def test_parsers_agree(value, noise, at):
    text = json.dumps(value)
    text = text[:at] + noise + text[at:]
    try:
        a = strict_loads(text)
    except ValueError:
        a = ValueError
    try:
        b = _deep(text)
    except ValueError:
        b = ValueError
    assert repr(a) == repr(b)


def test_deep_bodies_are_kept_whole():
    deep = '{"id":5,"serialized_data":{"a":' + '[{"k\\"":' * 2000 + "1" + "},null]" * 2000 + ',"b":"x"}}'
    body = load_json_line(deep)[2]
    assert _deep(body)["b"] == "x" and body == '{"a":' + '[{"k\\"":' * 2000 + "1" + "},null]" * 2000 + ',"b":"x"}'
    assert compact_json({"a": [1, {}], "é": None}) == '{"a":[1,{}],"é":null}'


ANY_JSON = st.recursive(st.none() | st.booleans() | st.integers() | st.floats(allow_nan=False, allow_infinity=False) | st.text(st.characters(blacklist_categories=())), lambda c: st.lists(c) | st.dictionaries(st.text(st.characters(blacklist_categories=())), c), max_leaves=10)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.text(), ANY_JSON, max_size=4), st.booleans(), st.sampled_from(["", " ", "\t\n"]))
def test_members_are_kept_as_delivered(value, ascii_only, space):
    text = space + json.dumps(value, ensure_ascii=ascii_only, separators=("," + space, ":" + space)) + space
    got = object_members(text)
    assert {k: v for k, (v, _) in got.items()} == value
    assert all(w in text and strict_loads(w) == value[k] for k, (_, w) in got.items())
    assert strict_loads(compact_json(value)) == value
    compact_json(value).encode()


@settings(max_examples=300, deadline=None)
@given(st.dictionaries(st.text(max_size=2), st.integers() | st.text(max_size=2) | st.lists(st.none(), max_size=2), max_size=3), st.text(alphabet='[]{},:"1e.-ntu\\ ', max_size=3), st.integers(0, 20))
def test_members_are_as_strict_as_the_parser(value, noise, at):
    text = json.dumps(value)
    text = text[:at] + noise + text[at:]

    def tried(f):
        try:
            return f(text)
        except ValueError:
            return ValueError

    whole, got = tried(strict_loads), tried(object_members)
    assert got == (whole if whole is ValueError else None if not isinstance(whole, dict) else got)
    assert not isinstance(whole, dict) or {k: v for k, (v, _) in got.items()} == whole


def test_valid_json_never_ends_a_load(spark):
    """Halves of surrogate pairs, huge numbers and deep nesting load beside other lines, and bodies stay as delivered."""
    bodies = ['{"a": "\\ud800", "\\udfff":1}', '{"n": 1e999, "m":-1E+400}', '{"d":' + "[" * 5000 + "]" * 5000 + "}", '{"x" : 1}', '{"i":' + "9" * 5000 + "}"]
    lines = [(f"a.{kind}", i, text) for i, b in enumerate(bodies) for kind, text in (("ndjson", '{"id":1,"date_updated":"\\udc00","serialized_data":%s}' % b), ("csv", '1,"d","%s"' % b.replace('"', '""')))]
    out = load_lines(spark.createDataFrame(lines, "feed_file string, line_no long, raw_line string")).collect()
    assert {(r.feed_file, r.line_no): r.body for r in out} == {(f, n): bodies[n] for f, n, _ in lines} and not any(r.reason for r in out)


def test_lines_that_are_no_utf8_are_set_apart(spark):
    df = spark.sql("select * from values ('a.ndjson', 1L, cast(unhex('7BFF7D') as string)), ('a.csv', 2L, cast(unhex('352CFF2C7B7D') as string)), ('a.csv', 3L, '5,,{}') as t(feed_file, line_no, raw_line)")
    assert {r.line_no: r.reason for r in load_lines(df).collect()} == {1: "not UTF-8", 2: "not UTF-8", 3: None}


def test_ids():
    assert is_id(0) and is_id(2**63 - 1) and not is_id(2**63) and not is_id(True) and not is_id(1.0) and not is_id("1")


def test_load_lines_edges(spark):
    schema = "feed_file string, line_no long, raw_line string, reason string, id string"
    rows = [("a.ndjson", 1, '{"id":5,"serialized_data":{}}', "x", "y"), ("a.ndjson", 1, '{"id":5,"serialized_data":{}}', "x", "y"), ("a.ndjson", 2, None, None, None), ("a.csv", 1, "", None, None), ("a.csv", 2, "7,d,{}", None, None), (None, None, "{", None, None)]
    out = load_lines(spark.createDataFrame(rows, schema)).collect()
    assert len(out) == 6 and sum(r.reason is None for r in out) == 3
    assert {(r.feed_file, r.line_no) for r in out if r.reason} == {("a.ndjson", 2), ("a.csv", 1), (None, None)}
    assert load_lines(spark.createDataFrame([], schema)).count() == 0
