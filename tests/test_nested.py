"""Node tables against a plain recursive walk."""

import json

from weftline.functions.strict_json import strict_loads
from weftline.operators.nested import child_table, node_table, own_fields

SCHEMA = "id long, pos int, roles array<struct<id:long,tags:array<struct<t:string>>>>, skills array<string>, body string"


def brute(rows):
    out = set()

    def read(v):
        while isinstance(v, str):
            try:
                v = json.loads(v)
            except ValueError:
                return None
        return v

    def go(owner, path, v, above):
        v = read(v)
        for i, e in enumerate([v] if isinstance(v, dict) else v if isinstance(v, list) else []):
            e = read(e)
            if isinstance(e, dict):
                out.add((owner, path, above, i))
                for k, x in e.items():
                    go(owner, f"{path}.{k}", x, i)

    for ident, _, roles, _, body in rows:
        go(ident, "roles", [r and {"tags": [t and {} for t in r[1]] if r[1] else None} for r in roles or []], -1)
        b = read(body)
        if isinstance(b, dict):
            for k, v in b.items():
                go(ident, k, v, -1)
    return out


ROWS = [
    (1, 0, [(1, [("a",), None, ("b",)]), None, (2, []), (3, None)], ["x"], '{"p":[{"q":[{"r":1},5,null,{"r":{"s":[{}]}}]},"see",{"q":{"z":1}}],"o":{"k":"v"},"n":"{\\"a\\":[{}]}"}'),
    (1, 0, [(1, [("a",), None, ("b",)]), None, (2, []), (3, None)], ["x"], None),
    (2, 0, None, None, json.dumps(json.dumps({"deep": [{"x": [{"y": [{}]}]}]}))),
    (3, 0, [], [], '{"broken": [{'),
    (4, 0, None, None, "[{}]"),
    (5, 0, None, None, '{"a":[[{"no":1}],{"yes":1}],"b":"[{\\"in\\":1}]","c":NaN}'),
    (6, 0, None, None, '{"a":[[{"no":1}],{"yes":1}],"b":"[{\\"in\\":1}]","c":["{\\"s\\":[{}]}"]}'),
    (None, 0, [(9, None)], None, ""),
]


def test_nodes_match_a_plain_walk(spark):
    want = brute([r for r in ROWS if r[0] != 5])
    for payload in (True, False):
        nodes = node_table(spark.createDataFrame(ROWS, SCHEMA), "id", ("body",), payload=payload)
        rows = [(r.id, r.child, r.parent_pos, r.pos) for r in nodes.collect()]
        assert {r for r in rows if r[1]} == want
        assert [r[0] for r in rows if not r[1]].count(1) == (2 if payload else 0)


def test_intervals_lead_to_the_parent(spark):
    df = spark.createDataFrame(ROWS[:1], SCHEMA)
    nodes = [r.asDict() for r in node_table(df, "id", ("body",)).collect()]
    for n in nodes:
        around = [m for m in nodes if m["pre"] < n["pre"] and m["post"] > n["post"]]
        assert len(around) == n["level"]
        if n["level"] > 1:
            parent = max(around, key=lambda m: m["pre"])
            assert (parent["child"], parent["pos"]) == (n["parent"], n["parent_pos"])
        else:
            assert n["parent"] is None and n["parent_pos"] == -1


def test_labels_do_not_depend_on_partitions(spark):
    df = spark.createDataFrame(ROWS * 3, SCHEMA)
    one, many = ({tuple(r) for r in node_table(df.repartition(n), "id", ("body",)).collect()} for n in (1, 7))
    assert one == many
    first = {r[:2] for r in one if r[0] == 1}
    assert len(first) == 2  # two deliveries of one id
    for ident, delivery in first:
        labels = sorted((r[6], r[7]) for r in one if r[:2] == (ident, delivery))
        assert [a for a, _ in labels] == list(range(len(labels))) and sorted(b for _, b in labels) == list(range(len(labels)))


def test_own_fields():
    element = {"a": 1, "tags": ["x", None], "mixed": [{"b": 1}, "y"], "objects": [{}], "none": [], "o": {}, "t": '[{"c":1}]', "s": '"q"', "bad": "\ud800", "big": strict_loads("1e999")}
    assert own_fields(element) == '{"a":1,"tags":["x",null],"mixed":[null,"y"],"none":[],"s":"\\"q\\"","bad":"\\ud800","big":1e999}'


def test_odd_keys(spark):
    rows = [(1, 0, None, None, '{"\\ud800":[{"x":"\\ud800"}]}')]
    assert [r.child for r in node_table(spark.createDataFrame(rows, SCHEMA), "id", ("body",)).collect() if r.child] == ["\\ud800"]


def test_child_table_and_empty(spark):
    df = spark.createDataFrame(ROWS[:1], SCHEMA)
    tags = child_table(node_table(df, "id", ("body",)), "roles.tags", "t string").collect()
    assert sorted((r.parent_pos, r.pos, r.t) for r in tags) == [(0, 0, "a"), (0, 2, "b")]
    assert node_table(spark.createDataFrame([], SCHEMA), "id", ("body",)).count() == 0


def test_very_deep_records(spark):
    n = 3000
    body = '{"a":' + '[{"a":' * n + "1" + "}]" * n + "}"
    nodes = node_table(spark.createDataFrame([(1, 0, None, None, body)], SCHEMA), "id", ("body",), payload=False)
    r = nodes.selectExpr("count(*) n", "max(level) l", "max(length(child)) c").head()
    assert (r.n, r.l, r.c) == (n, n, 2 * n - 1)
