"""Strict JSON: what the standard's grammar allows and nothing else."""

from __future__ import annotations

import json
import math
import re
import sys

import pyarrow as pa

MAX_ID = 2**63 - 1
TOKEN = re.compile(r'[ \t\n\r]*(?:([{}\[\]:,])|("(?:[^"\\\x00-\x1f]|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*+")|(-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?)|(true|false|null))')
NAMES = {"true": True, "false": False, "null": None}


def _refuse(name: str):
    raise ValueError(f"{name} is not JSON")


def _deep(text: str):
    """Parses without recursion, for texts nested too deeply for the usual parser."""
    root: list = []
    stack: list = [root]
    key, state, at = None, "value", 0

    def put(x):
        top = stack[-1]
        if isinstance(top, dict):
            top[key] = x
        else:
            top.append(x)

    keys: list = []
    while True:
        if state == "done" and not text[at:].strip(" \t\n\r"):
            return root[0]
        m = TOKEN.match(text, at)
        if not m or state == "done":
            raise ValueError("malformed JSON")
        at = m.end()
        mark, string, number, name = m.groups()
        if state in ("value", "first value"):
            if mark in ("{", "["):
                new = {} if mark == "{" else []
                put(new)
                keys.append(key)
                stack.append(new)
                state = "first key" if mark == "{" else "first value"
                continue
            if mark == "]" and state == "first value":
                stack.pop()
                key = keys.pop()
            elif mark:
                raise ValueError("malformed JSON")
            else:
                put(json.loads(string) if string else (NAMES[name] if name else _decoder.decode(number)))
        elif state in ("key", "first key"):
            if mark == "}" and state == "first key":
                stack.pop()
                key = keys.pop()
            elif string:
                key, m = json.loads(string), TOKEN.match(text, at)
                if not m or m[1] != ":":
                    raise ValueError("malformed JSON")
                at, state = m.end(), "value"
                continue
            else:
                raise ValueError("malformed JSON")
        elif mark == ",":
            state = "key" if isinstance(stack[-1], dict) else "value"
            continue
        elif mark == ("}" if isinstance(stack[-1], dict) else "]"):
            stack.pop()
            key = keys.pop()
        else:
            raise ValueError("malformed JSON")
        state = "done" if len(stack) == 1 else "next"


class Written(float):
    """A number too large for a double, with the digits it was written in."""

    text: str


def _number(text: str) -> float:
    value = float(text)
    if math.isfinite(value):
        return value
    value = Written(value)
    value.text = text
    return value


_decoder = json.JSONDecoder(parse_constant=_refuse, parse_float=_number)
_space = re.compile(r"[ \t\n\r]*")


def strict_loads(text: str):
    """The value of a JSON text; ValueError unless the whole text is strict JSON. Of repeated keys the last one counts."""
    if sys.get_int_max_str_digits():
        sys.set_int_max_str_digits(0)  # a long number is JSON all the same
    try:
        return _decoder.decode(text)
    except RecursionError:
        return _deep(text)


def object_members(text: str) -> dict | None:
    """(value, text as it was written) of each member of a JSON object by key; None for JSON of another kind.

    ValueError unless the whole text is strict JSON. Of repeated keys the last one counts.
    """
    at = _space.match(text).end()
    try:
        if text[at : at + 1] != "{":
            strict_loads(text)
            return None
        if sys.get_int_max_str_digits():
            sys.set_int_max_str_digits(0)
        out: dict = {}
        at = _space.match(text, at + 1).end()
        more = text[at : at + 1] != "}"
        while more:
            if text[at : at + 1] != '"':
                raise ValueError("malformed JSON")
            key, at = json.decoder.scanstring(text, at + 1, True)
            at = _space.match(text, at).end()
            if text[at : at + 1] != ":":
                raise ValueError("malformed JSON")
            start = _space.match(text, at + 1).end()
            value, at = _decoder.raw_decode(text, start)
            out[key] = value, text[start:at]
            at = _space.match(text, at).end()
            more = text[at : at + 1] == ","
            if more:
                at = _space.match(text, at + 1).end()
        if text[at : at + 1] != "}" or text[at + 1 :].strip(" \t\n\r"):
            raise ValueError("malformed JSON")
        return out
    except RecursionError:
        value = _deep(text)
        return {k: (v, compact_json(v)) for k, v in value.items()} if isinstance(value, dict) else None


class Mark(str):
    """Text that is already JSON."""


SURROGATE = re.compile("[\ud800-\udfff]")


def storable(text: str) -> str:
    """A text as UTF-8 can hold it: halves of a surrogate pair, which JSON may have, are written as escapes."""
    return SURROGATE.sub(lambda m: f"\\u{ord(m[0]):04x}", text)


def compact_json(value) -> str:
    """A value as JSON without white space, as UTF-8 can hold it, however deeply nested; no number becomes infinite."""
    try:
        return storable(json.dumps(value, ensure_ascii=False, allow_nan=False, separators=(",", ":")))
    except (RecursionError, ValueError):
        out: list[str] = []
        todo: list = [value]
        while todo:
            x = todo.pop()
            if isinstance(x, Mark):
                out.append(x)
            elif isinstance(x, Written):
                out.append(x.text)
            elif isinstance(x, dict):
                parts = [y for i, (k, v) in enumerate(x.items()) for y in (Mark(("," if i else "") + json.dumps(k, ensure_ascii=False) + ":"), v)]
                todo += [Mark("}"), *reversed(parts), Mark("{")]
            elif isinstance(x, list):
                parts = [y for i, v in enumerate(x) for y in (Mark("," if i else ""), v)]
                todo += [Mark("]"), *reversed(parts), Mark("[")]
            else:
                out.append(json.dumps(x, ensure_ascii=False))
        return storable("".join(out))


def texts_of(column: pa.Array) -> list[str | bytes | None]:
    """The texts of a string column; what is no UTF-8 is given as bytes."""
    try:
        return column.to_pylist()
    except UnicodeDecodeError:
        out: list = []
        for raw in column.cast(pa.binary()).to_pylist():
            try:
                out.append(raw if raw is None else raw.decode())
            except UnicodeDecodeError:
                out.append(raw)
        return out


def is_id(value) -> bool:
    """An integer from 0 to 2^63-1; a boolean, a string and a float are none."""
    return type(value) is int and 0 <= value <= MAX_ID
