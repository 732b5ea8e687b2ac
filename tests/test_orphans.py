"""Orphan references against a plain loop, and the bitmaps."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from weftline.operators.orphans import compress, decode, dictionary, expand, orphans


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 65535)), st.booleans())
def test_bitmaps_keep_their_numbers(numbers, many):
    held = sorted(numbers | (set(range(0, 60000, 7)) if many else set()))
    assert decode(expand(compress(np.array(held, np.int64)))).tolist() == held


def brute(refs, parents, removals):
    latest = {}
    for s, r, _, at in refs:
        if at is not None:
            latest[s, r] = max(at, latest.get((s, r), at))
    out = set()
    for s, r, k, _ in refs:
        if k is None:
            continue
        at = latest.get((s, r))
        seen = [a for q, a in parents if q == k]
        known = [a for a in seen if a is not None]
        gone = [t for q, t in removals if q == k]
        bad = not seen or (gone and not any(a > max(gone) for a in known)) or (known and (at is None or min(known) > at)) or (not known and at is None)
        if bad:
            out.add((s, r, k, at.strftime("%Y-%m") if at else None))
    return out


@pytest.mark.parametrize("kind,cast", [("long", lambda k: k), ("string", lambda k: None if k is None else f"key {k}")])
def test_orphans_match_a_plain_loop(spark, kind, cast):
    rng = random.Random(4)
    day = lambda: datetime(2024, 1, 1) + timedelta(days=rng.randrange(400), hours=rng.randrange(24))
    keys = [-70000, -1, 0, 5, 65535, 65536, 2**40, 7, 8, 9]
    refs = [(rng.choice("ab"), rng.randrange(60), rng.choice([*keys, None]), rng.choice([day(), day(), day(), None])) for _ in range(400)]
    refs += [("a", 1000 + i, 5, day()) for i in range(400)]
    parents = [(rng.choice(keys[:8]), rng.choice([day(), day(), None])) for _ in range(18)] + [(None, day())]
    removals = [(rng.choice(keys), day()) for _ in range(4)]
    refs, parents, removals = [(*r[:2], cast(r[2]), r[3]) for r in refs], [(cast(k), at) for k, at in parents], [(cast(k), at) for k, at in removals]
    got = orphans(
        spark.createDataFrame(refs, f"source_table string, row_id long, key {kind}, at timestamp"), spark.createDataFrame(parents, f"key {kind}, at timestamp"), spark.createDataFrame(removals, f"key {kind}, removed_at timestamp")
    ).collect()
    assert len(got) == len({tuple(r) for r in got})
    assert {(r.source_table, r.row_id, r.key, r.period) for r in got} == brute(refs, parents, removals)


def test_codes_are_dense(spark):
    keys = [i * 10**12 for i in range(500)]
    a, b = (spark.createDataFrame([(k,) for k in part] + [(None,)], "k long") for part in (keys[:300], keys[200:]))
    rows = dictionary(a, b).collect()
    assert sorted(r.key for r in rows) == keys and len({r.code for r in rows}) == 500
    assert len({r.code >> 16 for r in rows}) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert [r.key for r in sorted(rows, key=lambda r: r.code)] == keys


def test_empty_tables(spark):
    r = spark.createDataFrame([("a", 1, 5, datetime(2024, 1, 1))], "source_table string, row_id long, key long, at timestamp")
    p = spark.createDataFrame([], "key long, at timestamp")
    m = spark.createDataFrame([], "key long, removed_at timestamp")
    assert [tuple(x) for x in orphans(r, p, m).collect()] == [("a", 1, 5, "2024-01")]
    assert orphans(r.limit(0), p, m).count() == 0
