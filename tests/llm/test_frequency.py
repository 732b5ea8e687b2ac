"""Term frequencies against plain counting."""

import random
from collections import Counter

import pyarrow as pa
import pytest

from weftline.llm.frequency import scan_sorted, term_frequencies


def plain(rows):
    n, ids = Counter(), {}
    for f, t, r in rows:
        n[f, t] += 1
        ids.setdefault((f, t), set()).update([r] if r is not None else [])
    return {k: (c, len(ids[k])) for k, c in n.items()}


@pytest.mark.parametrize("step", [1, 2, 3, 1000])
def test_runs_go_on_over_batches(step):
    rng = random.Random(step)
    rows = sorted(((rng.choice("fg"), rng.choice(["a", "b", "ü"]), rng.choice([1, 2, 3, None])) for _ in range(200)), key=lambda r: (r[0], r[1], r[2] is not None, r[2] or 0))
    schema = pa.schema([("field_name", pa.string()), ("term", pa.string()), ("record", pa.int64())])
    batches = [pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[i : i + step]), schema.types)], schema=schema) for i in range(0, len(rows), step)]
    out = [tuple(r.values()) for b in scan_sorted(iter(batches)) for r in b.to_pylist()]
    assert {(f, t): (n, k) for f, t, n, k in out} == plain(rows) and len(out) == len(plain(rows))


def test_marks_and_edges(spark):
    people = [(i, [" Hot ", "hot", None, "", "  "], "Rare One" if i < 2 else "mid" if i < 5 else None) for i in range(50)] + [(0, ["HOT"], "rare  one"), (None, ["hot"], None), (51, None, " "), (52, [], "")]
    p = spark.createDataFrame(people, "id long, skills array<string>, industry string")
    got = {(r.field_name, r.term): (r.occurrences, r.records, r.mark) for r in term_frequencies([(p, "id", {"s": "skills", "i": "industry"})]).collect()}
    assert got == {("s", "hot"): (102, 50, "common"), ("i", "rare one"): (3, 2, "rare"), ("i", "mid"): (3, 3, None)}
    assert term_frequencies([(p.limit(0), "id", {"s": "skills"})]).count() == 0
