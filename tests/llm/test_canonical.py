"""Mapping to canonical entries, and the tree against brute force."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from weftline.llm.edits import BKTree, levenshtein, swaps
from weftline.llm.canonical import Matcher, assign, match_values

words = st.text(alphabet="abc", max_size=7)


def slow(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(words, words, words)
def test_distance_is_a_metric(a, b, c):
    assert levenshtein(a, b) == levenshtein(b, a) == slow(a, b) and levenshtein(a, c) <= levenshtein(a, b) + levenshtein(b, c)
    assert swaps(a, b) <= levenshtein(a, b) <= 2 * swaps(a, b)


@settings(max_examples=200, deadline=None)
@given(st.sets(words, max_size=30), words, st.integers(0, 4))
def test_tree_finds_every_entry_within_the_radius(entries, word, radius):
    assert sorted(BKTree(sorted(entries)).within(word, radius)) == sorted((slow(word, e), e) for e in entries if slow(word, e) <= radius)


TITLES = [(1, "Project Manager"), (2, "Product Manager"), (3, "Software Engineer"), (3, "SWE"), (4, "Human Resources Generalist"), (4, "HR allrounder"), (5, "Data Analyst"), (6, "Welder"), (7, "Airline Pilot"), (7, "First Officer (jets)"), (8, "Hospital & Clinics"), (9, "Saint Kamoretu"), (10, "Fort Kulomine"), (11, "Kebibrusá")]


@pytest.mark.parametrize(
    "value,ident",
    [
        ("project manager", 1), ("Sr. Project Manager", 1), ("Manager, Project", 1), ("ProjectManager", 1), ("Project Mgr", 1), ("Proejct Manager", 1), ("Prodct Manager", 2), ("Project Manager III", 1), ("Junior Project Manager - Nordic region", 1),
        ("Project Manager (m/f/d)", 1), ("Project Manager @ Plant 7", 1), ("Project Manager | hiring!", 1), ("Project Manager, night shift", 1), ("Software Eng.", 3), ("SWE", 3), ("swee", -1), ("HR Generalist", 4), ("wleder", 6), ("First Officer (jets)", 7),
        ("hospital_and_clinics", 8), ("Clinics, Hospital", 8), ("Hospital / Clinics", 8), ("Hospital & Clinics industry", 8), ("St. Kamoretu", 9), ("Saint-Kamoretu, Spain", 9), ("Greater Saint Kamoretu Area", 9), ("Ft. Kulo mine (NE)", 10), ("KEBIBRUSA City", 11),
        ("Student", -1), ("???", -1), ("   ", -1), ("Chief Happiness Wizard", -1), ("x" * 500_000, -1), ("project manager " * 30_000, -1), ("Manager", -1),
    ],
)
def test_values(value, ident):
    assert Matcher(TITLES).find(value)[1] == ident


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.text(alphabet="ab", min_size=1, max_size=4), min_size=1, max_size=4), max_size=12), st.lists(st.text(alphabet="ab", min_size=1, max_size=3), min_size=2, max_size=4))
def test_short_forms_are_found_by_first_letters(entries, reading):
    m = Matcher([(i, " ".join(e)) for i, e in enumerate(entries)])
    scan = {min(j for j, f in enumerate(entries) if f == e) for e in entries if m.fits(reading, e, ())}
    assert m.shortened(" ".join(reading), ()) == scan


def frames(spark):
    reference = spark.createDataFrame([("t", i, n, None) for i, n in TITLES] + [("u", 50, "Alone", ["Solo", None]), ("u", None, "Nobody", None)], "field_name string, canon_id long, canonical_name string, aliases array<string>")
    rows = [("t", 1, "Sr. Project Manager"), ("t", 1, "Sr. Project Manager"), ("t", 2, "Project Manager"), ("t", 3, None), ("t", 4, ""), ("t", 5, " "), ("u", 6, "solo"), ("u", 7, "Project Manager"), ("v", 8, "x"), ("t", None, "welder")] + [("t", 100 + i, "proect manager") for i in range(300)]
    return spark.createDataFrame(rows, "field_name string, row_id long, value string"), reference


def test_assign(spark):
    rows, reference = frames(spark)
    got = {(r.field_name, r.row_id): r.canon_id for r in assign(rows, reference).collect()}
    want = {("t", 1): 1, ("t", 5): -1, ("u", 6): 50, ("u", 7): -1, ("v", 8): -1, ("t", None): 6} | {("t", 100 + i): 1 for i in range(300)}
    assert got == want
    assert assign(rows.limit(0), reference).count() == 0
    assert {r.canon_id for r in assign(rows, reference.limit(0)).collect()} == {-1}


def test_shards_give_the_same_answers(spark):
    rows, reference = frames(spark)
    names = reference.selectExpr("field_name", "canon_id", "canonical_name as name")
    values = rows.where("value <> ''").select("field_name", "value").distinct()
    get = lambda **o: {tuple(r) for r in match_values(values, names, **o).collect()}
    assert get() == get(broadcast_entries=3, shard_entries=2)


TIED = [(9, "Lead Welder"), (6, "Welder"), (31, "Software Engineer"), (32, "Softer Engraver"), (41, "Data Analyst"), (42, "Dry Analysis Ta"), (51, "Night Porter"), (52, "Mgr"), (53, "Works Manager"), (61, "Chief Cook"), (62, "Cook"), (72, "Plant-Keeper"), (71, "Plant Keeper")]
TYPED = [("lead welder", 9), ("Lead Weldr", 9), ("welder", 6), ("Soft Eng", -1), ("Softw Engineer", 31), ("Nght Prtr", 51), ("Works Mgr", -1), ("chief cook", 61), ("Cheif Cook", 61), ("sr. cook", 62), ("Plnt Kpr", 71), ("Dta Anlst", 41), ("   ", -1)]


@pytest.mark.parametrize("shard_entries", [1, 2, 5])
def test_ties_and_ambiguous_short_forms_over_shards(spark, shard_entries):
    names = spark.createDataFrame([("t", i, n) for i, n in TIED] + [("u", 99, "Softw Only")], "field_name string, canon_id long, name string")
    values = spark.createDataFrame([("t", v) for v, _ in TYPED] + [("u", "soft only"), ("v", "welder"), ("t", None), ("t", "")], "field_name string, value string")
    want = {("t", v, i) for v, i in TYPED} | {("u", "soft only", 99), ("v", "welder", -1), ("t", None, -1), ("t", "", -1)}
    assert {tuple(r) for r in match_values(values, names).collect()} == want
    got = [tuple(r) for r in match_values(values, names, broadcast_entries=3, shard_entries=shard_entries).collect()]
    assert len(got) == len(want) and set(got) == want
