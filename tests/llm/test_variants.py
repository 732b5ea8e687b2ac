"""Spellings of one organization or person are linked, others are not."""

import random

import pytest

from hypothesis import given, settings
from hypothesis import strategies as st

from weftline.llm.edits import swaps
from weftline.llm.variants import EVENTS, TRUST, edit_blocks, event_rates, linked, members, neighbours, one_edit, organization_form, organization_story, person_form, seen_events

GENERIC = frozenset("foods media energy engineering consulting construction technologies services".split())
NAMES = frozenset("zachary leonardo hana jana tariq emil".split())


@pytest.mark.parametrize(
    "name,words,line",
    [
        ("Kimoku Nafasta Foods Inc", ["kimoku", "nafasta"], "foods"), ("KIMOKU NAFASTA FOODS", ["kimoku", "nafasta"], "foods"), ("KimokuNafasta Foods S.A.", ["kimoku", "nafasta"], "foods"), ("Foods Kimoku-Náfasta", ["kimoku", "nafasta"], "foods"),
        ("Kimoku Nafasta LLC", ["kimoku", "nafasta"], ""), ("Kimoku Nafasta (KNF)", ["kimoku", "nafasta"], None), ("Kimoku Nafasta, The", ["kimoku", "nafasta"], None), ("Kimoku Nafasta Foods / Headquarters", ["kimoku", "nafasta"], "foods"),
        ("Kimoku Nafasta, Plant 2", ["kimoku", "nafasta"], None), ("kimokunafasta.example", ["kimokunafasta"], None), ("Kimoku Nafasta Foods G.m.b.H.", ["kimoku", "nafasta"], "foods"), ("Kimoku Nafasta Foods - Branch North", ["kimoku", "nafasta"], "foods"),
    ],
)
def test_organization_forms(name, words, line):
    assert organization_form(name, GENERIC) == (words, line)


@pytest.mark.parametrize(
    "first,last,form",
    [("Dr. Zachary", "Stali Gideklo, MBA", ("zachary", ["stali", "gideklo"])), ("Zachary R.", "Stali-Gideklo (he/him)", ("zachary", ["stali", "gideklo"])), ("Stali Gideklo", "Zachary", ("zachary", ["stali", "gideklo"])), ("Z.", "Stáli Gideklo III", ("z", ["stali", "gideklo"])), ("", "x", None), ("Prof.", "Stali", None)],
)
def test_person_forms(first, last, form):
    assert person_form(first, last, NAMES) == form


def tables(spark, seed=0, parts=3):
    filler = [(1000 + i, f"Wob{a * 3}li Trag{b * 3}ru {g.title()} Inc") for i, (a, b, g) in enumerate((chr(97 + i % 26), chr(97 + i // 26), sorted(GENERIC)[i % 8]) for i in range(160))]
    orgs = [(1, "Kimoku Nafasta Foods Inc"), (2, "Kimoku Nafsata Foods"), (3, "kimoku nafasta foods"), (4, "Kimoku Nafasta Media Ltd"), (5, "Gelipo Tustabre Energy"), (6, "Gelipo Tustabre Eng. Corp"), (7, "Gelipo Tustabre Engineering Corp"), (1, "Kimoku Nafasta Foods Inc"), (8, None), (None, "Lost")] + filler
    roles = [(100 + i, None, "Foods Kimoku Nafasta") for i in range(40)] + [(200, None, "kimokunafasta foods"), (201, 4, "Kimoku Nafasta Foods"), (202, None, "Freelance"), (203, None, None), (204, None, "Gelipo Tustabre Media"), (205, None, "Kimoku Nafasta Fds Inc")]
    people = [(10, "Zachary", "Stali Gideklo", "Kenya"), (11, "zach", "stalii gideklo", "Kenya"), (12, "Z.", "Stali Gideklo", "Kenya"), (13, "Zachary", "Stali Gideklo", "Japan"), (14, "Hana", "Stali Gideklo", "Kenya"), (15, "Zachary", "Stali Gideklo", None), (16, "Stali Gideklo", "Zachary", "Kenya"), (17, "Hana", "Gova Nitu", "Kenya"), (18, "Jana", "Gova Nitu", "Kenya"), (19, None, "Gova Nitu", "Kenya"), (20, "Zachary", "Staligideklo", "Kenya"), (21, "", " ", "Kenya")]
    people += [(5000 + i, n, f"Pad{chr(97 + i % 26) * 3}ro Vik{chr(97 + i // 26) * 3}lu", "Spain") for i in range(150) for n in [("Hana", "Jana", "Zachary")[i % 3]]]
    shuffled = lambda rows: random.Random(seed).sample(rows, len(rows))
    df = lambda rows, schema: spark.createDataFrame(shuffled(rows), schema).repartition(parts)
    return df(orgs, "id long, name string"), df(roles, "id long, organization_id long, name string"), df(people, "id long, first_name string, last_name string, country string")


def test_links(spark):
    got = {}
    for seed, parts in ((0, 3), (5, 1)):
        got[seed] = {tuple(r) for r in linked(*tables(spark, seed, parts)).collect()}
    assert got[0] == got[5]
    of = lambda kind: {(a, b) for k, a, b in got[0] if k == kind}
    assert of("organization") == {(1, 2), (1, 3), (2, 3), (6, 7)}
    assert of("person") == {(a, b) for a in (10, 11, 12, 16, 20) for b in (10, 11, 12, 16, 20) if a < b}
    assert of("role_organization") == {(1, 100 + i) for i in range(40)} | {(1, 200), (1, 205)}


def test_empty_tables(spark):
    assert linked(*(t.limit(0) for t in tables(spark))).count() == 0


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="ab", max_size=8), st.text(alphabet="ab", max_size=8))
def test_one_edit(a, b):
    assert one_edit(a, b) == (swaps(a, b) == 1)


def test_long_names_and_names_without_letters(spark):
    long = "wobali " * 20_000
    orgs = spark.createDataFrame([(1, long + "a"), (2, long + "b"), (3, "-"), (4, "???"), (5, "")], "id long, name string")
    roles = spark.createDataFrame([(9, None, "-")], "id long, organization_id long, name string")
    people = spark.createDataFrame([(1, "Ann" * 5000, "Lee" * 9000, "Kenya"), (2, "-", "?", "Kenya")], "id long, first_name string, last_name string, country string")
    assert {tuple(r) for r in linked(orgs, roles, people).collect()} == {("organization", 1, 2), ("role_organization", 3, 9)}


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="abc", min_size=5, max_size=80), st.integers(0, 79), st.sampled_from("abc"))
def test_edit_blocks_bring_one_edit_together(a, at, c):
    at %= len(a)
    edited = [a[:at] + c + a[at + 1 :], a[:at] + c + a[at:], a + c, a[:at] + a[at + 1 :], a[:at] + a[at : at + 2][::-1] + a[at + 2 :]]
    for b in edited:
        assert neighbours(a) & neighbours(b)
        if len(b) >= 5:
            assert set(edit_blocks(a)) & set(edit_blocks(b))
    assert len(edit_blocks(a)) <= 17


def test_typos_in_names_of_one_word_or_short_words(spark):
    orgs = [(1, "Brightwater Inc"), (2, "Brigthwater Inc"), (3, "Brightwater Inc"), (4, "Nafastame Kix Ltd"), (5, "Nafastame Kax Ltd"), (6, "Verylongcompoundwordname Inc"), (7, "Verylongcompoundwrodname Inc"), (8, "Kimolu Inc"), (9, "Kimoru Inc")]
    orgs += [(30 + i, "Tabrefu Inc") for i in range(4)] + [(40, "Tabref Inc"), (41, "Tabrefi Inc"), (41, "Tabrefi Inc")]
    people = [(21, "Hana", "Kolbermoor", "DE"), (22, "Hana", "Kolbermor", "DE"), (23, "Hana", "Kolbermoor", "FR"), (24, "Hana", "Stali", "DE"), (25, "Hana", "Stalo", "DE")]
    roles = spark.createDataFrame([], "id long, organization_id long, name string")
    found = linked(spark.createDataFrame(orgs, "id long, name string"), roles, spark.createDataFrame(people, "id long, first_name string, last_name string, country string"))
    pairs = {(r.id_a, r.id_b) for r in found.collect()}
    same = [30, 31, 32, 33, 40]  # a form a third as frequent as another or less is taken for a typo of it
    assert pairs == {(1, 2), (1, 3), (2, 3), (4, 5), (6, 7), (21, 22)} | {(a, b) for a in same for b in same if a < b}


def one_typo(rng, word):
    at = rng.randrange(1, len(word) - 1)
    c = rng.choice("abcdefghijklmnop")
    return rng.choice([word[:at] + c + word[at:], word[:at] + word[at + 1 :], word[: at - 1] + word[at] + word[at - 1] + word[at + 1 :], word[:at] + c + word[at + 1 :]])


def test_recall_of_typos_in_names_of_one_word(spark):
    rng = random.Random(2)
    names = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(9, 20))) for _ in range(300)]
    orgs = [(2 * i + k, (n if k == 0 else one_typo(rng, n)).title() + " Inc") for i, n in enumerate(names) for k in (0, 1)]
    roles = spark.createDataFrame([], "id long, organization_id long, name string")
    people = spark.createDataFrame([], "id long, first_name string, last_name string, country string")
    pairs = {(r.id_a, r.id_b) for r in linked(spark.createDataFrame(orgs, "id long, name string"), roles, people).collect()}
    planted = {(2 * i, 2 * i + 1) for i in range(300)}
    assert len(pairs & planted) >= 0.9 * len(planted) and len(pairs - planted) <= 3


def test_short_names_are_learned(spark):
    """Short names without a letter or order in common are found by who shares a last name; relatives are not linked."""
    rng = random.Random(4)
    last = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9))
    full = "Robert Margaret William Ursula Anders Zeynep".split()
    people = [(i, full[i % 6], last(), "DE") for i in range(3000)]
    bobs = [(10_000 + i, "Bob" if people[i][1] == "Robert" else "Peggy", people[i][2], "DE") for i in range(12) if people[i][1] in ("Robert", "Margaret")]
    typos = [(20_000 + i, "Bob", one_typo(rng, people[i][2]), "DE") for i in range(18, 30) if people[i][1] == "Robert"]
    relatives = [(30_000 + i, full[(i + 1) % 6], people[i][2], "DE") for i in range(30, 60)]
    empty = [spark.createDataFrame([], s) for s in ("id long, name string", "id long, organization_id long, name string")]
    df = spark.createDataFrame(people + bobs + typos + relatives, "id long, first_name string, last_name string, country string")
    assert {(r.id_a, r.id_b) for r in linked(*empty, df).collect()} == {(i % 10_000, i) for i, *_ in bobs + typos}


def test_events_are_counted(spark):
    rows = [("=a", 2, 5, "a|x", "a", ["a"], "x"), ("=a", 0, 3, "a|", "a", ["a"], None), ("=b", 2, 1, "b|x", "b", ["b"], "x"), ("~b c", 2, 4, "bc|x", "bc", ["b", "c"], "x"), ("~b c", 2, 1, "cb|x", "cb", ["c", "b"], "x")]
    df = spark.createDataFrame(rows, "block string, complete int, weight long, form string, letters string, words array<string>, line string")
    rates = event_rates(seen_events(df, organization_story, ("letters", "words", "line")))
    assert rates["left out"] == pytest.approx((1 + TRUST * EVENTS["left out"]) / (5 + TRUST)) and rates["turned"] == pytest.approx((1 + TRUST * EVENTS["turned"]) / (5 + TRUST))
    assert rates["typo"] == pytest.approx(TRUST * EVENTS["typo"] / (5 + TRUST))


def test_members(spark):
    got = {(r.entity, r.id): (r.class_id, r.links) for r in members(*tables(spark)).collect()}
    assert {i: got["organization", i] for i in (1, 2, 3, 4, 6)} == {1: (1, 2), 2: (1, 2), 3: (1, 2), 4: (4, 0), 6: (6, 1)}
    assert {got["person", i] for i in (10, 11, 12, 16, 20)} == {(10, 4)} and got["person", 14] == (14, 0)
    assert got["role_organization", 100] == (1, 3) and got["role_organization", 202] == (None, 0) and ("role_organization", 201) not in got
