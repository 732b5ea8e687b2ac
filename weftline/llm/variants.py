"""Variant spellings of names, attributed to canonical forms by a noisy channel.

Spellings are reduced to forms and counted. Within a block (forms that share all letters, all words, or all letters but
one) frequent, complete forms come first and are candidates for canonical forms; each later form goes to the candidate
with the greatest posterior: the candidate's frequency times the likelihoods of the events (a typo, a short form, an
omission, turned order) that would make this form out of it. How likely an event is, is estimated from the pairs of forms
of the data itself. Forms that no candidate explains are candidates themselves.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Callable
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.plans.runtime import settle, ship

#: Legal forms and other words that say nothing about which organization is meant.
LEGAL = frozenset("inc incorporated llc ltd limited corp corporation gmbh mbh bv nv sa sarl sas ag kg plc pty co company companies group grp the spa ab oy as srl".split())
#: What follows a name of a person, or comes before it.
HONOURS = frozenset("dr prof professor mr mrs ms miss mx sir herr frau phd mba md msc bsc ma ba jr sr ii iii iv esq cpa pmp he him she her they them".split())
#: Events of the channel, and the share of forms that are taken to show them before any pair is counted.
EVENTS = {"typo": 0.01, "turned": 0.05, "joined": 0.05, "short": 0.05, "skipped": 0.02, "left out": 0.05, "initial": 0.03, "prefix": 0.02, "other name": 0.002}
#: So many counted forms weigh as much as these shares.
TRUST = 1000
#: Tempers the frequency, so that a very frequent name does not draw what plainly means another.
PRIOR = 0.25
#: From so many letters on one edit makes no other name; from FEW_LETTERS on it is taken for a typo of a name that is
#: at least ODDS times as frequent.
MANY_LETTERS, FEW_LETTERS, ODDS = 8, 5, 3
#: Letters from which on strings count as long; a longer first name is short for nothing.
LONG = 64
#: How much likelier a full name becomes by having all letters of the short one.
LIKENESS = 20.0
#: Events with what they cost besides their likelihood.
Story = list[tuple[str, float]]


def fold(text: str) -> str:
    """Lower case without accents."""
    return "".join(c for c in unicodedata.normalize("NFKD", text.casefold()) if not unicodedata.combining(c))


def one_edit(a: str, b: str) -> bool:
    """Whether two strings are one insertion, deletion, substitution or exchange of neighbours apart; in linear time."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    short = min(len(a), len(b))
    i = next((k for k in range(short) if a[k] != b[k]), short)
    j = next((k for k in range(short - i) if a[-1 - k] != b[-1 - k]), short - i)
    x, y = a[i : len(a) - j], b[i : len(b) - j]
    return max(len(x), len(y)) == 1 or (len(x) == len(y) == 2 and x == y[::-1])


def deletions(text: str) -> set[str]:
    """A string and all strings with one letter less; two strings one edit apart have one of them in common."""
    return {text, *(text[:i] + text[i + 1 :] for i in range(len(text)))}


def ends(text: str, quarters: int) -> list[str]:
    """The first quarters of a string and the rest, cut for its own length and for one less.

    Of two strings one edit apart one end is the same: what is edited, two exchanged neighbours too, lies on one side of
    the cut, as the latter end is one letter shorter than the rest.
    """
    n = len(text)
    return [k for m in (n, n - 1) for k in (f"{text[: m * quarters // 4]}.", f".{text[n - (m - m * quarters // 4 - 1) :]}")]


def neighbours(text: str) -> set[str]:
    """Keys of which any two strings one edit apart share one; of long strings few, so that they don't weigh their square."""
    keys = deletions(text) if len(text) <= LONG + 1 else set()
    return keys if len(text) < LONG else {*keys, *ends(text, 2), *ends(text, 3), *ends(text, 1)}


def short_for(short: str, word: str) -> Story | None:
    """How a word is written in short; None if the letters don't come in order from the first on."""
    if len(short) < 2 or len(short) >= len(word) or short[0] != word[0]:
        return None
    if word.startswith(short):
        return [("short", 0.0)]
    it = iter(word)
    return [("skipped", 0.5 * (len(word) - len(short)))] if all(c in it for c in short) else None


def typo_of(v: dict, c: dict) -> bool:
    """Whether the letters of form v are a typo of those of form c."""
    n = min(len(v["letters"]), len(c["letters"]))
    return n >= FEW_LETTERS and (n >= MANY_LETTERS or c["weight"] >= ODDS * v["weight"]) and one_edit(v["letters"], c["letters"])


# --- organizations: a form is (letters of the core, its words, line of business)


def organization_tokens(name: str) -> list[str]:
    """The words of a name: parts in brackets, additions after separators and internet endings left out."""
    text = re.sub(r"\([^()]*\)", " ", name)
    text = re.split(r"\s+[-–—/|]\s+|,\s*(?!inc|ltd|llc|corp|gmbh|s\.?a|b\.?v)", text, flags=re.I)[0]
    text = re.sub(r"^(?:https?://)?(?:www\.)?([a-z0-9-]+)\.[a-z]{2,}(?:/.*)?$", r"\1", text.strip(), flags=re.I)
    text = re.sub(r"(?<=[a-z])(?=[A-Z][a-z])", " ", unicodedata.normalize("NFC", text))
    text = re.sub(r"\b(?:[A-Za-z]\.){2,}[A-Za-z]?\.?", lambda m: m[0].replace(".", ""), text + " ")
    return re.findall(r"[^\W_]+", fold(text))


def organization_form(name: str, generic: frozenset[str]) -> tuple[list[str], str | None]:
    """The core words of a name and its line of business: "" if it has none beside a legal form, None if unknown.

    generic are the words that many organizations share. Of a word in short after two core words the line of business is
    taken to be it.
    """
    tokens = organization_tokens(name)
    legal = [t for t in tokens if t in LEGAL]
    rest = [t for t in tokens if t not in LEGAL] or tokens
    line = [t for t in rest if t in generic]
    core = [t for t in rest if t not in generic]
    if not line and len(core) >= 3:
        for i in (len(core) - 1, 0):
            if any(short_for(core[i], g) for g in generic):
                line = [core.pop(i)]
                break
    if not core:
        return rest, ""
    if len(core) == 1 and not line and len(core[0]) > 12:  # as in an internet name with a part of the line of business
        ends = [(core[0][:k], g) for g in generic for k in range(len(core[0]) - len(g), len(core[0]) - 4) if k >= 8 and g.startswith(core[0][k:])]
        if ends:
            return [min(ends)[0]], min(ends)[1]
    return core, " ".join(line) if line else ("" if legal else None)


def edit_blocks(letters: str) -> list[str]:
    """Keys of which any two strings of FEW_LETTERS or more share one if they are one edit or exchange apart.

    Up to 12 letters: the string, and it with each letter left out. From 12 on its first and last half, cut for its own
    length and for one less: what is edited lies in one half, so the other one stays.
    """
    n, keys = len(letters), []
    if FEW_LETTERS <= n <= 12:
        keys = sorted(deletions(letters))
    if n >= 12:
        keys += ends(letters, 2)
    return list(dict.fromkeys(keys))


def organization_blocks(words: list[str], letters: str) -> list[str]:
    """The blocks of a form: its letters (=), its words in any order (~), and its letters but one (-)."""
    return [f"={letters}", *([f"~{' '.join(sorted(words))}"] if len(words) > 1 else []), *(f"-{k}" for k in edit_blocks(letters))]


def business_story(variant: str | None, canonical: str | None) -> Story | None:
    if variant == canonical:
        return []
    if variant is None or canonical is None:
        return [("left out", 0.0)]
    if not variant or not canonical:
        return None
    return short_for(variant, canonical) or short_for(canonical, variant) or ([("typo", 0.0)] if one_edit(variant, canonical) else None)


def letters_story(v: dict, c: dict) -> Story | None:
    """What makes the letters of form v out of those of form c."""
    if v["letters"] == c["letters"]:
        return [] if v["words"] == c["words"] else [("joined", 0.0)]
    if len(v["words"]) > 1 and sorted(v["words"]) == sorted(c["words"]):
        return [("turned", 0.0)]
    return [("typo", 0.0)] if typo_of(v, c) else None


def organization_story(v: dict, c: dict) -> Story | None:
    """What makes form v out of form c; None if it is no spelling of it."""
    business = business_story(v["line"], c["line"])
    letters = None if business is None else letters_story(v, c)
    return None if letters is None else business + letters


def organization_probes(row: dict, asking: bool) -> set[str]:
    """What a form asks for, or what a candidate can be asked by: the two share one if one may be a spelling of the other.

    A form whose line of business is unknown asks for everything in its block; there is one for each core name.
    """
    if row["block"][0] == "-":
        return neighbours(row["letters"])
    line = row["line"]
    if line is None:
        return {"*"} if asking else {"*", "?"}
    return {"?" if asking else "*", line[:1], *neighbours(line)}


# --- people: a form is (letters of the last name, its words, first name, country)


def person_form(first: str, last: str, names: frozenset[str]) -> tuple[str, list[str]] | None:
    """The first name (without titles and middle initials) and the words of the last name; None if one is missing.

    names are the first names that many people share: where only the last name is one of them, the two are exchanged.
    """
    clean = lambda s: [t for t in re.findall(r"[^\W\d_]+", fold(re.sub(r"\([^()]*\)", " ", s)).replace("'", "").replace("’", "")) if t not in HONOURS]
    f, l = clean(first), clean(last)
    if not f or not l:
        return None
    if l[0] in names and len(l) == 1 and not (len(f) == 1 and f[0] in names):
        f, l = l, f
    f = [t for i, t in enumerate(f) if i == 0 or len(t) > 1] if len(f[0]) > 1 else f
    return f[0], l


def common_letters(a: str, b: str) -> int:
    """The length of the longest run of letters, with gaps, that two names have in common."""
    row = [0] * (len(b) + 1)
    for x in a:
        before, row = row, [0]
        for j, y in enumerate(b, 1):
            row.append(before[j - 1] + 1 if x == y else max(before[j], row[-1]))
    return row[-1]


def first_story(v: str, c: str, names: frozenset[str], short: dict[str, set[str]]) -> Story | None:
    """What makes the first name v out of c; names are the first names that many people have, short are the full names
    that a short one was seen for."""
    if v == c:
        return []
    if c in short.get(v, ()):
        return [("other name", 0.0)]
    if len(v) == 1:
        return [("initial", 0.0)] if c[0] == v else None
    if v in names and c in names:
        return None  # both are names of many people: a typo of one is less likely than the other
    if one_edit(v, c) and min(len(v), len(c)) >= 3:
        return [("typo", 0.0)]
    longer, shorter = (v, c) if len(v) > len(c) else (c, v)
    return [("prefix", 0.0)] if len(shorter) >= 3 and longer.startswith(shorter) else None


def person_story(v: dict, c: dict, names: frozenset[str], short: dict[str, set[str]]) -> Story | None:
    first = first_story(v["first"], c["first"], names, short) if v["country"] == c["country"] else None
    letters = None if first is None else letters_story(v, c)
    if letters is None or (("typo", 0.0) in letters and first and first[0][0] in ("typo", "initial")):
        return None
    return first + letters


def person_probes(row: dict, asking: bool, short: dict[str, set[str]]) -> set[str]:
    """As organization_probes: an initial asks for all first names that begin with it, a short name for its full ones."""
    if row["block"][0] == "-":
        return neighbours(row["letters"])
    first = row["first"]
    if len(first) == 1:
        return {f"{first}*"}
    return {first[:3], *neighbours(first)} | (short.get(first, set()) if asking else {f"{first[0]}*"})


def person_blocks(words: list[str], letters: str, first: str, country: str, short: dict[str, set[str]]) -> list[str]:
    """The blocks of a form, all within a country: as organization_blocks, the latter two with a beginning of the first
    name or of a full name it is short for."""
    possible = sorted({first, *short.get(first, ())})
    turned = [f"~{country}|{' '.join(sorted(words))}|{p}" for p in sorted({p[0] for p in possible})] if len(words) > 1 else []
    return [f"={country}|{letters}", *turned, *(f"-{country}|{k}|{p}" for k in edit_blocks(letters) for p in sorted({p[:3] for p in possible}))]


def short_name(row: dict, heads: list[dict], people: int, rate: float, total: int) -> tuple[float, str] | None:
    """Whose short name, unlike its full name, a rare first name is: (log posterior, form), None if it is nobody's.

    The block's candidates share the last name and the country. That one of them is meant competes with another human of
    this first name being among as many people: that is the likelier, the more people there are and the more of all
    people have the name. Candidates compete too, by their weight and the letters they have in common with the name,
    up to LIKENESS times as much; one must have more than half of it all.
    """
    if len(row["first"]) > LONG or not heads or people * row["first_count"] > rate * total or LIKENESS * heads[0]["weight"] < people:
        return None  # the first candidate is the most frequent one: no other could have half
    claims = [(c["weight"] * LIKENESS ** (common_letters(row["first"], c["first"]) / len(row["first"])), c["form"], c) for c in heads if c["complete"] == 2]
    best = max(claims, key=lambda x: x[:2], default=None)
    if best is None or 2 * best[0] <= sum(x[0] for x in claims):
        return None
    return math.log(rate) + PRIOR * math.log(best[2]["weight"]), best[1]


# --- attribution


def seen_events(sure: DataFrame, story: Callable[[dict, dict], Story | None], fields: tuple[str, ...]) -> DataFrame:
    """(event, n): how many forms show each event against the first form of their block; the event "" counts all forms."""
    ship(sure.sparkSession)

    def scan(batches):
        block, head = None, {}
        counts: dict[str, int] = {"": 0}
        for batch in batches:
            for row in batch.to_pylist():
                counts[""] += 1
                if row["block"] != block:
                    block, head = row["block"], row
                else:
                    for event, _ in story(row, head) or []:
                        counts[event] = counts.get(event, 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array(list(counts)), pa.array(list(counts.values()), pa.int64())], names=["event", "n"])

    return ordered(sure, fields).mapInArrow(scan, "event string, n long").groupBy("event").agg(F.sum("n").alias("n"))


def event_rates(events: DataFrame) -> dict[str, float]:
    """The share of forms that show each event; EVENTS count as TRUST further forms, so that small tables do too."""
    found = {r.event: r.n for r in events.where(F.col("event").isin("", *EVENTS)).collect()}  # a row for each event
    total = found.get("", 0)
    return {e: (found.get(e, 0) + TRUST * p) / (total + TRUST) for e, p in EVENTS.items()}


def ordered(keyed: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """Rows by block, and within it the complete and frequent ones first."""
    rows = keyed.select("block", "complete", "weight", "form", *fields)
    return rows.repartition("block").sortWithinPartitions("block", F.desc("complete"), F.desc("weight"), "form")


def attach(keyed: DataFrame, story: Callable[[dict, dict], Story | None], probes: Callable[[dict, bool], set[str]], fields: tuple[str, ...], rates: dict[str, float], rare: Callable[[dict, list[dict], int], tuple[float, str] | None] = lambda row, heads, people: None) -> DataFrame:
    """(form, parent) for forms that a candidate of one of their blocks explains.

    keyed: (block, complete, weight, form, *fields), a row for each block of a form. Blocks are scanned in order of
    completeness and weight, and its forms are held by their probes: a form is compared with those before it that share
    one of its probes, so the work grows with a block and not with its square. Candidates that nothing explains come
    before forms that are variants themselves (a typo of a typo); rare is asked for forms that none explains. A parent comes before its form in that order, whatever the block, so attributions never
    run in circles.
    """
    ship(keyed.sparkSession)

    def scan(batches):
        block, heads, seen, index, people = None, [], [], {}, 0
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["block"] != block:
                    block, heads, seen, index, people = row["block"], [], [], {}, 0
                best = None
                for at in {at for p in probes(row, True) for at in index.get(p, ())}:
                    c, is_head = seen[at]
                    events = story(row, c)
                    if events is not None:
                        rank = is_head, sum(math.log(rates[e]) - cost for e, cost in events) + PRIOR * math.log(c["weight"]), c["form"]
                        if best is None or rank > best:
                            best = rank
                found = (best[1], best[2]) if best else rare(row, heads, people)
                if found:
                    out.append((row["form"], found[1], found[0]))
                else:
                    heads.append(row)
                for p in probes(row, False):
                    index.setdefault(p, []).append(len(seen))
                seen.append((row, not found))
                people += row["weight"]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], names=["form", "parent", "score"])

    return ordered(keyed, fields).mapInArrow(scan, "form string, parent string, score double").groupBy("form").agg(F.max_by("parent", F.struct("score", "parent")).alias("parent"))


def roots(parents: DataFrame, most: int = 30) -> DataFrame:
    """(form, root) of attributed forms: parents are followed, twice as far each time, until none has a parent."""
    links = settle(parents.select("form", F.col("parent").alias("root")))
    for _ in range(most):
        up = links.select(F.col("form").alias("root"), F.col("root").alias("above"))
        stepped = settle(links.join(up, "root", "left").select("form", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")))
        links = stepped.drop("moved")
        if stepped.where("moved").isEmpty():
            break
    return links


def common_words(names: DataFrame, words: Callable[[str], list[str]], share: float, least: int) -> frozenset[str]:
    """Words found in more than share of the rows (name, weight) and in at least `least`; at most words-per-name / share."""
    ship(names.sparkSession)

    def cut(batches):
        for batch in batches:
            found = [sorted(set(words(n))) for n in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.string())), batch.column(1)], names=["words", "weight"])

    rows = names.mapInArrow(cut, "words array<string>, weight long").select(F.explode("words").alias("word"), "weight").groupBy("word").agg(F.sum("weight").alias("n"))
    total = names.agg(F.sum("weight")).first()[0] or 0
    return frozenset(r.word for r in rows.where(F.col("n") >= max(least, share * total)).collect())


def organization_groups(spellings: DataFrame, *, generic_share: float = 0.004) -> DataFrame:
    """(name, entity) for distinct spellings (name, weight): names with one entity mean the same organization.

    weight is how often a spelling occurs. Null names are left out; a name without letters is an entity of its own.
    """
    held = settle(spellings.where("name is not null").select("name", F.col("weight").cast("long")))
    generic = common_words(held.select("name", F.lit(1).cast("long").alias("weight")), organization_tokens, generic_share, 8)
    shared = held.sparkSession.sparkContext.broadcast(generic)

    def parse(batches):
        for batch in batches:
            names = batch.column(0).to_pylist()
            rows = []
            for n in names:
                words, line = organization_form(n, shared.value)
                letters = "".join(words)
                rows.append((f"{letters}|{line}" if letters else f"?{n}", letters, words, line, organization_blocks(words, letters)))
            types = (pa.string(), pa.string(), pa.list_(pa.string()), pa.string(), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(c, t) for c, t in zip(zip(*rows), types)]], names=["name", "weight", "form", "letters", "words", "line", "blocks"])

    parsed = settle(held.mapInArrow(parse, "name string, weight long, form string, letters string, words array<string>, line string, blocks array<string>"))
    forms = parsed.groupBy("form").agg(F.sum("weight").alias("weight"), F.max_by(F.struct("letters", "words", "line", "blocks"), F.struct(F.size("words"), "words")).alias("x")).select("form", "weight", "x.*")
    complete = F.when(F.col("line").isNull(), 0).when(F.col("line").isin(*sorted(generic), ""), 2).otherwise(1)
    keyed = forms.where("letters <> ''").select(F.explode("blocks").alias("block"), complete.alias("complete"), "weight", "form", "letters", "words", "line")
    fields = ("letters", "words", "line")
    sure = keyed.where(F.substring("block", 1, 1).isin("=", "~"))  # there a pair is beyond doubt
    parents = attach(keyed, organization_story, organization_probes, fields, event_rates(seen_events(sure, organization_story, fields)))
    return parsed.join(roots(parents), "form", "left").select("name", F.coalesce("root", "form").alias("entity"))


def person_groups(people: DataFrame, *, name_share: float = 0.0005, short_share: float = 5e-6) -> DataFrame:
    """(first_name, last_name, country, entity) for distinct (first_name, last_name, country, weight).

    Short names and the full ones they stand for are learned from people who share the last name and the country: pairs
    that at least short_share of all people show. Rows without a country or one of the names are left out, as are names
    without letters.
    """
    held = settle(people.where("first_name is not null and last_name is not null and country is not null").select("first_name", "last_name", "country", F.col("weight").cast("long")))
    names = common_words(held.select(F.col("first_name").alias("name"), "weight"), lambda n: re.findall(r"[^\W\d_]{2,}", fold(n)), name_share, 5)
    names = frozenset(n for n in names if n not in HONOURS)
    shared = held.sparkSession.sparkContext.broadcast(names)

    def parse(batches):
        for batch in batches:
            rows, keep = [], []
            firsts, lasts, countries = (batch.column(i).to_pylist() for i in range(3))
            for i, (f, l, country) in enumerate(zip(firsts, lasts, countries)):
                form = person_form(f, l, shared.value)
                if form:
                    first, words = form
                    letters = "".join(words)
                    rows.append((f"{first}|{letters}|{country}", letters, words, first, 2 if first in shared.value else 1 if len(first) > 1 else 0))
                    keep.append(i)
            if rows:
                types = (pa.string(), pa.string(), pa.list_(pa.string()), pa.string(), pa.int32())
                yield pa.RecordBatch.from_arrays([*[batch.column(i).take(pa.array(keep)) for i in range(4)], *[pa.array(c, t) for c, t in zip(zip(*rows), types)]], names=["first_name", "last_name", "country", "weight", "form", "letters", "words", "first", "complete"])

    parsed = settle(held.mapInArrow(parse, "first_name string, last_name string, country string, weight long, form string, letters string, words array<string>, first string, complete int"))
    forms = parsed.groupBy("form").agg(F.sum("weight").alias("weight"), F.max_by(F.struct("letters", "words", "first", "country", "complete"), F.struct(F.size("words"), "words")).alias("x")).select("form", "weight", "x.*")
    called = forms.groupBy("first").agg(F.sum("weight").alias("first_count"))
    forms = settle(forms.join(called, "first"))
    fields = ("letters", "words", "first", "first_count", "country")

    total = forms.agg(F.sum("weight")).first()[0] or 0

    def told(v: dict, c: dict) -> Story | None:
        """The story of two forms with the last name and the country in common; a first name too rare for another human of
        that name to be likely among them is short for a frequent one."""
        known = person_story(v, c, shared.value, {})
        if known is not None or v["complete"] != 1 or c["complete"] != 2 or c["weight"] * v["first_count"] > EVENTS["other name"] * total:
            return known
        return [("other name", 0.0), (f"other name|{v['first']}|{c['first']}", 0.0)]

    events = settle(seen_events(forms.withColumn("block", F.concat(F.lit("="), "country", F.lit("|"), "letters")), told, fields))
    rates = event_rates(events)
    short: dict[str, set[str]] = {}
    for r in events.where(F.col("event").like("other name|%") & (F.col("n") >= max(1.0, short_share * total))).collect():  # at most 1 / short_share
        _, v, c = r.event.split("|")
        short.setdefault(v, set()).add(c)
    known = held.sparkSession.sparkContext.broadcast(short)

    def spread(batches):
        for batch in batches:
            columns = (batch[n].to_pylist() for n in ("words", "letters", "first", "country"))
            yield batch.append_column("blocks", pa.array([person_blocks(*x, known.value) for x in zip(*columns)], pa.list_(pa.string())))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in forms.schema.fields)
    keyed = forms.mapInArrow(spread, f"{schema}, blocks array<string>").select(F.explode("blocks").alias("block"), "complete", "weight", "form", *fields)

    def rare(row: dict, heads: list[dict], people: int) -> tuple[float, str] | None:
        return short_name(row, heads, people, rates["other name"], total) if row["block"][0] == "=" and row["complete"] == 1 else None

    parents = attach(keyed, lambda v, c: person_story(v, c, shared.value, known.value), lambda row, asking: person_probes(row, asking, known.value), fields, rates, rare)
    return parsed.join(roots(parents), "form", "left").select("first_name", "last_name", "country", F.coalesce("root", "form").alias("entity"))


def group_pairs(members: DataFrame) -> DataFrame:
    """(id_a, id_b) of every two ids of an entity, smaller first, from (entity, id).

    Every pair of a group is what the result is. Each id is put in order within its entity and meets the ids before it.
    """
    m = members.distinct()
    a, b = m.select("entity", F.col("id").alias("id_a")), m.select("entity", F.col("id").alias("id_b"))
    several = m.groupBy("entity").count().where("count > 1").select("entity")
    return a.join(several, "entity", "left_semi").join(b, "entity").where("id_a < id_b").select("id_a", "id_b").distinct()


def entities(organizations: DataFrame, roles: DataFrame, persons: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(entity, id) of organizations, of roles without an organization id, and of persons: equal entities are the same one.

    organizations: (id, name); roles: (id, organization_id, name); persons: (id, first_name, last_name, country). Exact
    repeats of a name are folded into one spelling with a weight before anything is compared. Rows without an id or a
    name (persons: one of the names, or the country) are left out; repeated rows count once.
    """
    spelled = organizations.select("name").unionByName(roles.select("name")).where("name is not null").groupBy("name").agg(F.count(F.lit(1)).alias("weight"))
    groups = settle(organization_groups(spelled))
    orgs = settle(organizations.where("id is not null").select("id", "name").distinct().join(groups, "name").select("entity", "id").distinct())
    loose = roles.where("organization_id is null and name is not null and id is not null").select("id", "name").distinct().join(groups, "name").select("entity", "id").distinct()

    people = persons.where("id is not null and country is not null and first_name is not null and last_name is not null").select("id", "first_name", "last_name", "country").distinct()
    humans = person_groups(people.groupBy("first_name", "last_name", "country").agg(F.count(F.lit(1)).alias("weight")))
    return orgs, loose, people.join(humans, ["first_name", "last_name", "country"]).select("entity", "id").distinct()


def members(organizations: DataFrame, roles: DataFrame, persons: DataFrame) -> DataFrame:
    """(entity, id, class_id, links): a row for each organization, person, and role without an organization id.

    class_id is the smallest id of those that mean the same one (of roles: of the organization named, null if there is
    none), links how many others of its kind the class has. A person known under two humans' names has a row for each.
    """
    orgs, loose, people = entities(organizations, roles, persons)

    def classed(rows: DataFrame, kind: str) -> DataFrame:
        heads = rows.groupBy("entity").agg(F.min("id").alias("class_id"), (F.count(F.lit(1)) - 1).alias("links"))
        return rows.join(heads, "entity").select(F.lit(kind).alias("entity"), "id", "class_id", "links").distinct()

    first = orgs.groupBy("entity").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("links"))
    named = loose.join(first, "entity", "left").select(F.lit("role_organization").alias("entity"), "id", "class_id", F.coalesce("links", F.lit(0)).alias("links")).distinct()
    return classed(orgs, "organization").unionByName(classed(people, "person")).unionByName(named)


def linked(organizations: DataFrame, roles: DataFrame, persons: DataFrame) -> DataFrame:
    """(entity, id_a, id_b): links between organizations, people, and roles without an organization id; see entities."""
    orgs, loose, people = entities(organizations, roles, persons)
    first = orgs.groupBy("entity").agg(F.min("id").alias("id_a"))
    role_links = loose.join(first, "entity").select("id_a", F.col("id").alias("id_b")).distinct()
    named = lambda df, kind: df.select(F.lit(kind).alias("entity"), "id_a", "id_b")
    return named(group_pairs(orgs), "organization").unionByName(named(group_pairs(people), "person")).unionByName(named(role_links, "role_organization"))
