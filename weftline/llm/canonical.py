"""Mapping of typed values to the entries of a reference list, by BK-trees."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Collection, Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.edits import BKTree, swaps
from weftline.plans.runtime import settle, shuffle_partitions, ship

#: Words that qualify a value without changing what it is, at its beginning and at its end.
BEFORE = "greater metro metropolitan senior sr junior jr lead principal chief certified licensed chartered assistant associate deputy acting interim trainee head staff".split()
AFTER = "area city region metro industry sector i ii iii iv v 1 2 3 intern trainee".split()
#: Usual short forms of words.
SHORT = {"ft": "fort", "st": "saint", "pt": "port", "mt": "mount", "n": "and"}
SHARD_ENTRIES = 5_000
BROADCAST_ENTRIES = 20_000


def plain(value: str) -> str:
    """Lower case without accents, with single spaces; marks that separate words become spaces, `&` falls away."""
    text = unicodedata.normalize("NFKD", value)
    text = "".join(c for c in text if not unicodedata.combining(c)).casefold()
    return " ".join(re.sub(r"[_\-‐-―&+.]", " ", text).split())


def squeezed(text: str) -> str:
    """Letters and digits alone, without the word `and`: the string that distances are taken over."""
    return "".join(w for w in re.findall(r"[^\W_]+", text) if w != "and")


def is_short_for(short: str, word: str) -> bool:
    """Whether the letters of short come in this order in word, from its first on, as in `mgr` for `manager`."""
    if len(short) < 2 or len(short) >= len(word) or short[0] != word[0]:
        return False
    it = iter(word)
    return all(c in it for c in short)


def strip_words(words: list[str]) -> list[str]:
    while len(words) > 1 and words[0] in BEFORE:
        words = words[1:]
    while len(words) > 1 and words[-1] in AFTER:
        words = words[:-1]
    return words


def readings(value: str) -> list[str]:
    """Ways to read a typed value, the most literal first: as it is, without additions, with its parts turned round."""
    out = []
    text = unicodedata.normalize("NFKC", value)
    for base in (text, re.sub(r"\([^()]*\)|\[[^\[\]]*\]", " ", text)):
        bare = re.split(r"\s[-–—|@/•]\s|[|@•]", base)[0]
        for t in (base, bare):
            parts = [p for p in t.split(",") if p.strip()]
            forms = [t]
            if len(parts) > 1:
                forms += [parts[0], ", ".join(parts[:-1]), " ".join(reversed(parts))]
            for form in forms:
                words = plain(form).replace(",", " ").split()
                long = [SHORT.get(w, w) for w in words]
                for w in (words, long, strip_words(words), strip_words(long)):
                    joined = " ".join(w)
                    if joined and joined not in out:
                        out.append(joined)
    return out


#: From these numbers of letters on a reading may lie one and two edits from an entry. A shorter one must have an
#: entry's very letters: one edit makes many a short word into another one.
ONE_EDIT, TWO_EDITS = 5, 12


def radius(text: str) -> int:
    """Edits that a reading of this length may lie from an entry."""
    return (len(text) >= ONE_EDIT) + (len(text) >= TWO_EDITS)


class Matcher:
    """Finds the entry that a value of one field means."""

    def __init__(self, entries: Iterable[tuple[int, str]]):
        """entries: (canon_id, name or alias); of entries with the same letters the smallest id counts."""
        self.ids: dict[str, int] = {}
        self.words: set[str] = set()
        texts: dict[str, int] = {}
        for ident, name in sorted(entries, key=lambda e: e[0]):
            text = plain(name)
            self.words.update(text.split())
            texts.setdefault(text, ident)
            if squeezed(text):
                self.ids.setdefault(squeezed(text), ident)
        #: Entries by the first letters of their words, and every beginning of those letters.
        self.by_initials: dict[str, list[tuple[list[str], int]]] = {}
        self.beginnings = {""}
        for text, i in texts.items():
            letters = "".join(w[0] for w in text.split())
            self.by_initials.setdefault(letters, []).append((text.split(), i))
            self.beginnings.update(letters[:k] for k in range(1, len(letters) + 1))
        self.tree = BKTree(sorted(self.ids))
        self.longest = max(map(len, self.ids), default=0)

    def fits(self, words: list[str], entry: list[str], known: Collection[str]) -> bool:
        """Whether the words stand for the entry's words in order: the same, short for one, or initials of several.

        known has those of the words that the whole list has; they are short for nothing.
        """
        if not words or not entry:
            return not words and not entry
        w = words[0]
        if w == entry[0] or (w not in known and is_short_for(w, entry[0])):
            return self.fits(words[1:], entry[1:], known)
        initials = 1 < len(w) <= len(entry) and w == "".join(e[0] for e in entry[: len(w)])
        return initials and self.fits(words[1:], entry[len(w) :], known)

    def initials(self, words: list[str]) -> set[str]:
        """The first letters of entries that words may stand for: a word gives its first letter, or all its letters."""
        found = {""}
        for w in words:
            found = {x for f in found for x in (f + w[0], f + w) if x in self.beginnings}
        return found

    def shortened(self, reading: str, known: Collection[str]) -> set[int]:
        """The entries whose words a reading has in short; looked up by first letters, so few entries are compared."""
        words = reading.split()
        if len(words) < 2:
            return set()
        return {i for letters in self.initials(words) for entry, i in self.by_initials.get(letters, ()) if self.fits(words, entry, known)}

    def near(self, forms: list[str]) -> tuple[int, int, int] | None:
        """(cost, place of the reading, canon_id) of the best entry within the radius of one of the readings."""
        forms = [squeezed(r) for r in forms]
        for at, s in enumerate(forms):
            if s in self.ids:
                return 0, at, self.ids[s]
        best = None
        for at, s in enumerate(forms):
            most = radius(s)
            if not most or len(s) > self.longest + most:
                continue  # no entry can be that near
            for _, entry in self.tree.within(s, most + 1):  # an exchange is two edits for the tree's metric
                d = swaps(s, entry)
                if d <= most and (best is None or (d, at, self.ids[entry]) < best):
                    best = d, at, self.ids[entry]
        return best

    def find(self, value: str) -> tuple[int, int]:
        """(cost, canon_id) of the entry meant, -1 if there is none.

        Readings with an entry's very letters come first. Then the tree gives every entry within the radius of a
        reading; the fewest edits win, an exchange of neighbours counting as one, then the more literal reading, then
        the smaller id. Readings that no entry is near may still have the words of one entry alone in short.
        """
        forms = readings(value)
        best = self.near(forms)
        if best:
            return best[0], best[2]
        for r in forms:
            hits = self.shortened(r, self.words)
            if len(hits) == 1:
                return 3, hits.pop()
        return 99, -1


def match_values(values: DataFrame, reference: DataFrame, *, broadcast_entries: int = BROADCAST_ENTRIES, shard_entries: int = SHARD_ENTRIES) -> DataFrame:
    """(field_name, value, canon_id): the entry each distinct value means, -1 if the list has none.

    values: (field_name, value), distinct; reference: (field_name, canon_id, name), names and aliases. The list is counted
    first. Up to broadcast_entries entries go to every task, which builds one tree a field. A longer list is cut into
    shards of about shard_entries; every value meets every shard of its field in blocks, and the shards' winners merge
    by fewest edits, then the more literal reading, then smallest id. Values that no shard has anything near for meet the
    shards again, with those of their words that the whole list has: a reading counts if all shards together have one
    entry for it. Null and empty values are not matched (canon_id -1).
    """
    spark = values.sparkSession
    ship(spark)
    entries = reference.where("name is not null and canon_id is not null").select("field_name", F.col("canon_id").cast("long").alias("canon_id"), "name").distinct()
    held = entries.limit(broadcast_entries + 1).collect()  # bounded: only to tell whether the list is small
    pair_type = "field_name string, value string, "
    place_type = pair_type + "cost int, place int, canon_id long"

    def batch_of(columns: dict[str, tuple[list, pa.DataType]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in columns.values()], names=list(columns))

    def pairs(fields, texts) -> dict[str, tuple[list, pa.DataType]]:
        return {"field_name": (fields, pa.string()), "value": (texts, pa.string())}

    def places(fields, texts, found) -> pa.RecordBatch:
        """found: (cost, place, canon_id) of each."""
        return batch_of(pairs(fields, texts) | {"cost": ([x[0] for x in found], pa.int32()), "place": ([x[1] for x in found], pa.int32()), "canon_id": ([x[2] for x in found], pa.int64())})

    def matchers_of(rows) -> dict[str, Matcher]:
        by: dict[str, list] = {}
        for field, ident, name in rows:
            by.setdefault(field, []).append((ident, name))
        return {f: Matcher(e) for f, e in by.items()}

    if len(held) <= broadcast_entries:
        rows = spark.sparkContext.broadcast([tuple(r) for r in held])

        def find(batches):
            matchers = matchers_of(rows.value)
            for batch in batches:
                fields, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                found = [matchers[f].find(v)[1] if f in matchers and v else -1 for f, v in zip(fields, texts)]
                yield batch_of(pairs(fields, texts) | {"canon_id": (found, pa.int64())})

        return values.select("field_name", "value").mapInArrow(find, pair_type + "canon_id long")

    def with_text(batches):
        for b in batches:
            yield b.append_column("text", pa.array([plain(n) for n in b["name"].to_pylist()], pa.string()))

    def words_of(batches):
        for b in batches:
            rows = [(f, v, w) for f, v in zip(b["field_name"].to_pylist(), b["value"].to_pylist()) for w in sorted({w for r in readings(v) for w in r.split()})]
            yield batch_of(pairs([r[0] for r in rows], [r[1] for r in rows]) | {"word": ([r[2] for r in rows], pa.string())})

    def near(v: pa.Table, e: pa.Table) -> pa.Table:
        matchers = matchers_of(zip(*(e[c].to_pylist() for c in ("field_name", "canon_id", "name"))))
        fields, texts = v["field_name"].to_pylist(), v["value"].to_pylist()
        found = [(matchers[f].near(readings(t)) if f in matchers and t else None) or (99, 0, -1) for f, t in zip(fields, texts)]
        return pa.Table.from_batches([places(fields, texts, found)])

    def shortened(v: pa.Table, e: pa.Table) -> pa.Table:
        """At most two entries for a reading: that is enough to tell that it isn't one alone."""
        matchers = matchers_of(zip(*(e[c].to_pylist() for c in ("field_name", "canon_id", "name"))))
        rows = []
        for f, t, known in zip(*(v[c].to_pylist() for c in ("field_name", "value", "known"))):
            if f in matchers:
                known = set(known)
                rows += [(f, t, (3, at, i)) for at, r in enumerate(readings(t)) for i in sorted(matchers[f].shortened(r, known))[:2]]
        return pa.Table.from_batches([places([r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows])])

    shards = -(-entries.count() // shard_entries)
    blocks = max(1, values.count() // 20_000)
    # names that read the same stand in the same shard: of those the smallest id counts
    listed = entries.mapInArrow(with_text, "field_name string, canon_id long, name string, text string")
    sharded = listed.select("field_name", "canon_id", "name", F.pmod(F.xxhash64("text"), F.lit(shards)).cast("int").alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    key = F.pmod(F.xxhash64("value"), F.lit(blocks)).cast("int").alias("block")

    def meet(left: DataFrame, f) -> DataFrame:
        left = left.select("*", key, F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
        return left.groupBy("shard", "block").cogroup(sharded.groupBy("shard", "block")).applyInArrow(f, place_type)

    def first(found: DataFrame) -> DataFrame:
        return found.groupBy("field_name", "value").agg(F.min(F.struct("cost", "place", "canon_id")).alias("b")).select("field_name", "value", "b.*")

    best = settle(first(meet(values.select("field_name", "value"), near)))
    asked = best.where("cost = 99 and value <> ''").select("field_name", "value").mapInArrow(words_of, pair_type + "word string")
    words = listed.select(F.col("field_name").alias("f"), F.explode(F.split("text", " ")).alias("w")).distinct()
    known = asked.join(words, F.col("field_name").eqNullSafe(F.col("f")) & (F.col("word") == F.col("w")), "left").groupBy("field_name", "value").agg(F.collect_set("w").alias("known"))
    hits = meet(known, shortened).groupBy("field_name", "value", "cost", "place").agg(F.min("canon_id").alias("canon_id"), F.max("canon_id").alias("other")).where("canon_id = other").drop("other")
    return first(best.unionByName(hits)).select("field_name", "value", "canon_id")


def assign(rows: DataFrame, reference: DataFrame, **options) -> DataFrame:
    """(field_name, row_id, canon_id) for rows (field_name, row_id, value).

    Each distinct value is matched once, however many rows have it, and joined back. Null and empty values, and values
    that are exactly a canonical name of their field, are left out. reference: (field_name, canon_id, canonical_name,
    aliases). Repeated rows give one row for each entry.
    """
    names = reference.select("field_name", "canon_id", F.explode(F.concat(F.array("canonical_name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("name"))
    exact = reference.select("field_name", F.col("canonical_name").alias("value")).distinct()
    typed = rows.where("value is not null and value <> ''").join(exact, ["field_name", "value"], "left_anti")
    values = typed.select("field_name", "value").distinct()
    # by another key than the distinct's own, else the planner drops this exchange and folds all values into one task
    spread = values.repartition(shuffle_partitions(rows.sparkSession), F.xxhash64("value"))
    found = match_values(spread, names, **options)
    return typed.join(found, ["field_name", "value"]).select("field_name", "row_id", "canon_id").distinct()
