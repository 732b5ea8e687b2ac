"""The query surface on documents: exact terms, tokens, ids and counts over a declared search schema."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

IGNORE_ABOVE = 8191


@dataclass(frozen=True)
class Field:
    """How a field may be searched: by exact term, by token; values longer than ignore_above never match a term."""

    kind: str
    term: bool = True
    match: bool = False
    ignore_above: int | None = None


text = Field("text", True, True, IGNORE_ABOVE)
long = Field("long")
#: The person index: every searchable field of an enriched document.
SCHEMA = {
    "forager_id": long, "first_name": text, "last_name": text, "headline": Field("text", False, True), "country": Field("keyword"),
    "city": Field("keyword", ignore_above=IGNORE_ABOVE), "industry": Field("keyword", ignore_above=IGNORE_ABOVE), "skills": Field("keyword", ignore_above=IGNORE_ABOVE),
    "has_unresolved_organizations": Field("boolean"), "unresolved_organization_ids": long, "linkedin_id": Field("long", False),
    "roles.id": Field("long", False), "roles.role_title": text, "roles.organization_id": long, "roles.organization_name": text, "roles.organization_unresolved": Field("boolean"),
    "organizations.forager_id": long, "organizations.name": text, "organizations.linkedin_id": Field("long", False),
}


def tokens(value: Column) -> Column:
    """The lower-case runs of letters and digits of a text."""
    return F.filter(F.split(F.lower(value), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def any_value(docs: DataFrame, path: str, holds) -> Column:
    """Whether a value at the path satisfies a condition, in any element where the path passes an array; never null."""
    head, _, rest = path.partition(".")
    is_array = docs.schema[head].dataType.typeName() == "array"
    value = F.col(head)
    found = F.exists(value, lambda x: F.coalesce(holds(x[rest] if rest else x), F.lit(False))) if is_array else holds(value[rest] if rest else value)
    return F.coalesce(found, F.lit(False))


def term(docs: DataFrame, path: str, value, schema: dict[str, Field] = SCHEMA) -> Column:
    """The document holds exactly this value. Conditions on two fields of an array may meet in different elements."""
    field = schema.get(path)
    if field is None or not field.term:
        raise ValueError(f"{path} can't be searched by term")
    if field.ignore_above is None:
        return any_value(docs, path, lambda x: x == F.lit(value))
    return any_value(docs, path, lambda x: (x == F.lit(value)) & (F.length(x) <= field.ignore_above))


def match(docs: DataFrame, path: str, query: str, schema: dict[str, Field] = SCHEMA) -> Column:
    """The text holds a token of the query."""
    field = schema.get(path)
    if field is None or not field.match:
        raise ValueError(f"{path} can't be searched by token")
    wanted = [t for t in re.split(r"[\W_]+", query.lower()) if t]
    return any_value(docs, path, lambda x: F.arrays_overlap(tokens(x), F.array(*map(F.lit, wanted)) if wanted else F.array().cast("array<string>")))


def count(docs: DataFrame, condition: Column | None = None) -> DataFrame:
    """One row: how many documents there are or satisfy the condition."""
    return (docs if condition is None else docs.where(condition)).agg(F.count(F.lit(1)).alias("n"))


def mget(docs: DataFrame, id_col: str, ids: list) -> DataFrame:
    """The documents with these ids."""
    return docs.where(F.col(id_col).isin(*ids))


def keyword_counts(docs: DataFrame, id_col: str, path: str) -> DataFrame:
    """(value, docs): how many documents hold each value of a field, each counted once."""
    head, _, rest = path.partition(".")
    if docs.schema[head].dataType.typeName() == "array":
        values = F.array_distinct(F.transform(head, lambda x: x[rest])) if rest else F.array_distinct(head)
        rows = docs.select(id_col, F.explode(values).alias("value"))
    else:
        rows = docs.select(id_col, F.col(path).alias("value"))
    return rows.where("value is not null").groupBy("value").agg(F.countDistinct(id_col).alias("docs"))
