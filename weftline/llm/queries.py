"""Queries of the operators for training data, and SQL where it can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import canonical, frequency, packing, spam, tokens, variants
from weftline.plans.runtime import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def term_tables(spark: SparkSession, d: str) -> list[tuple[DataFrame, str, dict[str, str]]]:
    return [
        (table(spark, d, "persons"), "id", {"persons.skills": "skills", "persons.industry": "industry"}),
        (table(spark, d, "roles"), "id", {"roles.role_title": "role_title"}),
    ]


@query
def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return frequency.term_frequencies(term_tables(spark, d)).where("mark is not null").select("field_name", "term", "mark")


@query
def p1_term_frequencies(spark: SparkSession, d: str) -> DataFrame:
    return frequency.term_frequencies(term_tables(spark, d))


TERMS = r"""
with raw as (
  select 'persons.skills' field_name, id, unnest(skills) v from persons
  union all select 'persons.industry', id, industry from persons
  union all select 'roles.role_title', id, role_title from roles),
terms as (select field_name, id, trim(regexp_replace(lower(v), '\s+', ' ', 'g')) term from raw),
n as (select field_name, term, count(*) occurrences, count(distinct id) records from terms where term <> '' group by all),
ids as (select 'persons' t, count(distinct id) ids from persons union all select 'roles', count(distinct id) from roles),
marked as (select n.*, case when records <= 2 then 'rare' when records > 0.08 * ids then 'common' end mark
  from n join ids on t = split_part(field_name, '.', 1))
"""
SQL["p1_found"] = TERMS + "select field_name, term, mark from marked where mark is not null"
SQL["p1_term_frequencies"] = TERMS + "select field_name, term, cast(occurrences as bigint) occurrences, records, mark from marked"


def named_tables(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    orgs = table(spark, d, "organizations").select(F.col("forager_id").alias("id"), "name")
    roles = table(spark, d, "roles").select("id", "organization_id", F.col("organization_name").alias("name"))
    return orgs, roles, table(spark, d, "persons").select("id", "first_name", "last_name", "country")


@query
def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return variants.linked(*named_tables(spark, d))


@query
def p4_members(spark: SparkSession, d: str) -> DataFrame:
    """The class of every organization, person, and role without an organization id."""
    return variants.members(*named_tables(spark, d))


def typed_values(spark: SparkSession, d: str) -> DataFrame:
    persons, roles = table(spark, d, "persons"), table(spark, d, "roles")
    of = lambda t, name, column: t.select(F.lit(name).alias("field_name"), F.col("id").alias("row_id"), F.col(column).alias("value"))
    return of(persons, "persons.city", "city").unionByName(of(persons, "persons.industry", "industry")).unionByName(of(roles, "roles.role_title", "role_title"))


@query
def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return canonical.assign(typed_values(spark, d), table(spark, d, "canonical_values"))


@query
def p6_values(spark: SparkSession, d: str) -> DataFrame:
    """The entry of each distinct typed value, and how many rows have it; -1 reports the unmatched ones."""
    names = table(spark, d, "canonical_values").select("field_name", "canon_id", F.explode(F.concat(F.array("canonical_name"), "aliases")).alias("name"))
    counts = typed_values(spark, d).where("value <> ''").groupBy("field_name", "value").agg(F.count(F.lit(1)).alias("rows"))
    return counts.join(canonical.match_values(counts.select("field_name", "value"), names), ["field_name", "value"])


@query
def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode_texts(table(spark, d, "documents"))


@query
def p9_containers(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill_containers(table(spark, d, "documents"), 2048)


@query
def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return spam.spam_scores(table(spark, d, "documents")).where("score > 0.5").select("doc_id")


@query
def p10_scores(spark: SparkSession, d: str) -> DataFrame:
    return spam.spam_scores(table(spark, d, "documents"))
