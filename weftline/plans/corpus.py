"""Queries of the core's operators for training data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions.instants import feed_instant
from weftline.operators import hotkeys, nested, orphans, rejects
from weftline.plans.registry import QUERIES, SQL, Query, query
from weftline.plans.runtime import table

HOT_SHARE = 0.02


@query
def p2_found(spark: SparkSession, d: str) -> DataFrame:
    roles, orgs = table(spark, d, "roles"), table(spark, d, "organizations")
    joined = hotkeys.with_share(hotkeys.eager_join(roles, orgs, "organization_id", "forager_id"), HOT_SHARE)
    return joined.where("dominates").select(F.col("key").alias("organization_id"))


SQL["p2_found"] = "select organization_id from roles where organization_id is not null group by 1 having count(*) > 0.02 * (select count(*) from roles)"


@query
def p2_organizations(spark: SparkSession, d: str) -> DataFrame:
    """Complete results of every organization_id, null included, over the join with all deliveries of organizations."""
    roles, orgs = table(spark, d, "roles"), table(spark, d, "organizations")
    people = roles.select("organization_id", "person_id").distinct().groupBy("organization_id").agg(F.count("person_id").alias("persons"))
    joined = hotkeys.eager_join(
        roles, orgs, "organization_id", "forager_id", left_sums={"role_linkedin_sum": F.col("linkedin_id").cast("decimal(38,0)")}, right_sums={"employees_sum": F.col("employees_number").cast("decimal(38,0)")}, left_states={"first_start": F.min("start_date"), "last_start": F.max("start_date")}
    )
    joined = hotkeys.with_share(joined, HOT_SHARE).withColumnRenamed("key", "organization_id")
    joined = joined.join(people.withColumnRenamed("organization_id", "k"), F.col("organization_id").eqNullSafe(F.col("k"))).drop("k", "share")
    return joined.withColumns({c: F.col(c).cast("string") for c in ("role_linkedin_sum", "employees_sum")})


SQL["p2_organizations"] = """
with l as (select organization_id, count(*) left_rows, min(start_date) first_start, max(start_date) last_start, count(distinct person_id) persons from roles group by 1),
j as (select r.organization_id, count(*) n, sum(r.linkedin_id::hugeint) a, sum(o.employees_number::hugeint) b
  from roles r join organizations o on o.forager_id = r.organization_id group by 1),
r as (select forager_id, count(*) n from organizations group by 1)
select l.organization_id, left_rows, coalesce(r.n, 0) right_rows, coalesce(j.n, 0) joined_rows, cast(coalesce(a, 0) as varchar) role_linkedin_sum,
  cast(coalesce(b, 0) as varchar) employees_sum, first_start, last_start, l.organization_id is not null and left_rows > 0.02 * (select count(*) from roles) dominates, persons
from l left join j using (organization_id) left join r on r.forager_id = l.organization_id"""


@query
def p2_industries(spark: SparkSession, d: str) -> DataFrame:
    """The join of roles and organizations rolled up by industry."""
    joined = hotkeys.eager_join(table(spark, d, "roles"), table(spark, d, "organizations"), "organization_id", "forager_id", right_sums={"employees_sum": F.col("employees_number")}, right_also=("industry",))
    return hotkeys.roll_up(joined, "industry", ("employees_sum",))


SQL["p2_industries"] = "select industry, count(*) joined_rows, cast(coalesce(sum(employees_number), 0) as bigint) employees_sum from roles join organizations on forager_id = organization_id group by 1"


@query
def p3_found(spark: SparkSession, d: str) -> DataFrame:
    nodes = nested.node_table(table(spark, d, "persons"), "id", ("serialized_data",), payload=False)
    return nodes.select(F.col("id").alias("person_id"), "child", "parent_pos", "pos").distinct()


@query
def p3_nodes(spark: SparkSession, d: str) -> DataFrame:
    """All node tables in one, with interval labels and the objects' own fields."""
    return nested.node_table(table(spark, d, "persons"), "id", ("serialized_data",))


#: The flat child tables: path of the nodes, and their own fields.
CHILD_TABLES = {
    "p3_roles": ("roles", "id long, linkedin_id long, organization_id long, role_title string, organization_name string, employment_type string, start_date string, end_date string, date_updated string"),
    "p3_organizations": ("organizations", "forager_id long, name string, domain string, industry string"),
    "p3_addresses": ("organizations.addresses", "city string, country string, postcode string, state string, street_name string, is_headquarter boolean"),
    "p3_funding_rounds": ("organizations.funding_rounds", "date_featured string, funding_type string, funding_total long"),
    "p3_educations": ("educations", "school_name string, degree string, field_of_study string, start_date string"),
    "p3_certifications": ("certifications", "name string, authority string"),
    "p3_languages": ("languages", "name string, proficiency string"),
    "p3_patents": ("patents", "title string, summary string, url string"),
    "p3_inventors": ("patents.linkedin_inventors", "person_id long, name string"),
    "p3_publications": ("publications", "title string, summary string, url string"),
    "p3_authors": ("publications.linkedin_authors", "person_id long, name string"),
    "p3_projects": ("projects", "title string, summary string, url string"),
    "p3_contributors": ("projects.linkedin_contributors", "person_id long, name string"),
}
TYPED = {"roles": (), "organizations": ("addresses", "funding_rounds")}


def child_query(path: str, fields: str) -> Query:
    """One flat child table, each row leading to its person and its parent element; of a typed column only that is read."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        top = path.split(".")[0]
        persons = table(spark, d, "persons").select("id", top if top in TYPED else "serialized_data")
        nodes = nested.node_table(persons, "id", () if top in TYPED else ("serialized_data",)).withColumnRenamed("id", "holder_id")
        return nested.child_table(nodes, path, fields).drop("delivery", "pre", "post", "level").distinct()

    return run


for _name, (_path, _fields) in CHILD_TABLES.items():
    QUERIES[_name] = child_query(_path, _fields)
for _top, _below in TYPED.items():
    _names = ", ".join(f"e.{f.split()[0]}" for f in CHILD_TABLES[f"p3_{_top}"][1].split(", "))
    SQL[f"p3_{_top}"] = f"select distinct holder_id, -1 parent_pos, cast(n - 1 as int) pos, {_names} from (select id holder_id, unnest({_top}) e, generate_subscripts({_top}, 1) n from persons) where e is not null"
    for _b in _below:
        _names = ", ".join(f"c.{f.split()[0]}" for f in CHILD_TABLES[f"p3_{_b}"][1].split(", "))
        SQL[f"p3_{_b}"] = f"""
select distinct holder_id, cast(n - 1 as int) parent_pos, cast(m - 1 as int) pos, {_names}
from (select holder_id, n, unnest(e.{_b}) c, generate_subscripts(e.{_b}, 1) m
  from (select id holder_id, unnest({_top}) e, generate_subscripts({_top}, 1) n from persons) where e is not null) where c is not null"""


def references(spark: SparkSession, d: str) -> DataFrame:
    roles, persons = table(spark, d, "roles"), table(spark, d, "persons")
    a = roles.select(F.lit("roles").alias("source_table"), F.col("id").alias("row_id"), F.col("organization_id").alias("key"), feed_instant(F.col("date_updated")).alias("at"))
    b = persons.select(F.lit("persons").alias("source_table"), F.col("id").alias("row_id"), F.explode_outer("unresolved_organization_ids").alias("key"), feed_instant(F.col("date_updated")).alias("at"))
    return a.unionByName(b)


def orphan_rows(spark: SparkSession, d: str) -> DataFrame:
    parents = table(spark, d, "organizations").select(F.col("forager_id").alias("key"), feed_instant(F.col("date_updated")).alias("at"))
    removals = table(spark, d, "organization_removals").select(F.col("organization_id").alias("key"), "removed_at")
    return orphans.orphans(references(spark, d), parents, removals).withColumnsRenamed({"key": "organization_id", "period": "ref_month"})


@query
def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return orphan_rows(spark, d)


@query
def p5_report(spark: SparkSession, d: str) -> DataFrame:
    """Orphan references by table and month."""
    return orphan_rows(spark, d).groupBy("source_table", "ref_month").agg(F.count(F.lit(1)).alias("orphans"), F.countDistinct("organization_id").alias("organizations"))


ORPHANS = r"""
with inst as (select 'o' t, forager_id id, cast(null as varchar) k, null::bigint org, date_updated du from organizations
  union all select 'r', id, 'roles', organization_id, date_updated from roles
  union all select 'r', id, 'persons', unnest(coalesce(nullif(unresolved_organization_ids, []), [null])), date_updated from persons),
ts as (select t, id, k, org, cast(regexp_replace(du, ' (Z|[+-]\d\d)(\d\d)?$', '\1') as timestamptz)
  - case when du ~ '[+-]\d{4}$' then to_minutes(cast(right(du, 5)[1] || right(du, 2) as int)) else to_minutes(0) end at_ from inst),
o as (select id, min(at_) f, max(at_) l from ts where t = 'o' group by 1),
rm as (select organization_id, max(removed_at) r from organization_removals group by 1),
w as (select distinct k, id, org, max(at_) over (partition by k, id) at_ from ts where t = 'r'),
found as (select k source_table, w.id row_id, org organization_id, strftime(at_ at time zone 'UTC', '%Y-%m') ref_month
  from w left join o on o.id = org left join rm on rm.organization_id = org
  where org is not null and (o.id is null or r >= l or f > at_))
"""
SQL["p5_found"] = ORPHANS + "select * from found"
SQL["p5_report"] = ORPHANS + "select source_table, ref_month, count(*) orphans, count(distinct organization_id) organizations from found group by 1, 2"


@query
def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return rejects.load_lines(table(spark, d, "feed_lines")).where("reason is not null").select("feed_file", "line_no")


@query
def p7_loaded(spark: SparkSession, d: str) -> DataFrame:
    """The lines that load."""
    return rejects.load_lines(table(spark, d, "feed_lines")).where("reason is null").drop("reason", "cell")


@query
def p7_reasons(spark: SparkSession, d: str) -> DataFrame:
    """How many lines of each file fail, by cell and reason."""
    return rejects.load_lines(table(spark, d, "feed_lines")).where("reason is not null").groupBy("feed_file", "cell", "reason").agg(F.count(F.lit(1)).alias("lines"))
