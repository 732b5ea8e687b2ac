"""Queries of the feed engine's own operators, over the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions.instants import feed_instant
from weftline.operators import audit, checks, nested, sample, search
from weftline.operators.enrich import enrich, resolve, totals
from weftline.plans.registry import SQL, query
from weftline.plans.runtime import table, utc
from weftline.sources import feeds

#: lineitem rows have no unique key; this order is total on distinct rows.
LINE = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate", "l_discount", "l_tax", "l_returnflag", "l_linestatus")


def order_roles(spark: SparkSession, d: str) -> DataFrame:
    """Orders with their lineitems as an ordered array of roles; some references are null."""
    l = table(spark, d, "lineitem")
    ref = F.when(~((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1)), F.col("l_partkey"))
    item = F.struct(*LINE, ref.alias("ref"), F.col("l_returnflag").alias("title"))
    roles = l.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(item)).alias("roles")).withColumnRenamed("l_orderkey", "o_orderkey")
    slim = F.transform("roles", lambda r: F.struct(r["ref"].alias("ref"), r["title"].alias("title"), r["l_suppkey"].alias("supp")))
    return table(spark, d, "orders").select("o_orderkey", "o_orderpriority").join(roles, "o_orderkey", "left").select("o_orderkey", "o_orderpriority", slim.alias("roles"))


def enriched_orders(spark: SparkSession, d: str) -> DataFrame:
    parts = table(spark, d, "part").where("p_partkey % 50 <> 7").select("p_partkey", "p_name", "p_brand")
    return enrich(order_roles(spark, d), parts, id_col="o_orderkey", ref="ref", lookup_id="p_partkey")


def ids(column) -> Column:
    return F.array_join(F.transform(column, lambda x: x.cast("string")), ",")


@query
def enrich_orders(spark: SparkSession, d: str) -> DataFrame:
    e = enriched_orders(spark, d)
    return e.select("o_orderkey", "n_roles", "n_resolved", "n_unresolved", ids(F.transform("organizations", lambda o: o["p_partkey"])).alias("resolved_ids"), ids("unresolved_organization_ids").alias("unresolved_ids"), F.array_join(F.transform("organizations", lambda o: o["p_name"]), "|").alias("names"), "has_unresolved_organizations")


ROLES = """
with line as (select l_orderkey, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate, l_discount, l_tax, l_returnflag, l_linestatus) pos,
    case when not (l_returnflag = 'R' and l_linenumber = 1) then l_partkey end ref, l_returnflag title, l_suppkey supp from lineitem),
org as (select p_partkey, p_name, p_brand from part where p_partkey % 50 <> 7),
r as (select line.*, p_partkey is not null hit, ref is not null and p_partkey is null bad, p_name from line left join org on p_partkey = ref),
f as (select l_orderkey, ref, hit, p_name, min(pos) pos from r where ref is not null group by all),
ids as (select l_orderkey, string_agg(ref, ',' order by pos) filter (hit) res, string_agg(ref, ',' order by pos) filter (not hit) unres, string_agg(p_name, '|' order by pos) filter (hit) names from f group by 1),
n as (select l_orderkey, count(*) roles, count(*) filter (hit) resolved, count(*) filter (bad) unresolved from r group by 1),
e as (select o_orderkey, cast(coalesce(roles, 0) as int) n_roles, cast(coalesce(resolved, 0) as int) n_resolved, cast(coalesce(unresolved, 0) as int) n_unresolved,
    coalesce(res, '') resolved_ids, coalesce(unres, '') unresolved_ids, coalesce(names, '') names, coalesce(unresolved, 0) > 0 has_unresolved_organizations
  from orders left join n on n.l_orderkey = o_orderkey left join ids on ids.l_orderkey = o_orderkey)
"""
SQL["enrich_orders"] = ROLES + "select * from e"


@query
def enrich_role_flags(spark: SparkSession, d: str) -> DataFrame:
    r = enriched_orders(spark, d).select("o_orderkey", F.posexplode("roles").alias("pos", "r"))
    return r.select("o_orderkey", "pos", F.col("r.ref").alias("ref"), F.col("r.organization_unresolved").alias("organization_unresolved"))


SQL["enrich_role_flags"] = ROLES + "select l_orderkey o_orderkey, cast(pos - 1 as int) pos, ref, bad organization_unresolved from r join orders on o_orderkey = l_orderkey"


@query
def enrich_suppliers_dedup(spark: SparkSession, d: str) -> DataFrame:
    """First-occurrence order of repeated references."""
    r = order_roles(spark, d).select(F.col("o_orderkey").alias("entity"), F.posexplode(F.transform("roles", lambda x: x["supp"])).alias("pos", "ref"))
    return resolve(r, table(spark, d, "supplier").where("s_suppkey % 7 <> 0").select(F.col("s_suppkey").alias("ref"))).select("entity", ids("resolved").alias("resolved"), ids("unresolved").alias("unresolved"))


SQL["enrich_suppliers_dedup"] = ROLES + """, g as (select l_orderkey, supp, min(pos) pos from line join orders on o_orderkey = l_orderkey group by all)
select l_orderkey entity, coalesce(string_agg(supp, ',' order by pos) filter (supp % 7 <> 0), '') resolved, coalesce(string_agg(supp, ',' order by pos) filter (supp % 7 = 0), '') unresolved from g group by 1"""


def latest_persons(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "persons").select("id", "country", "city", "skills", "first_name", "headline", "date_updated", F.transform("roles", lambda r: F.struct(r["organization_id"].alias("organization_id"), r["role_title"].alias("role_title"), r["organization_name"].alias("organization_name"))).alias("roles"))
    return checks.last_wins(p.withColumn("at", feed_instant(F.col("date_updated"))), "id", F.col("at"), F.coalesce("headline", F.lit("")))


def latest_organizations(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "organizations").select("forager_id", "name", "industry", "domain", "date_updated")
    return checks.last_wins(o.withColumn("at", feed_instant(F.col("date_updated"))), "forager_id", F.col("at"), F.coalesce("name", F.lit(""))).select("forager_id", "name", "industry", "domain")


def enriched_persons(spark: SparkSession, d: str) -> DataFrame:
    return enrich(latest_persons(spark, d), latest_organizations(spark, d))


@query
def enrich_persons(spark: SparkSession, d: str) -> DataFrame:
    """The flagship on the feeds' own shape: persons with their roles' organizations embedded."""
    e = enriched_persons(spark, d)
    return e.select("id", "n_roles", "n_resolved", "n_unresolved", ids(F.transform("organizations", lambda o: o["forager_id"])).alias("resolved_ids"), F.array_join(F.transform("organizations", lambda o: F.coalesce(o["name"], F.lit("-"))), "|").alias("names"), ids("unresolved_organization_ids").alias("unresolved_ids"), "has_unresolved_organizations")


PERSONS = r"""
with inst as (select 'o' k, forager_id id, name tie, date_updated du, name, null::struct(organization_id bigint, role_title varchar, organization_name varchar)[] roles from organizations
  union all select 'p', id, headline, date_updated, null, [struct_pack(organization_id := x.organization_id, role_title := x.role_title, organization_name := x.organization_name) for x in roles] from persons),
ts as (select *, cast(regexp_replace(du, ' (Z|[+-]\d\d)(\d\d)?$', '\1') as timestamptz)
  - case when du ~ '[+-]\d{4}$' then to_minutes(cast(right(du, 5)[1] || right(du, 2) as int)) else to_minutes(0) end at_ from inst),
one as (select *, row_number() over (partition by k, id order by at_ desc nulls last, coalesce(tie, '') desc) rn from ts),
org as (select id, name from one where k = 'o' and rn = 1),
p as (select id, roles from one where k = 'p' and rn = 1),
r0 as (select id, unnest(roles) x, generate_subscripts(roles, 1) pos from p),
r as (select r0.id, pos, x.organization_id ref, x.role_title title, x.organization_name oname, org.id is not null hit, x.organization_id is not null and org.id is null bad, org.name from r0 left join org on org.id = x.organization_id),
f as (select id, ref, hit, name, min(pos) pos from r where ref is not null group by all),
i as (select id, string_agg(ref, ',' order by pos) filter (hit) res, string_agg(coalesce(name, '-'), '|' order by pos) filter (hit) names, string_agg(ref, ',' order by pos) filter (not hit) unres from f group by 1),
n as (select id, count(*) roles, count(*) filter (hit) resolved, count(*) filter (bad) unresolved from r group by 1),
e as (select p.id, cast(coalesce(n.roles, 0) as int) n_roles, cast(coalesce(resolved, 0) as int) n_resolved, cast(coalesce(unresolved, 0) as int) n_unresolved, coalesce(res, '') resolved_ids,
  coalesce(names, '') names, coalesce(unres, '') unresolved_ids, coalesce(unresolved, 0) > 0 has_unresolved_organizations from p left join n on n.id = p.id left join i on i.id = p.id)
"""
SQL["enrich_persons"] = PERSONS + "select * from e"


@query
def run_metrics(spark: SparkSession, d: str) -> DataFrame:
    return totals(enriched_persons(spark, d)).withColumn("unresolved_percent", F.round("unresolved_percent", 6))


SQL["run_metrics"] = PERSONS + """select count(*) persons, cast(sum(n_roles) as bigint) roles, cast(sum(n_resolved) as bigint) resolved_org_refs, cast(sum(n_unresolved) as bigint) unresolved_org_refs,
  cast(count(*) filter (n_unresolved > 0) as bigint) persons_with_unresolved_orgs, round(100.0::double * sum(n_unresolved) / greatest(1, sum(n_roles)), 6) unresolved_percent from e"""


@query
def count_all(spark: SparkSession, d: str) -> DataFrame:
    return search.count(table(spark, d, "orders"))


SQL["count_all"] = "select count(*) n from orders"


@query
def count_role_title(spark: SparkSession, d: str) -> DataFrame:
    p = latest_persons(spark, d)
    return search.count(p, search.term(p, "roles.role_title", "Project Manager"))


SQL["count_role_title"] = PERSONS + "select count(distinct id) n from r where title = 'Project Manager'"
NAME = "Kimoku Nafasta Foods Group"


@query
def count_joined_org_name(spark: SparkSession, d: str) -> DataFrame:
    e = enriched_persons(spark, d)
    return search.count(e, search.term(e, "organizations.name", NAME))


SQL["count_joined_org_name"] = PERSONS + f"select count(distinct id) n from r where hit and name = '{NAME}'"


@query
def count_role_org_name(spark: SparkSession, d: str) -> DataFrame:
    """By the roles' own name of the organization, which is not the joined one."""
    p = latest_persons(spark, d)
    return search.count(p, search.term(p, "roles.organization_name", NAME))


SQL["count_role_org_name"] = PERSONS + f"select count(distinct id) n from r where oname = '{NAME}'"


@query
def count_unresolved(spark: SparkSession, d: str) -> DataFrame:
    e = enriched_persons(spark, d)
    return search.count(e, search.term(e, "has_unresolved_organizations", True))


SQL["count_unresolved"] = PERSONS + "select count(*) n from e where has_unresolved_organizations"


@query
def count_title_and_flag(spark: SparkSession, d: str) -> DataFrame:
    """Two conditions on an array of objects may hold in different elements."""
    e = enriched_persons(spark, d)
    return search.count(e, search.term(e, "roles.role_title", "Data Analyst") & search.term(e, "roles.organization_unresolved", True))


SQL["count_title_and_flag"] = PERSONS + "select count(*) n from (select id from r group by 1 having coalesce(bool_or(title = 'Data Analyst'), false) and bool_or(bad))"


@query
def mget_orders(spark: SparkSession, d: str) -> DataFrame:
    return search.mget(table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority"), "o_orderkey", [1, 2, 3, 7, 100, 1499, 10**12])


SQL["mget_orders"] = "select o_orderkey, o_orderstatus, o_orderpriority from orders where o_orderkey in (1, 2, 3, 7, 100, 1499, 1000000000000)"


@query
def keyword_ignore_above(spark: SparkSession, d: str) -> DataFrame:
    """Documents that an exact search for their own whole text finds: not those beyond the field's length limit."""
    docs = table(spark, d, "documents")
    return docs.where(search.term(docs, "text", F.col("text"), {"text": search.text})).select("doc_id")


SQL["keyword_ignore_above"] = "select doc_id from documents where length(text) <= 8191"


@query
def match_tokens(spark: SparkSession, d: str) -> DataFrame:
    p = latest_persons(spark, d)
    return p.where(search.match(p, "headline", "Nurse engineer")).select("id")


SQL["match_tokens"] = r"""
with one as (select id, headline, row_number() over (partition by id order by cast(regexp_replace(date_updated, ' Z$', '+00') as timestamptz) desc, coalesce(headline, '') desc) rn from persons)
select id from one where rn = 1 and list_has_any(regexp_split_to_array(lower(headline), '[^\p{L}\p{N}]+'), ['nurse', 'engineer'])"""


@query
def term_array_contains(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "persons")
    return p.where(search.term(p, "skills", "Communication")).select("id").distinct()


SQL["term_array_contains"] = "select distinct id from persons where list_contains(skills, 'Communication')"


@query
def keyword_agg(spark: SparkSession, d: str) -> DataFrame:
    """How many documents hold each keyword value."""
    p = latest_persons(spark, d)
    a = search.keyword_counts(p, "id", "country").withColumn("field", F.lit("country"))
    b = search.keyword_counts(p, "id", "roles.role_title").withColumn("field", F.lit("roles.role_title"))
    return a.unionByName(b)


SQL["keyword_agg"] = PERSONS + """, c as (select distinct id, country from persons where country is not null)
select 'country' field, country value, count(distinct id) docs from c group by all
union all select 'roles.role_title', title, count(distinct id) from r where title is not null group by all"""


@query
def dangling_ids(spark: SparkSession, d: str) -> DataFrame:
    return audit.dangling(table(spark, d, "roles"), "organization_id", table(spark, d, "organizations"), "forager_id")


SQL["dangling_ids"] = "select distinct organization_id from roles where organization_id not in (select forager_id from organizations)"


@query
def distinct_ref_counts(spark: SparkSession, d: str) -> DataFrame:
    return audit.reference_counts(table(spark, d, "roles"), "organization_id", table(spark, d, "organizations"), "forager_id")


SQL["distinct_ref_counts"] = """with a as (select distinct organization_id i from roles where organization_id is not null), b as (select distinct forager_id i from organizations)
select (select count(*) from b) known, (select count(*) from a) referenced, (select count(*) from (from a intersect from b)) resolved, (select count(*) from (from a except from b)) unresolved"""


@query
def semi_needed_orgs(spark: SparkSession, d: str) -> DataFrame:
    return latest_organizations(spark, d).join(table(spark, d, "roles").select(F.col("organization_id").alias("forager_id")), "forager_id", "left_semi").select("forager_id")


SQL["semi_needed_orgs"] = "select distinct forager_id from organizations where forager_id in (select organization_id from roles)"


@query
def duplicate_ids(spark: SparkSession, d: str) -> DataFrame:
    return checks.duplicates(table(spark, d, "lineitem"), "l_orderkey", "l_linenumber")


SQL["duplicate_ids"] = "select l_orderkey, l_linenumber, count(*) rows from lineitem group by all having count(*) > 1"


@query
def duplicate_counts(spark: SparkSession, d: str) -> DataFrame:
    return checks.surplus(table(spark, d, "persons"), "id").withColumn("feed", F.lit("persons")).unionByName(checks.surplus(table(spark, d, "organizations"), "forager_id").withColumn("feed", F.lit("organizations")))


SQL["duplicate_counts"] = """select count(*) rows, count(distinct id) keys, count(*) - count(distinct id) surplus, 'persons' feed from persons
union all select count(*), count(distinct forager_id), count(*) - count(distinct forager_id), 'organizations' from organizations"""


@query
def upsert_last_wins(spark: SparkSession, d: str) -> DataFrame:
    return checks.last_wins(table(spark, d, "events").select("user_id", "event_id", "ts", "event_type", "value"), "user_id", F.col("ts"), F.col("event_id"))


SQL["upsert_last_wins"] = "select user_id, event_id, ts, event_type, value from events qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1"


@query
def audit_presence(spark: SparkSession, d: str) -> DataFrame:
    return audit.presence(table(spark, d, "roles"))


ROLE_COLUMNS = "id person_id linkedin_id organization_id organization_linkedin_id role_title organization_name organization_domain organization_industry employment_type location start_date end_date date_updated fed_at".split()
SQL["audit_presence"] = " union all ".join(f"select '{c}' field, count({c}) filled, count(*) - count({c}) nulls from roles" for c in ROLE_COLUMNS)


@query
def audit_conditions(spark: SparkSession, d: str) -> DataFrame:
    """Persons with roles, with a dangling reference, with an organization they come with, and by title."""
    e = enriched_persons(spark, d).join(table(spark, d, "persons").groupBy("id").agg(F.max(F.coalesce(F.size("organizations"), F.lit(0)) > 0).alias("had")), "id")
    n = lambda c, name: F.count_if(c).alias(name)
    return e.agg(n(F.col("n_roles") > 0, "with_roles"), n(F.col("n_unresolved") > 0, "with_unresolved"), n(F.col("had"), "with_given_organizations"), n(search.term(e, "roles.role_title", "Accountant"), "accountants"))


SQL["audit_conditions"] = PERSONS + """select count(*) filter (n_roles > 0) with_roles, count(*) filter (n_unresolved > 0) with_unresolved,
  (select count(distinct id) from persons where len(organizations) > 0) with_given_organizations, (select count(distinct id) from r where title = 'Accountant') accountants from e"""


@query
def type_histogram(spark: SparkSession, d: str) -> DataFrame:
    return audit.type_histogram(table(spark, d, "events"), "props")


SQL["type_histogram"] = """with k as (select props, unnest(json_keys(props)) field from events where props is not null and json_type(props) = 'OBJECT')
select field, case json_type(props, '$.' || field) when 'UBIGINT' then 'integer' when 'BIGINT' then 'integer' when 'DOUBLE' then 'number' when 'VARCHAR' then 'string' when 'BOOLEAN' then 'boolean' when 'NULL' then 'null' else lower(json_type(props, '$.' || field)) end kind, count(*) n from k group by all"""


@query
def date_shape_histogram(spark: SparkSession, d: str) -> DataFrame:
    shapes = [table(spark, d, t).select(F.lit(f"{t}.{c}").alias("field"), audit.date_shape(F.col(c)).alias("shape")) for t, c in (("roles", "date_updated"), ("roles", "start_date"), ("roles", "end_date"), ("organizations", "date_updated"), ("organizations", "founded_date"))]
    out = shapes[0]
    for s in shapes[1:]:
        out = out.unionByName(s)
    return out.groupBy("field", "shape").agg(F.count(F.lit(1)).alias("n"))


def shape_sql(t: str, c: str) -> str:
    return f"""select '{t}.{c}' field, case when {c} is null then 'null' when {c} = '' then 'empty'
  when regexp_full_match({c}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}} [0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}[.][0-9]+ Z') then 'datetime Z'
  when regexp_full_match({c}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}} [0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}[.][0-9]+ [+-][0-9]{{4}}') then 'datetime offset'
  when regexp_full_match({c}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}} [0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}( .*)?') then 'datetime without fraction'
  when regexp_full_match({c}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}T.*') then 'iso datetime' when regexp_full_match({c}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') then 'date'
  when regexp_full_match({c}, '[0-9]{{4}}-[0-9]{{2}}') then 'year and month' when regexp_full_match({c}, '[0-9]{{4}}') then 'year' else 'other' end shape, count(*) n from {t} group by all"""


SQL["date_shape_histogram"] = " union all ".join(shape_sql(*x) for x in (("roles", "date_updated"), ("roles", "start_date"), ("roles", "end_date"), ("organizations", "date_updated"), ("organizations", "founded_date")))


@query
def max_array_length(spark: SparkSession, d: str) -> DataFrame:
    return order_roles(spark, d).agg(F.max(F.size("roles")).alias("longest"))


SQL["max_array_length"] = "select cast(max(n) as int) longest from (select count(*) n from lineitem join orders on o_orderkey = l_orderkey group by l_orderkey)"


@query
def schema_profile(spark: SparkSession, d: str) -> DataFrame:
    nodes = nested.node_table(table(spark, d, "persons").select("id", "roles", "organizations"), "id", payload=False).withColumn("owner", F.col("id"))
    return audit.schema_profile(nodes.select("child", "owner", "parent_pos", "pos").distinct())


SQL["schema_profile"] = """with a as (select distinct id, 'roles' child, -1 pp, generate_subscripts(roles, 1) - 1 pos, unnest(roles) is not null ok from persons
  union select distinct id, 'organizations', -1, generate_subscripts(organizations, 1) - 1, unnest(organizations) is not null from persons),
o as (select distinct id, generate_subscripts(organizations, 1) - 1 pp, unnest(organizations) x from persons),
b as (select distinct id, 'organizations.addresses' child, pp, generate_subscripts(x.addresses, 1) - 1 pos, unnest(x.addresses) is not null ok from o
  union select distinct id, 'organizations.funding_rounds', pp, generate_subscripts(x.funding_rounds, 1) - 1, unnest(x.funding_rounds) is not null from o),
g as (select child, id, pp, count(*) n, max(pos) m from (from a union all from b) where ok group by all)
select child, cast(sum(n) as bigint) objects, count(*) parents, cast(max(m) + 1 as bigint) most from g group by 1"""


@query
def schema_paths(spark: SparkSession, d: str) -> DataFrame:
    """Every path of the persons, inside serialized_data too, with its JSON types and longest array; no SQL can state it."""
    return audit.path_profile(table(spark, d, "persons"), ("serialized_data",))


@query
def json_extract(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"))


SQL["json_extract"] = "select event_id, cast(json_extract_string(props, '$.k') as bigint) k from events"


@query
def canonical_json(spark: SparkSession, d: str) -> DataFrame:
    """JSON with sorted keys, whatever order it came in."""
    e = table(spark, d, "events").select("event_id", F.to_json(F.parse_json(F.concat(F.lit('{"z":'), F.col("props"), F.lit(',"a":'), F.col("event_id").cast("string"), F.lit("}")))).alias("doc"))
    return e


SQL["canonical_json"] = """select event_id, '{"a":' || event_id || ',"z":' || replace(replace(props, ': ', ':'), ', ', ',') || '}' doc from events"""


@query
def validate_envelopes(spark: SparkSession, d: str) -> DataFrame:
    """Reasons for which envelope lines of the JSON feed files would stop a load, or null."""
    f = table(spark, d, "feed_lines").where("feed_file like '%.ndjson'")
    lines = f.select(F.col("feed_file").alias("file"), F.col("line_no").alias("line"), (F.octet_length("raw_line") + 1).alias("bytes"), F.col("raw_line").alias("text"))
    return feeds.envelopes(lines, "person").select("file", "line", "id", "reason")


@query
def canonical_id(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    mixed = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("x"), F.col("event_id").cast("string"))).when(F.col("event_id") % 5 == 1, F.concat(F.lit("-"), F.col("event_id").cast("string"))).when(F.col("event_id") % 5 == 2, F.lit("")).otherwise(F.col("event_id").cast("string"))
    return e.select("event_id", audit.canonical_id(mixed).alias("canonical"))


SQL["canonical_id"] = "select event_id, case when event_id % 5 > 2 then event_id end canonical from events"


@query
def batch_docs(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "source")
    return sample.batch_by_count(docs, "source", 64, F.col("doc_id")).groupBy("source", "batch").agg(F.count(F.lit(1)).alias("docs"), F.min("doc_id").alias("first_id"))


SQL["batch_docs"] = "with n as (select doc_id, source, (row_number() over (partition by source order by doc_id) - 1) // 64 batch from documents) select source, batch, count(*) docs, min(doc_id) first_id from n group by all"


@query
def batch_bytes(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("source", "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("size"))
    b = sample.batch_greedy(docs, "source", "doc_id", "size", 65_536, 100)
    return b.groupBy("source", "batch").agg(F.count(F.lit(1)).alias("docs"), F.sum("size").alias("bytes"))


SIZES = """with recursive d as (select source, doc_id, cast(coalesce(octet_length(encode(text)), 0) as bigint) size, row_number() over (partition by source order by doc_id) rn from documents),
"""
SQL["batch_bytes"] = SIZES + """b as (select source, rn, size used, 1 cnt, cast(0 as bigint) batch, size from d where rn = 1
  union all select d.source, d.rn, case when b.used + d.size > 65536 or b.cnt >= 100 then d.size else b.used + d.size end, case when b.used + d.size > 65536 or b.cnt >= 100 then 1 else b.cnt + 1 end,
    case when b.used + d.size > 65536 or b.cnt >= 100 then b.batch + 1 else b.batch end, d.size from b join d on d.source = b.source and d.rn = b.rn + 1)
select source, batch, count(*) docs, cast(sum(size) as bigint) bytes from b group by all"""


@query
def byte_budget_sample(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("source", "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("size"))
    return sample.within_budget(docs, "source", "doc_id", "size", 100_000)


SQL["byte_budget_sample"] = SIZES + """b as (select source, rn, doc_id, size, size <= 100000 taken, case when size <= 100000 then 100000 - size else 100000 end room from d where rn = 1
  union all select d.source, d.rn, d.doc_id, d.size, d.size <= b.room, case when d.size <= b.room then b.room - d.size else b.room end from b join d on d.source = b.source and d.rn = b.rn + 1)
select source, doc_id, size from b where taken"""


@query
def first_lines(spark: SparkSession, d: str) -> DataFrame:
    """The first lines of each feed file, by number."""
    return table(spark, d, "feed_lines").where("line_no <= 5").select("feed_file", "line_no", "raw_line")


SQL["first_lines"] = "select feed_file, line_no, raw_line from feed_lines where line_no <= 5"


@query
def small_bodies(spark: SparkSession, d: str) -> DataFrame:
    """Bodies of at most 64 KiB, with their size."""
    size = F.octet_length("serialized_data").cast("long")
    return table(spark, d, "persons").select("id", size.alias("bytes")).where("bytes <= 65536").distinct()


SQL["small_bodies"] = "select distinct id, cast(octet_length(encode(serialized_data)) as bigint) bytes from persons where octet_length(encode(serialized_data)) <= 65536"


@query
def scalar_functions(spark: SparkSession, d: str) -> DataFrame:
    """String, number, array, hash and JSON functions as the feed engine uses them."""
    o = table(spark, d, "organizations").select("forager_id", "name", "employees_number", "keywords", "date_updated").distinct()
    words = F.split(F.trim(F.regexp_replace(F.coalesce("name", F.lit("")), r"\s+", " ")), " ")
    return o.select(
        "forager_id", F.concat(F.lit("ns:org:"), F.col("forager_id").cast("string")).alias("key"), F.substring("name", 1, 12).alias("cut"), F.size(words).alias("words"), F.slice(words, 1, 1)[0].alias("first_word"), F.greatest(F.lit(1), F.coalesce("employees_number", F.lit(0))).alias("at_least_one"),
        F.ceil(F.coalesce("employees_number", F.lit(0)) / 7).cast("long").alias("sevenths"), F.coalesce(F.array_contains("keywords", "inventory planning"), F.lit(False)).alias("plans"), F.size(F.array_distinct(F.coalesce("keywords", F.array().cast("array<string>")))).alias("keywords"), F.sha2(F.coalesce("name", F.lit("")), 256).alias("sha"), F.date_format(feed_instant(F.col("date_updated")), "yyyy-MM-dd").alias("day"),
    )


SQL["scalar_functions"] = r"""with o as (select distinct forager_id, name, employees_number, keywords, date_updated from organizations),
w as (select *, string_split(trim(regexp_replace(coalesce(name, ''), '\s+', ' ', 'g')), ' ') words, cast(regexp_replace(date_updated, ' (Z|[+-]\d\d)(\d\d)?$', '\1') as timestamptz)
  - case when date_updated ~ '[+-]\d{4}$' then to_minutes(cast(right(date_updated, 5)[1] || right(date_updated, 2) as int)) else to_minutes(0) end at_ from o)
select forager_id, 'ns:org:' || forager_id key, name[1:12] cut, cast(len(words) as int) words, words[1] first_word, greatest(1, coalesce(employees_number, 0)) at_least_one,
  cast(ceil(coalesce(employees_number, 0) / 7) as bigint) sevenths, coalesce(list_contains(keywords, 'inventory planning'), false) plans,
  cast(len(list_distinct(coalesce(list_filter(keywords, lambda x: x is not null), []))) + case when len(list_filter(keywords, lambda x: x is null)) > 0 then 1 else 0 end as int) keywords,
  sha256(coalesce(name, '')) sha, strftime(at_ at time zone 'UTC', '%Y-%m-%d') "day" from w"""


@query
def stride_sample(spark: SparkSession, d: str) -> DataFrame:
    return sample.stride(sample.numbered(table(spark, d, "documents").select("doc_id", "source"), "source", F.col("doc_id")))


SQL["stride_sample"] = "select doc_id, source, line from (select doc_id, source, row_number() over (partition by source order by doc_id) line from documents) where (line - 1) % 16 = 0 and line <= 2048"


@query
def bottom_k_sample(spark: SparkSession, d: str) -> DataFrame:
    return sample.bottom_k(table(spark, d, "documents").select("doc_id", "source"), "source", "doc_id", 32)


SQL["bottom_k_sample"] = "select doc_id, source from documents qualify row_number() over (partition by source order by md5(cast(doc_id as varchar)), doc_id) <= 32"


@query
def first_examples(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("source", F.coalesce("lang", F.lit("-")).alias("lang"), "doc_id", "n_chars")
    return sample.first_of_each(docs, "source", "lang", "doc_id")


SQL["first_examples"] = "select source, coalesce(lang, '-') lang, doc_id, n_chars from documents qualify row_number() over (partition by source, coalesce(lang, '-') order by doc_id) = 1"


@query
def held_out_split(spark: SparkSession, d: str) -> DataFrame:
    return sample.split_held_out(table(spark, d, "documents").select("doc_id", "source"), "source", F.col("doc_id"))


SQL["held_out_split"] = "select doc_id, source, case when (row_number() over (partition by source order by doc_id) - 1) % 4 = 0 then 'train' else 'held_out' end part from documents"


@query
def merged_sample(spark: SparkSession, d: str) -> DataFrame:
    """The union of a uniform sample and the first examples, each row once, with its place."""
    docs = table(spark, d, "documents").select("doc_id", "source", F.coalesce("lang", F.lit("-")).alias("lang"))
    a = sample.bottom_k(docs, "source", "doc_id", 8).select("source", "doc_id")
    b = sample.first_of_each(docs, "source", "lang", "doc_id").select("source", "doc_id")
    return a.unionByName(b).dropDuplicates(["source", "doc_id"]).orderBy("source", "doc_id")


SQL["merged_sample"] = """select source, doc_id from (select * from documents qualify row_number() over (partition by source order by md5(cast(doc_id as varchar)), doc_id) <= 8)
union select source, doc_id from (select * from documents qualify row_number() over (partition by source, coalesce(lang, '-') order by doc_id) = 1)"""


@query
def full_doc_compare(spark: SparkSession, d: str) -> DataFrame:
    """Whole enriched documents against a copy in which some lack, some are added, and some differ in one nested value."""
    e = enriched_orders(spark, d)
    doc = F.to_json(F.struct(*[c for c in e.columns if c != "o_orderkey"]))
    key = F.col("o_orderkey")
    a = e.select("o_orderkey", doc.alias("doc"))
    changed = e.withColumn("roles", F.when(key % 97 == 5, F.transform("roles", lambda r, i: r.withField("supp", F.when(i == F.size("roles") - 1, r["supp"] + 1).otherwise(r["supp"])))).otherwise(F.col("roles")))
    b = changed.where(key % 101 != 7).select(F.when(key % 103 == 9, -key).otherwise(key).alias("o_orderkey"), doc.alias("doc"))
    return checks.differing(a, b, "o_orderkey", "doc")


SQL["full_doc_compare"] = """
with o as (select o_orderkey k, o_orderkey % 101 = 7 lacks, o_orderkey % 103 = 9 moved, o_orderkey % 97 = 5 and o_orderkey in (select l_orderkey from lineitem) changed from orders)
select k o_orderkey, case when lacks or moved then 'only left' else 'differs' end kind from o where lacks or moved or changed
union all select -k, 'only right' from o where moved and not lacks"""


@query
def counter_delta(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("user_id", "event_id", F.when(F.col("user_id") % 3 == 0, F.col("event_id") * 2).otherwise(F.pmod(F.col("event_id") * 7919, F.lit(100_003))).alias("reading"))
    return sample.counter_delta(e, "user_id", "event_id", "reading")


SQL["counter_delta"] = """with e as (select user_id, event_id, case when user_id % 3 = 0 then event_id * 2 else (event_id * 7919) % 100003 end reading from events),
s as (select *, coalesce(reading < lag(reading) over (partition by user_id order by event_id), false) reset from e)
select user_id, case when not bool_or(reset) then arg_max(reading, event_id) - arg_min(reading, event_id) end delta from s group by 1"""


@query
def percentile_median(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy("event_type").agg(F.round(F.expr("percentile(value, 0.5)"), 6).alias("median"), F.max("value").alias("peak"))


SQL["percentile_median"] = "select event_type, round(quantile_cont(value, 0.5), 6) median, max(value) peak from events group by 1"


@query
def encoded_key_sort(spark: SparkSession, d: str) -> DataFrame:
    """Ids of each order's references in the order of their decimal spelling."""
    roles = order_roles(spark, d).where("roles is not null")
    return roles.select("o_orderkey", F.array_join(F.array_sort(F.array_distinct(F.transform("roles", lambda r: r["supp"].cast("string")))), ",").alias("keys"))


SQL["encoded_key_sort"] = "select l_orderkey o_orderkey, string_agg(k, ',' order by k) keys from (select distinct l_orderkey, cast(l_suppkey as varchar) k from lineitem) join orders on o_orderkey = l_orderkey group by 1"


@query
def byte_stats(spark: SparkSession, d: str) -> DataFrame:
    return audit.byte_stats(table(spark, d, "persons"), "serialized_data")


SQL["byte_stats"] = "select count(serialized_data) n, cast(coalesce(sum(octet_length(encode(serialized_data))), 0) as bigint) bytes, cast(coalesce(max(octet_length(encode(serialized_data))), 0) as bigint) most from persons"


@query
def content_digest(spark: SparkSession, d: str) -> DataFrame:
    return checks.digest(table(spark, d, "orders"), "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")


SQL["content_digest"] = """
with t as (select md5(list_aggregate([coalesce(length(x) || ':' || x, '-') for x in [o_orderkey::varchar, o_custkey::varchar, o_orderstatus, o_orderpriority]], 'string_agg', '')) h from orders)
select count(*) as "rows", cast(coalesce(sum(cast('0x' || left(h, 15) as hugeint)), 0) as varchar) digest from t"""


@query
def file_partials(spark: SparkSession, d: str) -> DataFrame:
    """Counts for each feed file, merged to a total by sum and maximum."""
    f = table(spark, d, "feed_lines").select("feed_file", F.octet_length("raw_line").cast("long").alias("bytes"))
    return f.groupBy("feed_file").agg(F.count(F.lit(1)).alias("lines"), F.sum("bytes").alias("bytes"), F.max("bytes").alias("longest"))


SQL["file_partials"] = "select feed_file, count(*) lines, cast(sum(octet_length(encode(raw_line))) as bigint) bytes, cast(max(octet_length(encode(raw_line))) as bigint) longest from feed_lines group by 1"


@query
def removals_by_month(spark: SparkSession, d: str) -> DataFrame:
    r = utc(table(spark, d, "organization_removals"), "removed_at")
    return r.groupBy(F.date_format("removed_at", "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("removals"), F.countDistinct("organization_id").alias("organizations"))


SQL["removals_by_month"] = "select strftime(removed_at at time zone 'UTC', '%Y-%m') \"month\", count(*) removals, count(distinct organization_id) organizations from organization_removals group by 1"


@query
def mean_extrapolation(spark: SparkSession, d: str) -> DataFrame:
    """The size of all bodies as estimated from the mean of a sample, beside the true size."""
    p = table(spark, d, "persons").where("serialized_data is not null").select("id", F.octet_length("serialized_data").cast("long").alias("b"))
    mean = F.sum(F.when(F.col("id") % 20 == 0, F.col("b"))) / F.greatest(F.lit(1), F.count_if(F.col("id") % 20 == 0))
    return p.agg(F.count(F.lit(1)).alias("bodies"), F.round(mean * F.count(F.lit(1)), 3).alias("estimated"), F.sum("b").alias("bytes"))


SQL["mean_extrapolation"] = """with p as (select id, cast(octet_length(encode(serialized_data)) as bigint) b from persons where serialized_data is not null)
select count(*) bodies, round(cast(sum(b) filter (id % 20 = 0) as double) / greatest(1, count(*) filter (id % 20 = 0)) * count(*), 3) estimated, cast(sum(b) as bigint) bytes from p"""


@query
def source_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Figures of each mailbox merged to one row: the greatest peak, the sum of peaks and the sum of all."""
    per = table(spark, d, "documents").groupBy("source").agg(F.max("n_chars").alias("peak"), F.sum("n_chars").alias("chars"))
    return per.agg(F.max("peak").alias("max_peak"), F.sum("peak").alias("sum_of_peaks"), F.sum("chars").alias("chars"), F.count(F.lit(1)).alias("sources"))


SQL["source_rollup"] = "select max(p) max_peak, cast(sum(p) as bigint) sum_of_peaks, cast(sum(c) as bigint) chars, count(*) sources from (select max(n_chars) p, sum(n_chars) c from documents group by source)"
