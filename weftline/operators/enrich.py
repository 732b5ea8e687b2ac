"""Nested enrichment: the references in each entity's array are resolved against a second table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def resolve(references: DataFrame, known: DataFrame) -> DataFrame:
    """(entity, resolved, unresolved, bodies) for references (entity, pos, ref) against a table (ref, body).

    Each entity's distinct references in the order of their first position: those that are known, those that are not, and
    the bodies of the known ones. Only ids move before the join; repeats within an entity are folded and null references
    dropped. known may do without a body. One exchange by reference and one by entity.
    """
    distinct = references.where("ref is not null").groupBy("entity", "ref").agg(F.min("pos").alias("pos"))
    has_body = "body" in known.columns
    found = distinct.join(known.withColumn("hit", F.lit(True)), "ref", "left")
    item = F.struct("pos", "ref", F.coalesce("hit", F.lit(False)).alias("hit"), *(["body"] if has_body else []))
    refs = found.groupBy("entity").agg(F.array_sort(F.collect_list(item), lambda a, b: a["pos"] - b["pos"]).alias("refs"))
    pick = lambda want, field: F.transform(F.filter("refs", lambda r: r["hit"] == want), lambda r: r[field])
    return refs.select("entity", pick(True, "ref").alias("resolved"), pick(False, "ref").alias("unresolved"), *([pick(True, "body").alias("bodies")] if has_body else []))


def enrich(entities: DataFrame, lookup: DataFrame, *, id_col: str = "id", array: str = "roles", ref: str = "organization_id", lookup_id: str = "forager_id", into: str = "organizations", flag: str = "organization_unresolved") -> DataFrame:
    """The entities with their references resolved; every other column is kept.

    Each element of the array gets the flag: it has a reference that the lookup doesn't know (a null one is no such). The
    column `into` is replaced by the complete lookup rows, each once, in the order of the first reference to it;
    unresolved_organization_ids and has_unresolved_organizations tell of the rest. n_roles, n_resolved and n_unresolved
    count elements, repeats included. A null array counts as empty. id_col and lookup_id must be unique.
    """
    refs = entities.select(F.col(id_col).alias("entity"), F.posexplode(F.transform(array, lambda r: r[ref])).alias("pos", "ref"))
    found = resolve(refs, lookup.select(F.col(lookup_id).alias("ref"), F.struct(*lookup.columns).alias("body")))
    none = F.array().cast(entities.select(F.transform(array, lambda r: r[ref])).schema[0].dataType)
    items = F.coalesce(F.col(array), F.array().cast(entities.schema[array].dataType))
    unresolved = F.coalesce("unresolved", none)
    is_bad = lambda r: r[ref].isNotNull() & F.array_contains(F.col("_bad"), r[ref])
    known = lambda r: r[ref].isNotNull() & ~F.array_contains(F.col("_bad"), r[ref])
    joined = entities.drop(into, "unresolved_organization_ids", "has_unresolved_organizations").join(found.withColumnRenamed("entity", id_col), id_col, "left").withColumn("_bad", unresolved)
    return (
        joined.withColumns({array: items, into: F.coalesce("bodies", F.array().cast(f"array<{lookup.select(F.struct(*lookup.columns)).schema[0].dataType.simpleString()}>"))})
        .withColumns({"n_roles": F.size(array), "n_resolved": F.size(F.filter(array, known)), "n_unresolved": F.size(F.filter(array, is_bad)), "unresolved_organization_ids": F.col("_bad"), "has_unresolved_organizations": F.size("_bad") > 0})
        .withColumn(array, F.transform(array, lambda r: r.withField(flag, is_bad(r))))
        .drop("resolved", "unresolved", "bodies", "_bad")
    )


def _variant_map(fields: dict[str, Column]) -> Column:
    return F.create_map(*[x for k, v in fields.items() for x in (F.lit(k), v.cast("variant"))])


def enrich_documents(persons: DataFrame, organizations: DataFrame) -> DataFrame:
    """(id, doc, n_roles, n_resolved, n_unresolved) from loaded feeds (id, body); doc is a VARIANT.

    As enrich, for bodies without a schema: unknown fields survive at every level, organizations are embedded whole, and
    the four generated fields overwrite those of the same name.
    """
    p = persons.select("id", F.parse_json("body").alias("body"))
    roles = F.coalesce(F.expr("try_variant_get(body, '$.roles', 'array<variant>')"), F.expr("cast(array() as array<variant>)"))
    p = p.select("id", "body", roles.alias("roles"))
    ref = lambda r: F.try_variant_get(r, "$.organization_id", "bigint")
    refs = p.select(F.col("id").alias("entity"), F.posexplode(F.transform("roles", ref)).alias("pos", "ref"))
    found = resolve(refs, organizations.select(F.col("id").alias("ref"), F.parse_json("body").alias("body")))
    none = F.array().cast("array<bigint>")
    j = p.join(found.withColumnRenamed("entity", "id"), "id", "left").withColumn("bad", F.coalesce("unresolved", none))
    is_bad = lambda r: ref(r).isNotNull() & F.array_contains(F.col("bad"), ref(r))
    as_map = lambda v: v.cast("map<string,variant>")
    flagged = F.transform("roles", lambda r: F.to_variant_object(F.map_concat(F.map_filter(as_map(r), lambda k, v: k != "organization_unresolved"), _variant_map({"organization_unresolved": is_bad(r)}))))
    own = ("roles", "organizations", "unresolved_organization_ids", "has_unresolved_organizations")
    generated = F.create_map(
        F.lit("roles"), F.to_variant_object(flagged), F.lit("organizations"), F.to_variant_object(F.coalesce("bodies", F.expr("cast(array() as array<variant>)"))),
        F.lit("unresolved_organization_ids"), F.to_variant_object("bad"), F.lit("has_unresolved_organizations"), (F.size("bad") > 0).cast("variant"),
    )
    doc = F.to_variant_object(F.map_concat(F.map_filter(as_map(F.col("body")), lambda k, v: ~k.isin(*own)), generated))
    n_bad = F.size(F.filter("roles", is_bad))
    return j.select("id", doc.alias("doc"), F.size("roles").alias("n_roles"), (F.size(F.filter("roles", lambda r: ref(r).isNotNull())) - n_bad).alias("n_resolved"), n_bad.alias("n_unresolved"))


def enrich_parts(persons: DataFrame, organizations: DataFrame) -> DataFrame:
    """(id, doc, n_roles, n_resolved, n_unresolved) from persons taken apart (id, rest, roles) and organizations (id, body).

    The same documents as enrich_documents makes, as JSON text: it is put together from the pieces that validation left, so
    no body is parsed again. Members keep their order, and those that enrichment writes stand last.
    """
    refs = persons.select(F.col("id").alias("entity"), F.posexplode(F.transform("roles", lambda r: r["ref"])).alias("pos", "ref"))
    found = resolve(refs, organizations.select(F.col("id").alias("ref"), "body")).withColumnRenamed("entity", "id")
    j = persons.select("id", "rest", "roles").join(found, "id", "left").withColumn("bad", F.coalesce("unresolved", F.array().cast("array<bigint>")))
    is_bad = lambda r: r["ref"].isNotNull() & F.array_contains(F.col("bad"), r["ref"])
    truth = lambda c: F.when(c, "true").otherwise("false")
    listed = lambda texts: F.concat(F.lit("["), F.array_join(texts, ","), F.lit("]"))
    roles = F.transform("roles", lambda r: F.concat(r["head"], F.lit('"organization_unresolved":'), truth(is_bad(r)), F.lit("}")))
    doc = F.concat(
        F.lit("{"), "rest", F.when(F.col("rest") == "", "").otherwise(","), F.lit('"roles":'), listed(roles), F.lit(',"organizations":'), listed(F.coalesce("bodies", F.array().cast("array<string>"))),
        F.lit(',"unresolved_organization_ids":'), listed(F.transform("bad", lambda x: x.cast("string"))), F.lit(',"has_unresolved_organizations":'), truth(F.size("bad") > 0), F.lit("}"),
    )
    n_bad = F.size(F.filter("roles", is_bad))
    return j.select("id", doc.alias("doc"), F.size("roles").alias("n_roles"), (F.size(F.filter("roles", lambda r: r["ref"].isNotNull())) - n_bad).alias("n_resolved"), n_bad.alias("n_unresolved"))


def totals(enriched: DataFrame) -> DataFrame:
    """One row: the run's counts and the share of unresolved references in percent."""
    t = enriched.agg(
        F.count(F.lit(1)).alias("persons"), F.coalesce(F.sum("n_roles"), F.lit(0)).alias("roles"), F.coalesce(F.sum("n_resolved"), F.lit(0)).alias("resolved_org_refs"), F.coalesce(F.sum("n_unresolved"), F.lit(0)).alias("unresolved_org_refs"), F.coalesce(F.sum((F.col("n_unresolved") > 0).cast("long")), F.lit(0)).alias("persons_with_unresolved_orgs")
    )
    return t.withColumn("unresolved_percent", F.lit(100.0) * F.col("unresolved_org_refs") / F.greatest(F.lit(1), F.col("roles")))
