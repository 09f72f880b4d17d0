"""Entity resolution: filers and subsidiaries to stable company identifiers by ordered exact joins."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions.text import name_key
from corvane.operators.relational import first_of_group, insert_ignore, surrogate_ids, update_from
from corvane.shared import written

REGISTRY = "cw_id long, company_name string, cik long, country_code string, subdiv_code string, source string"
_KEYS = ["name_k", "cc", "sc"]


def _registry_keys(registry: DataFrame) -> DataFrame:
    """Registry rows with comparison keys; 0 stands for no cik there and becomes null, as missing places become empty."""
    cik = F.when(F.col("cik") != 0, F.col("cik"))
    return registry.select(
        "cw_id", "company_name", cik.alias("cik"), F.coalesce("country_code", F.lit("")).alias("cc"), F.coalesce("subdiv_code", F.lit("")).alias("sc"),
        "source", name_key(F.col("company_name")).alias("name_k"),
    )


def register(registry: DataFrame, companies: DataFrame, names: DataFrame, locations: DataFrame) -> DataFrame:
    """registry with the (company, name, cik, place) of a built graph that it lacks, so that a rebuild finds the same identifiers."""
    kept = names.filter(F.col("source").isin("cik_former_name", "filer_match_name", "relationships_clean_company"))
    new = companies.select("cw_id", "cik").join(kept.select("cw_id", "company_name"), "cw_id").join(locations.select("cw_id", "country_code", "subdiv_code"), "cw_id")
    new = new.select(
        "cw_id", "company_name", F.coalesce("cik", F.lit(0)).alias("cik"), F.coalesce("country_code", F.lit("")).alias("country_code"),
        F.coalesce("subdiv_code", F.lit("")).alias("subdiv_code"), F.lit("companies").alias("source"),
    )
    return insert_ignore(registry, new, ["cw_id", "company_name", "cik", "country_code", "subdiv_code"])


def _max_id(*tables: tuple[DataFrame, str]) -> Column:
    """The largest identifier in use, 0 without any, as a literal."""
    return F.lit(max((t.agg(F.max(c)).first()[0] or 0) for t, c in tables))


@dataclass
class Resolved:
    filers: DataFrame  # with cw_id
    relationships: DataFrame  # with cw_id and cik
    companies: DataFrame  # cw_id, cik, company_name, source_type, source_id
    registry: DataFrame


def resolve_filers(filers: DataFrame, registry: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(filers with cw_id, companies, registry): one company a cik, with its registered identifier or a new one."""
    known = _registry_keys(registry).filter("cik is not null").groupBy("cik").agg(F.min("cw_id").alias("cw_id"))
    entities = first_of_group(filers.filter("cik is not null").select("cik", "filer_id", "match_name"), ["cik"], "filer_id")
    entities = written(entities.join(known, "cik", "left"), "filer-entities")
    old, new = entities.filter("cw_id is not null"), entities.filter("cw_id is null").drop("cw_id")
    new = surrogate_ids(new, ["cik"], "cw_id", _max_id((registry, "cw_id")))
    companies = old.unionByName(new.select(old.columns)).select(
        "cw_id", "cik", F.col("match_name").alias("company_name"), F.lit("filers").alias("source_type"), F.col("filer_id").alias("source_id")
    )
    companies = written(companies, "filer-companies")
    out = filers.drop("cw_id").join(companies.select("cik", "cw_id"), "cik", "left")
    fresh = companies.join(filers.select("cik", "incorp_country_code", "incorp_subdiv_code").distinct(), "cik").select(
        "cw_id", "company_name", "cik", F.coalesce("incorp_country_code", F.lit("")).alias("country_code"),
        F.coalesce("incorp_subdiv_code", F.lit("")).alias("subdiv_code"), F.lit("filers").alias("source"),
    )
    return out, companies, insert_ignore(registry, fresh, ["cw_id", "company_name", "cik", "country_code", "subdiv_code"])


def resolve_relationships(relationships: DataFrame, filers: DataFrame, companies: DataFrame, registry: DataFrame, master_names: DataFrame) -> Resolved:
    """Company identifiers of subsidiaries; each rule fills only what the ones before left open.

    Registered name and place (companies without a cik, known country); a filer's name, place and year; a name of the master list
    gives a cik and that a registered identifier; what is left gets one new identifier for each (name, country, subdivision), or that
    of the company that its cik belongs to. Ties go to the smallest identifier. A cik of 0 counts as none everywhere.
    """
    r = relationships.select(
        *[c for c in relationships.columns if c not in ("cw_id", "cik")],
        F.when(F.col("cik") != 0, F.col("cik")).alias("cik") if "cik" in relationships.columns else F.lit(None).cast("long").alias("cik"),
        F.lit(None).cast("long").alias("cw_id"),
    )
    r = r.withColumn("name_k", name_key(F.col("clean_company"))).withColumn("cc", F.coalesce("country_code", F.lit(""))).withColumn("sc", F.coalesce("subdiv_code", F.lit("")))
    reg = _registry_keys(registry)
    r = update_from(r, reg.filter("cik is null and cc <> ''").select(*_KEYS, "cw_id"), _KEYS, "cw_id", {"cw_id": "cw_id"})
    placed = filers.filter("cw_id is not null and incorp_country_code is not null").select(
        name_key(F.col("match_name")).alias("name_k"), F.col("incorp_country_code").alias("cc"), F.coalesce("incorp_subdiv_code", F.lit("")).alias("sc"), "year", "cw_id"
    )
    r = update_from(r, placed, [*_KEYS, "year"], "cw_id", {"cw_id": "cw_id"})
    listed = master_names.filter("cik <> 0").select(name_key(F.col("match_name")).alias("name_k"), "cik")
    named = update_from(r.withColumn("_cik", F.col("cik")), listed, ["name_k"], "cik", {"_cik": "cik"})
    named = named.withColumn("cik", F.when(F.col("cw_id").isNull(), F.col("_cik")).otherwise(F.col("cik"))).drop("_cik")
    r = written(named, "relations-named")
    r = update_from(r, reg.filter("cik is not null").select("cik", "cw_id"), ["cik"], "cw_id", {"cw_id": "cw_id"})
    r = update_from(r, reg.filter("cik is not null").select("cw_id", "cik"), ["cw_id"], "cik", {"cik": "cik"})
    r = written(r, "relations-matched")
    matched = r.filter("cw_id is not null").select("cw_id", "cik", "clean_company", "relationship_id")
    matched = first_of_group(matched, ["cw_id"], "relationship_id").join(companies.select("cw_id"), "cw_id", "left_anti")
    columns = ["cw_id", "cik", "company_name", "source_type", "source_id"]
    as_company = lambda d: d.select("cw_id", "cik", F.col("clean_company").alias("company_name"), F.lit("relationships").alias("source_type"), F.col("relationship_id").alias("source_id"))
    companies = companies.select(columns).unionByName(as_company(matched))

    by_cik = companies.filter("cik is not null").groupBy("cik").agg(F.min("cw_id").alias("cw_id"))
    r = update_from(r, by_cik, ["cik"], "cw_id", {"cw_id": "cw_id"})
    r = written(r, "relations-by-cik")
    open_ = r.filter("cw_id is null").select(*_KEYS, "cik", "clean_company", "relationship_id")
    new = first_of_group(open_, _KEYS, "relationship_id")
    new = written(surrogate_ids(new, _KEYS, "cw_id", _max_id((registry, "cw_id"), (companies, "cw_id"))), "new-companies")
    r = update_from(r, new.select(*_KEYS, "cw_id"), _KEYS, "cw_id", {"cw_id": "cw_id"})
    companies = companies.unionByName(as_company(new))
    fresh = new.select(
        "cw_id", F.col("clean_company").alias("company_name"), F.coalesce("cik", F.lit(0)).alias("cik"), F.col("cc").alias("country_code"),
        F.col("sc").alias("subdiv_code"), F.lit("relationships").alias("source"),
    )
    return Resolved(filers, r.drop(*_KEYS), companies, registry.unionByName(fresh.select(registry.columns)))


def suppressed_filers(filers: DataFrame, registry: DataFrame) -> DataFrame:
    """(filer_id, code): filers hidden by another of the same name, year and place but another cik.

    A filer without an exhibit loses to one whose cik is registered, if its own registered identifier is larger or missing
    (code 1 if the winner has an exhibit, else 2), else to one with a larger cik (3 or 4).
    """
    known = _registry_keys(registry).filter("cik is not null").groupBy("cik").agg(F.min("cw_id").alias("reg"))
    f = filers.filter("cik is not null").join(known, "cik", "left").select(
        "filer_id", "cik", "year", "reg", F.col("sec_21").alias("exhibit"), name_key(F.col("match_name")).alias("k"), "incorp_country_code", "incorp_subdiv_code"
    )
    # what decides for a whole group of equal name, year and place: the smallest registered identifier and the largest cik, each
    # with and without an exhibit; the identifier belongs to the cik, so no filer is hidden by its own
    key = ["k", "year", "incorp_country_code", "incorp_subdiv_code"]
    of = lambda f_, c, with_: f_(F.when(F.col("exhibit") == with_, F.col(c)))
    group = f.filter("k is not null and year is not null").groupBy(*[F.col(c).alias(f"_{c}") for c in key]).agg(
        of(F.min, "reg", True).alias("reg1"), of(F.min, "reg", False).alias("reg2"), of(F.max, "cik", True).alias("cik3"), of(F.max, "cik", False).alias("cik4"),
    )
    same = F.lit(True)
    for c in key:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    wins = lambda c: F.col(c).isNotNull() & (F.col("reg").isNull() | (F.col("reg") > F.col(c)))
    code = F.when(wins("reg1"), 1).when(wins("reg2"), 2).when(F.col("cik3") > F.col("cik"), 3).when(F.col("cik4") > F.col("cik"), 4)
    hidden = f.filter(~F.col("exhibit")).join(group, same).select("filer_id", code.alias("code")).filter("code is not null")
    return hidden.groupBy("filer_id").agg(F.min("code").alias("code"))


def hide_suppressed(filers: DataFrame, registry: DataFrame, filings: DataFrame) -> DataFrame:
    """filers with bad_cik (0: none) and cik null where suppressed, except for ciks that no unsuppressed filer has left."""
    found = filers.drop("bad_cik").join(suppressed_filers(filers, registry), "filer_id", "left").withColumn("bad_cik", F.coalesce("code", F.lit(0)).cast("byte")).drop("code")
    survive = found.filter("bad_cik = 0").select(F.col("cik").alias("_cik")).distinct()
    back = filings.select("filing_id", F.col("cik").alias("_own")).join(survive, F.col("_own") == F.col("_cik"), "left_semi").select("filing_id").distinct()
    out = found.join(back.withColumn("_back", F.lit(True)), "filing_id", "left")
    return out.withColumn("cik", F.when((F.col("bad_cik") == 0) | F.col("_back"), F.col("cik"))).drop("_back")


def default_parents(relationships: DataFrame, filings: DataFrame, companies: DataFrame) -> DataFrame:
    """relationships whose missing parent_cw_id is the company of their filing's cik."""
    filer = filings.select("filing_id", "cik").join(companies.filter("cik is not null").groupBy("cik").agg(F.min("cw_id").alias("_parent")), "cik")
    out = relationships.join(filer.select("filing_id", "_parent"), "filing_id", "left")
    return out.withColumn("parent_cw_id", F.coalesce("parent_cw_id", "_parent")).drop("_parent")


def orphan_flags(registry: DataFrame, companies: DataFrame) -> DataFrame:
    """registry with orphaned: its company isn't in the graph any more."""
    live = companies.select("cw_id").distinct().withColumn("_live", F.lit(True))
    return registry.join(live, "cw_id", "left").withColumn("orphaned", F.col("_live").isNull()).drop("_live")


def strip_strings(rows: DataFrame, column: str, strings: list[str]) -> DataFrame:
    """rows with each configured string removed from a column, blank ones dropped."""
    out = F.col(column)
    for s in strings:
        out = F.replace(out, F.lit(s), F.lit(""))
    return rows.withColumn(column, F.trim(out)).filter(F.col(column) != "")
