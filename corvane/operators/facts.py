"""Company-year facts: descriptive values, names, places, published filings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.operators.relational import first_of_group, small, year_spine


def company_years(edges: DataFrame, filers: DataFrame) -> DataFrame:
    """(cw_id, year) of all children and filers."""
    return year_spine(edges.select(F.col("target").alias("cw_id"), "year"), filers.filter("cw_id is not null").select("cw_id", "year"))


def describe(info: DataFrame, filers: DataFrame, relationships: DataFrame) -> DataFrame:
    """info with cik, irs_number, sic_code, company_name, source_type, source_id: the filer's values, else the relationship's."""
    f = filers.filter("cw_id is not null").groupBy("cw_id", "year").agg(
        F.min_by(F.struct("cik", "match_name", "filer_id"), "filer_id").alias("_f"), F.max("irs_number").alias("irs_number"), F.max("sic_code").alias("sic_code")
    )
    r = relationships.filter("cw_id is not null").groupBy("cw_id", "year").agg(F.min_by(F.struct("cik", "clean_company", "relationship_id"), "relationship_id").alias("_r"))
    out = info.join(f, ["cw_id", "year"], "left").join(r, ["cw_id", "year"], "left")
    from_filer = F.col("_f.match_name").isNotNull()
    pick = lambda a, b: F.when(from_filer, F.col(a)).otherwise(F.coalesce(F.col(b), F.col(a)))
    source = F.when(F.col("_f").isNotNull() & (from_filer | F.col("_r").isNull()), "filers").when(F.col("_r").isNotNull(), "relationships")
    return out.select(
        *info.columns, pick("_f.cik", "_r.cik").alias("cik"), "irs_number", "sic_code", pick("_f.match_name", "_r.clean_company").alias("company_name"),
        source.alias("source_type"), pick("_f.filer_id", "_r.relationship_id").alias("source_id"),
    )


def with_sectors(info: DataFrame, codes: DataFrame, sectors: DataFrame) -> DataFrame:
    """info with industry_name, sic_sector and sector_name of its sic_code."""
    named = small(codes.select("sic_code", "industry_name", "sic_sector").join(sectors.select("sic_sector", "sector_name"), "sic_sector"))
    return info.join(named, "sic_code", "left").select(*info.columns, "industry_name", "sic_sector", "sector_name")


def company_names(filers: DataFrame, relationships: DataFrame, filings: DataFrame, info: DataFrame, master_names: DataFrame) -> DataFrame:
    """(cw_id, company_name, source, source_row_id, country_code, subdiv_code, date, min_year, max_year) from five sources.

    A filer's match name; its conformed name if different; former names from the master list, for the years of the match name; a
    subsidiary's raw name; its cleaned name if different in any character.
    """
    dated = filings.select("filing_id", "filing_date")
    of = info.select("cw_id", "year", "source_type")
    f = filers.filter("cw_id is not null").join(of.filter("source_type = 'filers'").select("cw_id", "year"), ["cw_id", "year"], "left_semi").join(dated, "filing_id")
    entities = info.filter("source_type = 'relationships'").select("cw_id").distinct()
    r = relationships.join(entities, "cw_id", "left_semi").join(dated, "filing_id")

    def grouped(rows: DataFrame, name: str, source: str, row_id: str, cc: str, sc: str) -> DataFrame:
        first = F.min_by(F.struct(F.col(row_id).alias("source_row_id"), F.col(cc).alias("country_code"), F.col(sc).alias("subdiv_code")), row_id)
        per = rows.groupBy("cw_id", F.col(name).alias("company_name")).agg(first.alias("_x"), F.min("filing_date").alias("date"), F.max("filing_date").alias("_last"))
        return per.select(
            "cw_id", "company_name", F.lit(source).alias("source"), "_x.*", "date", F.year("date").alias("min_year"), F.year("_last").alias("max_year")
        )

    by_filer = lambda rows, name, source: grouped(rows, name, source, "filer_id", "incorp_country_code", "incorp_subdiv_code")
    match = by_filer(f, "match_name", "filer_match_name")
    conformed = by_filer(f.filter("conformed_name <> match_name"), "conformed_name", "filer_conformed_name")
    ciks = info.filter("cik is not null").groupBy("cik").agg(F.min("cw_id").alias("cw_id"))
    listed = master_names.join(ciks, "cik").select("cw_id", F.col("match_name").alias("former"), "row_id")
    years = match.select("cw_id", "company_name", "min_year", "max_year").join(info.select("cw_id", "year"), "cw_id").filter("year between min_year and max_year")
    former = years.join(listed, "cw_id").filter("company_name <> former").groupBy("cw_id", F.col("former").alias("company_name")).agg(
        F.min("row_id").alias("source_row_id"), F.min("year").alias("min_year"), F.max("year").alias("max_year")
    )
    none = F.lit(None).cast("string")
    former = former.select(
        "cw_id", "company_name", F.lit("cik_former_name").alias("source"), "source_row_id", none.alias("country_code"), none.alias("subdiv_code"),
        F.lit(None).cast("date").alias("date"), "min_year", "max_year",
    )
    by_relation = lambda rows, name, source: grouped(rows, name, source, "relationship_id", "country_code", "subdiv_code")
    raw = by_relation(r, "company_name", "relationships_company_name")
    clean = by_relation(r.filter("company_name <> clean_company"), "clean_company", "relationships_clean_company")
    return reduce(DataFrame.unionByName, [match, conformed, former, raw, clean])


def company_locations(filers: DataFrame, relationships: DataFrame, filings: DataFrame, info: DataFrame, region_codes: DataFrame) -> DataFrame:
    """(cw_id, type, raw_address, street_1, state, country_code, subdiv_code, date, min_year, max_year): addresses, state of incorporation, relations' places."""
    dated = filings.select("filing_id", "filing_date", F.col("year").alias("filing_year"))
    f = filers.join(info.select("cw_id", "year"), ["cw_id", "year"], "left_semi").join(dated, "filing_id")
    none = F.lit(None).cast("string")

    def addresses(prefix: str, kind: str) -> DataFrame:
        rows = f.filter(f"{prefix}_street_1 is not null").select(
            "cw_id", "filer_id", F.col(f"{prefix}_raw_address").alias("raw_address"), F.col(f"{prefix}_street_1").alias("street_1"),
            F.col(f"{prefix}_state").alias("state"), none.alias("country_code"), none.alias("subdiv_code"), "filing_date", "filing_year",
        )
        return collapsed(rows, ["cw_id", "raw_address"], "filer_id", kind)

    def collapsed(rows: DataFrame, keys: list[str], row_id: str, kind: str) -> DataFrame:
        others = [c for c in ("raw_address", "street_1", "state", "country_code", "subdiv_code", "filing_date") if c not in keys]
        per = rows.groupBy(*keys).agg(F.min_by(F.struct(*others), row_id).alias("_x"), F.min("filing_year").alias("min_year"), F.max("filing_year").alias("max_year"))
        return per.select(*keys, "_x.*", "min_year", "max_year").select(
            "cw_id", F.lit(kind).alias("type"), "raw_address", "street_1", "state", "country_code", "subdiv_code", F.col("filing_date").alias("date"), "min_year", "max_year"
        )

    incorp = f.filter("state_of_incorporation is not null").select(
        "cw_id", "filer_id", F.col("state_of_incorporation").alias("raw_address"), none.alias("street_1"), none.alias("state"),
        F.col("incorp_country_code").alias("country_code"), F.col("incorp_subdiv_code").alias("subdiv_code"), "filing_date", "filing_year",
    )
    entities = info.filter("source_type = 'relationships'").select("cw_id").distinct()
    r = relationships.filter("location is not null").join(entities, "cw_id", "left_semi").join(dated, "filing_id").select(
        "cw_id", "relationship_id", F.col("location").alias("raw_address"), none.alias("street_1"), none.alias("state"), "country_code", "subdiv_code", "filing_date", "filing_year"
    )
    out = reduce(DataFrame.unionByName, [
        addresses("business", "business"), addresses("mail", "mailing"), collapsed(incorp, ["cw_id", "raw_address"], "filer_id", "state_of_incorp"),
        collapsed(r, ["cw_id", "country_code", "subdiv_code"], "relationship_id", "relation_loc"),
    ])
    return state_codes(out, region_codes)


def state_codes(locations: DataFrame, region_codes: DataFrame) -> DataFrame:
    """locations whose codes are those of their state, where the state is known; they overwrite."""
    codes = small(first_of_group(region_codes.select(F.col("code").alias("_code"), F.col("country_code").alias("_cc"), F.col("subdiv_code").alias("_sc")), ["_code"], "_cc"))
    out = locations.join(codes, F.col("state") == F.col("_code"), "left")
    known = F.col("_code").isNotNull()
    out = out.withColumn("country_code", F.when(known, F.col("_cc")).otherwise(F.col("country_code")))
    return out.withColumn("subdiv_code", F.when(known, F.col("_sc")).otherwise(F.col("subdiv_code"))).select(locations.columns)


def flag_recent(rows: DataFrame, info: DataFrame, corrected: bool = False) -> DataFrame:
    """rows (cw_id, max_year) with most_recent: max_year is one of the company's years, or, corrected, its latest."""
    years = info.groupBy("cw_id").agg(F.max("year").alias("_y")) if corrected else info.select("cw_id", F.col("year").alias("_y")).distinct()
    hit = years.withColumnRenamed("_y", "max_year").withColumn("most_recent", F.lit(True))
    return rows.join(hit, ["cw_id", "max_year"], "left").fillna(False, ["most_recent"]).select(*rows.columns, "most_recent")


def filings_lookup(filers: DataFrame, filings: DataFrame, relationships: DataFrame) -> DataFrame:
    """(cw_id, filing_id, company_is_filer): the annual reports of each filer, and the filings that name a company as a child."""
    own = filers.filter("cw_id is not null").select("cik", "cw_id").distinct().join(filings.filter("type like '10-K%'").select("cik", "filing_id"), "cik")
    own = own.select("cw_id", "filing_id", F.lit(True).alias("company_is_filer")).distinct()
    named = relationships.filter("cw_id <> parent_cw_id").select("cw_id", "filing_id", F.lit(False).alias("company_is_filer")).distinct()
    return own.unionByName(named.join(own, ["cw_id", "filing_id"], "left_anti"))


def published_filings(filings: DataFrame, lookup: DataFrame, base_url: str) -> DataFrame:
    """The filings of the lookup, with the address of the form."""
    out = filings.join(lookup.select("filing_id").distinct(), "filing_id", "left_semi")
    return out.select("filing_id", "cik", "year", "quarter", "filing_date", F.concat(F.lit(base_url), "filename").alias("form_url"), "sec_21_url")


def filing_fields(relationships: DataFrame, filings: DataFrame) -> DataFrame:
    """relationships with filer_cik, year and quarter of their filing."""
    own = filings.select("filing_id", F.col("cik").alias("filer_cik"), "year", "quarter")
    return relationships.drop("filer_cik", "year", "quarter").join(own, "filing_id", "left")


def exhibit_flags(filers: DataFrame, filings: DataFrame) -> DataFrame:
    """filers with sec_21: some filing of their cik and year has an exhibit."""
    has = filings.filter("has_sec21").select("cik", "year").distinct().withColumn("_has", F.lit(True))
    return filers.drop("sec_21").join(has, ["cik", "year"], "left").withColumn("sec_21", F.coalesce("_has", F.lit(False))).drop("_has")


def location_weights(locations: DataFrame) -> DataFrame:
    """(code, count, weight) of countries and of "country:subdivision" pairs: frequencies and their inverse-log weights."""
    from corvane.functions.text import inverse_log_weight

    codes = F.array_compact(F.array("country_code", F.when(F.col("subdiv_code").isNotNull(), F.concat_ws(":", "country_code", "subdiv_code"))))
    per = locations.filter("country_code is not null").select(F.explode(codes).alias("code")).groupBy("code").agg(F.count("*").alias("count"))
    return per.withColumn("weight", inverse_log_weight(F.col("count")))


def with_coordinates(locations: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """locations (country_code, city) with latitude and longitude from a static table (country_code, place, latitude, longitude).

    The first place of a country and name by latitude counts; comparison ignores case and accents.
    """
    from corvane.functions.text import name_key

    known = gazetteer.select("country_code", name_key(F.col("place")).alias("_k"), "latitude", "longitude")
    known = first_of_group(known, ["country_code", "_k"], "latitude")
    out = locations.withColumn("_k", name_key(F.col("city"))).join(small(known), ["country_code", "_k"], "left")
    return out.select(*locations.columns, "latitude", "longitude")
