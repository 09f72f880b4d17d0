"""The whole plan from parsed rows to the published company tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvane.functions.text import match_key
from corvane.operators import facts, graph, locate, relational, resolve
from corvane.shared import written
from corvane.sources import exhibits
from corvane.sources import filings as sources

INPUTS = ("filings", "filers", "relationships", "registry", "master_names", "region_codes", "sic_codes", "sic_sectors")


def company_graph(tables: dict[str, DataFrame], years: list[int], base_url: str = "https://example.org/") -> dict[str, DataFrame]:
    """companies, company_info, company_names, company_locations, company_relations, company_filings, filings_lookup and registry.

    tables has the INPUTS. Every table is written to the shared folder, one after another, and read again.
    """
    with relational.counted_broadcasts(tables["filings"].sparkSession):
        return _company_graph(tables, years, base_url)


def _company_graph(tables: dict[str, DataFrame], years: list[int], base_url: str) -> dict[str, DataFrame]:
    filings, regions = tables["filings"], tables["region_codes"]
    filers = facts.exhibit_flags(tables["filers"], filings)
    codes = relational.small(regions.select(F.col("code").alias("state_of_incorporation"), F.col("country_code").alias("_cc"), F.col("subdiv_code").alias("_sc")))
    filers = filers.join(codes, "state_of_incorporation", "left")
    filers = filers.withColumn("incorp_country_code", F.coalesce("_cc", "incorp_country_code")).withColumn("incorp_subdiv_code", F.coalesce("_sc", "incorp_subdiv_code")).drop("_cc", "_sc")
    filers = written(resolve.hide_suppressed(filers, tables["registry"], filings), "filers")
    relationships = facts.filing_fields(tables["relationships"], filings).withColumn("clean_company", match_key(F.col("company_name")))

    filers, companies, registry = resolve.resolve_filers(filers, tables["registry"])
    found = resolve.resolve_relationships(relationships, written(filers, "filers"), companies, registry, tables["master_names"])
    filers, companies, registry = found.filers, written(found.companies, "companies"), found.registry
    parents = graph.indent_parents(found.relationships.select("filing_id", "relationship_id", "cw_id", "hierarchy"), "filing_id", "relationship_id", "cw_id", "hierarchy")
    relations = found.relationships.join(parents.withColumnRenamed("parent", "parent_cw_id"), ["filing_id", "cw_id"], "left")
    relations = written(resolve.default_parents(relations, filings, companies), "relationships")
    edges = written(graph.distinct_edges(relations, "cw_id", "parent_cw_id", "year"), "edges")

    info = facts.describe(facts.company_years(edges, filers), filers, relations)
    info = facts.with_sectors(graph.degrees(info, edges), tables["sic_codes"], tables["sic_sectors"])
    info = written(relational.with_year_range(info, "cw_id", "year"), "info")
    names = written(facts.flag_recent(facts.company_names(filers, relations, filings, info, tables["master_names"]), info), "names")
    places = facts.company_locations(filers, relations, filings, info, regions)
    numbered = relational.surrogate_ids(places, ["cw_id", "type", "raw_address", "country_code", "subdiv_code"], "location_id")
    places = written(facts.flag_recent(numbered, info), "locations")
    spark = filings.sparkSession
    best = locate.best_locations(places, spark.createDataFrame([(y,) for y in years], "year int"))
    placed = info.select("cw_id", "year").join(best, ["cw_id", "year"], "left")
    placed = locate.fill_locations(placed, places, 0).withColumnRenamed("location_id", "best_location_id")
    tops = graph.top_parents(info, edges, merge=True)
    info = written(info.join(placed, ["cw_id", "year"]).join(tops, ["cw_id", "year"]), "info")
    lookup = written(facts.filings_lookup(filers, filings, relations), "lookup")
    registry = resolve.register(registry, companies, names, places)
    return {
        "companies": companies, "company_info": info, "company_names": names, "company_locations": places, "company_relations": written(graph.cut_top_edges(edges, info), "relations"),
        "company_filings": written(facts.published_filings(filings, lookup, base_url), "published"), "filings_lookup": lookup, "registry": written(resolve.orphan_flags(registry, companies), "registry"),
        "all_relations": edges,
    }


def from_documents(spark: SparkSession, source: str, lookups: dict[str, DataFrame], years: list[int], base_url: str = "https://example.org/") -> dict[str, DataFrame]:
    """The tables of company_graph() from downloaded files below a folder, and filing_ids.

    index/{year}/{quarter}/* are index files, submissions/{year}/{quarter}/{filing_id}.txt and headers/{year}/{quarter}/{filing_id}.html
    the documents of their annual reports, names/* the name list. Identifiers of filings are those of numbered_files(). lookups has
    countries, aliases, subdivisions, stop_terms, region_codes, sic_codes, sic_sectors and, from the build before, registry and
    filing_ids, which later builds need so that filings keep their identifiers. Every step is a table function or a join; no document
    is collected.
    """
    index = sources.read_index(spark, f"{source}/index")
    numbers = written(numbered_files(index, lookups.get("filing_ids")), "filing-ids")
    filings = written(file_rows(index, numbers), "annual")
    submissions = sources.read_documents(spark, f"{source}/submissions", ".txt").select("filing_id", "content")
    parsed = parsed_submissions(filings, submissions, lookups, base_url)
    pages = sources.read_documents(spark, f"{source}/headers", ".html").select("filing_id", "content")
    names = sources.read_names(spark, f"{source}/names")
    tables = {"filings": with_documents(filings, parsed["documents"]), "filers": parsed_headers(filings, pages, lookups["region_codes"]), "relationships": parsed["relationships"]}
    return published(tables, lookups, names, years, base_url) | {"bad_locations": parsed["bad_locations"], "filing_ids": numbers}


FILE = ("cik", "filename", "type", "year")


def numbered_files(index: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(cik, filename, type, year, filing_id) of the known files and of the index rows that aren't among them, each once.

    Files keep the identifiers that they have; new ones go on from the largest, in the order of their columns. Documents are stored
    under these identifiers, so this table has to be kept from one load to the next.
    """
    rows = index.select(*FILE).distinct()
    if known is None:
        return relational.surrogate_ids(rows, FILE, "filing_id")
    known = known.select(*FILE, "filing_id")
    mine = known.select(*[F.col(c).alias(f"_{c}") for c in FILE], F.lit(True).alias("_known"))
    new = rows.join(mine, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in FILE], "left").filter("_known is null").select(*FILE)
    last = known.agg(F.coalesce(F.max("filing_id"), F.lit(0))).first()[0]
    return known.unionByName(relational.surrogate_ids(new, FILE, "filing_id", last))


def file_rows(index: DataFrame, numbers: DataFrame) -> DataFrame:
    """The annual reports among index rows, with the identifiers of their files; of rows that repeat a file's columns one, the least."""
    rest = [c for c in index.columns if c not in FILE]
    annual = index.filter(sources.is_annual(F.col("type"))).groupBy(*FILE).agg(F.min(F.struct(*rest)).alias("_r")).select(*FILE, "_r.*")
    ids = numbers.select(*[F.col(c).alias(f"_{c}") for c in FILE], "filing_id")
    return annual.join(ids, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in FILE]).select("filing_id", *index.columns)


def parsed_submissions(filings: DataFrame, submissions: DataFrame, lookups: dict[str, DataFrame], base_url: str, first_id: int = 0) -> dict[str, DataFrame]:
    """documents (filing_id, has_sec21, sec_21_url and what parse_accounting() counts), relationships and bad_locations of submissions.

    filings has (filing_id, filename); submissions (filing_id, content), of which those of other filings are left out. Relationships
    are numbered from first_id + 1.
    """
    found = filings.select("filing_id", "filename").join(submissions, "filing_id")
    found = written(sources.with_exhibits(found, base_url).select("filing_id", F.col("exhibit").alias("content"), "has_sec21", "sec_21_url"), "exhibits")
    places = locate.Places(lookups["countries"], lookups["aliases"], lookups["subdivisions"])
    with_exhibit = found.filter("has_sec21").select("filing_id", "content")
    rows, bad = exhibits.extract_subsidiaries(with_exhibit, places, lookups["stop_terms"])
    rows = relational.surrogate_ids(written(rows, "subsidiaries"), ["filing_id", "table_num", "row_num", "seq"], "relationship_id", first_id)
    rows = written(rows, "relationships")
    documents = found.drop("content").join(exhibits.parse_accounting(with_exhibit, rows), "filing_id", "left")
    return {"documents": written(documents, "documents"), "relationships": rows, "bad_locations": bad}


def with_documents(filings: DataFrame, documents: DataFrame) -> DataFrame:
    """filings with what is known of their submissions; one without a submission has no exhibit."""
    return filings.join(documents, "filing_id", "left").withColumn("has_sec21", F.coalesce("has_sec21", F.lit(False)))


def parsed_headers(filings: DataFrame, pages: DataFrame, region_codes: DataFrame) -> DataFrame:
    """The filers of header pages (filing_id, content)."""
    pages = pages.join(filings.select("filing_id", "cik"), "filing_id")
    limit = 100_000  # codes that every task gets
    states = [r.code for r in region_codes.select("code").distinct().limit(limit + 1).collect()]
    if len(states) > limit:
        raise ValueError(f"more than {limit} region codes")
    filers = sources.typed_filers(sources.header_rows(pages, states)).join(filings.select("filing_id", "year"), "filing_id")
    none = F.lit(None).cast("string")
    return written(filers.withColumns({"filer_id": F.col("filing_id"), "incorp_country_code": none, "incorp_subdiv_code": none, "bad_cik": F.lit(0).cast("byte")}), "filers")


def published(tables: dict[str, DataFrame], lookups: dict[str, DataFrame], names: DataFrame, years: list[int], base_url: str) -> dict[str, DataFrame]:
    """company_graph() of parsed filings, filers and relationships, and the former two."""
    spark, registry = names.sparkSession, lookups.get("registry")
    tables = tables | {"filings": written(tables["filings"], "filings")} | {
        "registry": registry if registry is not None else spark.createDataFrame([], resolve.REGISTRY), "master_names": relational.surrogate_ids(names.distinct(), ["cik", "name"], "row_id"),
        **{k: lookups[k] for k in ("region_codes", "sic_codes", "sic_sectors")},
    }
    return company_graph(tables, years, base_url) | {"filings": tables["filings"], "filers": tables["filers"]}


def run(spark: SparkSession, source: str, target: str, years: list[int]) -> None:
    """Reads the INPUTS from a folder of Parquet tables and writes the published ones to another."""
    made = company_graph({name: spark.read.parquet(f"{source}/{name}") for name in INPUTS}, years)
    for name, table in made.items():
        table.write.mode("overwrite").parquet(f"{target}/{name}")


def next_registry(registry: DataFrame) -> DataFrame:
    """The registry to give the next build: one row a key, the first identifier."""
    keys = ["company_name", "cik", "country_code", "subdiv_code"]
    first = Window.partitionBy(*keys).orderBy("cw_id")
    return registry.withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n", "orphaned")
