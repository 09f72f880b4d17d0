"""Queries of the entity-resolution plan over the stand-in filing tables, beside their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.operators import facts, graph, locate, relational, report, resolve
from corvane.plans import standin as S
from corvane.plans.registry import Tables, query
from corvane.sources import filings as raw

_ALL = f"WITH {S.FILINGS}, {S.FILERS}, {S.RELATIONSHIPS}"
_RESOLVED_FILERS = """known AS (SELECT cik, min(cw_id) AS cw_id FROM registry WHERE cik <> 0 GROUP BY 1),
ent AS (SELECT cik, min(filer_id) AS source_id, arg_min(match_name, filer_id) AS company_name FROM filers GROUP BY 1),
companies AS (SELECT coalesce(k.cw_id, (SELECT max(cw_id) FROM registry) + row_number() OVER (PARTITION BY k.cw_id IS NULL ORDER BY e.cik)) AS cw_id, e.cik, e.company_name, e.source_id FROM ent e LEFT JOIN known k USING (cik))"""


@query(f"{_ALL}, {S.REGISTRY}, {_RESOLVED_FILERS} SELECT cw_id, cik, company_name, 'filers' AS source_type, source_id FROM companies")
def resolve_filers(spark: SparkSession, t: Tables) -> DataFrame:
    return resolve.resolve_filers(S.filers(t), S.registry(t))[1]


_RESOLVED = f"""{_RESOLVED_FILERS},
fid AS (SELECT f.* EXCLUDE (cw_id), c.cw_id FROM filers f JOIN companies c USING (cik)),
reg AS (SELECT * FROM registry UNION SELECT c.cw_id, c.company_name, c.cik, incorp_country_code, coalesce(incorp_subdiv_code, '') FROM companies c JOIN filers USING (cik)),
r AS (SELECT relationship_id, lower(clean_company) AS name, coalesce(country_code, '') AS cc, coalesce(subdiv_code, '') AS sc, year FROM relationships),
a1 AS (SELECT lower(company_name) AS name, country_code AS cc, subdiv_code AS sc, min(cw_id) AS cw FROM reg WHERE cik = 0 AND country_code <> '' GROUP BY 1, 2, 3),
a2 AS (SELECT lower(match_name) AS name, incorp_country_code AS cc, coalesce(incorp_subdiv_code, '') AS sc, year, min(cw_id) AS cw FROM fid GROUP BY 1, 2, 3, 4),
m AS (SELECT lower(match_name) AS name, min(cik) AS cik FROM master WHERE cik <> 0 GROUP BY 1),
s2 AS (SELECT r.*, coalesce(a1.cw, a2.cw) AS cw, CASE WHEN coalesce(a1.cw, a2.cw) IS NULL THEN m.cik END AS cik FROM r LEFT JOIN a1 USING (name, cc, sc) LEFT JOIN a2 USING (name, cc, sc, year) LEFT JOIN m USING (name)),
k1 AS (SELECT cik, min(cw_id) AS kcw FROM reg WHERE cik <> 0 GROUP BY 1), s3 AS (SELECT s2.* EXCLUDE (cw), coalesce(cw, kcw) AS cw FROM s2 LEFT JOIN k1 USING (cik)),
k2 AS (SELECT cw_id AS cw, min(cik) AS kcik FROM reg WHERE cik <> 0 GROUP BY 1), s4 AS (SELECT s3.* EXCLUDE (cik), coalesce(cik, kcik) AS cik FROM s3 LEFT JOIN k2 USING (cw)),
c2 AS (SELECT cw_id, cik FROM companies UNION ALL SELECT cw, arg_min({{'c': cik}}, relationship_id).c FROM s4 WHERE cw IS NOT NULL AND cw NOT IN (SELECT cw_id FROM companies) GROUP BY 1),
k3 AS (SELECT cik, min(cw_id) AS ccw FROM c2 WHERE cik IS NOT NULL GROUP BY 1), s5 AS (SELECT s4.* EXCLUDE (cw), coalesce(cw, ccw) AS cw FROM s4 LEFT JOIN k3 USING (cik)),
neu AS (SELECT name, cc, sc, row_number() OVER (ORDER BY name, cc, sc) + greatest((SELECT max(cw_id) FROM reg), (SELECT max(cw_id) FROM c2)) AS ncw FROM (SELECT DISTINCT name, cc, sc FROM s5 WHERE cw IS NULL))"""


@query(f"{_ALL}, {S.REGISTRY}, {S.MASTER}, {_RESOLVED} SELECT relationship_id, coalesce(cw, ncw) AS cw_id, cik FROM s5 LEFT JOIN neu USING (name, cc, sc)")
def resolve_relationships(spark: SparkSession, t: Tables) -> DataFrame:
    filers, companies, registry = resolve.resolve_filers(S.filers(t), S.registry(t))
    got = resolve.resolve_relationships(S.relationships(t), filers, companies, registry, S.master_names(t))
    return got.relationships.select("relationship_id", "cw_id", "cik")


_SUPPRESSED = """known AS (SELECT cik, min(cw_id) AS reg FROM registry WHERE cik <> 0 GROUP BY 1), f AS (SELECT filers.*, reg FROM filers LEFT JOIN known USING (cik)),
bad AS (SELECT b.filer_id, min(CASE WHEN a.reg IS NOT NULL AND (b.reg IS NULL OR b.reg > a.reg) THEN CASE WHEN a.sec_21 THEN 1 ELSE 2 END WHEN a.cik > b.cik THEN CASE WHEN a.sec_21 THEN 3 ELSE 4 END END) AS code
  FROM f a JOIN f b ON lower(a.match_name) = lower(b.match_name) AND a.year = b.year AND a.cik <> b.cik AND a.incorp_country_code IS NOT DISTINCT FROM b.incorp_country_code
  AND a.incorp_subdiv_code IS NOT DISTINCT FROM b.incorp_subdiv_code WHERE NOT b.sec_21 GROUP BY 1)"""


@query(f"{_ALL}, {S.REGISTRY}, {_SUPPRESSED} SELECT filer_id, code::INT AS code FROM bad WHERE code IS NOT NULL")
def suppressed_filers(spark: SparkSession, t: Tables) -> DataFrame:
    return resolve.suppressed_filers(S.filers(t), S.registry(t)).select("filer_id", F.col("code").cast("int").alias("code"))


@query(f"""{_ALL}, {S.REGISTRY}, {_SUPPRESSED}, x AS (SELECT f.filer_id, f.filing_id, f.cik, coalesce(code, 0) AS bad FROM f LEFT JOIN bad USING (filer_id)),
ok AS (SELECT DISTINCT cik FROM x WHERE bad = 0), own AS (SELECT DISTINCT filing_id FROM filings SEMI JOIN ok USING (cik))
SELECT filer_id, bad::INT AS bad_cik, CASE WHEN bad = 0 OR filing_id IN (SELECT filing_id FROM own) THEN cik END AS cik FROM x""")
def hide_suppressed(spark: SparkSession, t: Tables) -> DataFrame:
    got = resolve.hide_suppressed(S.filers(t), S.registry(t), S.filings(t))
    return got.select("filer_id", F.col("bad_cik").cast("int").alias("bad_cik"), "cik")


@query(f"""{_ALL} SELECT relationship_id, CASE WHEN relationship_id % 5 = 0 THEN 77 ELSE filer_cik + 10 END AS parent_cw_id FROM relationships""")
def default_parents(spark: SparkSession, t: Tables) -> DataFrame:
    r = S.relationships(t).withColumn("parent_cw_id", F.when(F.col("relationship_id") % 5 == 0, F.lit(77).cast("long")))
    companies = S.placed_filers(t).select("cw_id", "cik").distinct()
    return resolve.default_parents(r, S.filings(t), companies).select("relationship_id", "parent_cw_id")


@query(f"WITH {S.REGISTRY} SELECT cw_id, company_name, cw_id NOT IN (SELECT c_custkey + 10 FROM customer WHERE c_custkey % 2 = 0) AS orphaned FROM registry")
def orphan_flags(spark: SparkSession, t: Tables) -> DataFrame:
    live = t.customer.filter("c_custkey % 2 = 0").select((F.col("c_custkey") + 10).alias("cw_id"))
    return resolve.orphan_flags(S.registry(t), live).select("cw_id", "company_name", "orphaned")


@query(f"""WITH {S.REGISTRY}, n AS (SELECT c_custkey + 10 AS cw_id, 'Alias ' || c_custkey % 9 AS company_name, c_custkey AS cik, 'R9' AS country_code, '' AS subdiv_code FROM customer WHERE c_custkey % 2 = 1)
SELECT cw_id, company_name, cik, country_code, subdiv_code FROM registry UNION SELECT * FROM n""")
def register_companies(spark: SparkSession, t: Tables) -> DataFrame:
    odd = t.customer.filter("c_custkey % 2 = 1")
    companies = odd.select((F.col("c_custkey") + 10).alias("cw_id"), F.col("c_custkey").alias("cik"))
    names = odd.select((F.col("c_custkey") + 10).alias("cw_id"), F.concat(F.lit("Alias "), (F.col("c_custkey") % 9).cast("string")).alias("company_name"), F.lit("filer_match_name").alias("source"))
    places = companies.select("cw_id", F.lit("R9").alias("country_code"), F.lit(None).cast("string").alias("subdiv_code"))
    return resolve.register(S.registry(t), companies, names, places).drop("source")


@query("""WITH s AS (SELECT p_partkey, trim(replace(replace(p_name, 'widget', ''), 'small', '')) AS name FROM part) SELECT * FROM s WHERE name <> ''""")
def strip_strings(spark: SparkSession, t: Tables) -> DataFrame:
    return resolve.strip_strings(t.part.select("p_partkey", F.col("p_name").alias("name")), "name", ["widget", "small"])


_INFO = f"""{S.EDGES}, info0 AS (SELECT target AS cw_id, year FROM edges UNION SELECT cw_id, year FROM filers),
ff AS (SELECT cw_id, year, min(filer_id) AS fid, arg_min(cik, filer_id) AS fcik, arg_min(match_name, filer_id) AS fname, max(irs_number) AS irs_number, max(sic_code) AS sic_code FROM filers GROUP BY 1, 2),
rr AS (SELECT cw_id, year, min(relationship_id) AS rid, arg_min(clean_company, relationship_id) AS rname FROM relationships GROUP BY 1, 2),
info AS (SELECT i.cw_id, i.year, fcik AS cik, irs_number, sic_code, coalesce(fname, rname) AS company_name, CASE WHEN fname IS NOT NULL THEN 'filers' WHEN rname IS NOT NULL THEN 'relationships' END AS source_type, coalesce(fid, rid) AS source_id
  FROM info0 i LEFT JOIN ff USING (cw_id, year) LEFT JOIN rr USING (cw_id, year))"""


def _info(t: Tables) -> DataFrame:
    return facts.describe(facts.company_years(S.edges(t), S.placed_filers(t)), S.placed_filers(t), S.placed_relationships(t))


@query(f"{_ALL}, {_INFO} SELECT * FROM info")
def company_info(spark: SparkSession, t: Tables) -> DataFrame:
    return _info(t)


@query(f"""{_ALL}, {_INFO} SELECT cw_id, year, CASE WHEN sic_code IS NOT NULL AND sic_code < 15 THEN 'industry ' || sic_code END AS industry_name,
  CASE WHEN sic_code < 15 THEN sic_code % 4 END::INT AS sic_sector, CASE WHEN sic_code < 15 THEN 'sector ' || sic_code % 4 END AS sector_name FROM info""")
def company_sectors(spark: SparkSession, t: Tables) -> DataFrame:
    codes = spark.createDataFrame([(i, f"industry {i}", i % 4) for i in range(15)], "sic_code int, industry_name string, sic_sector int")
    sectors = spark.createDataFrame([(i, f"sector {i}") for i in range(4)], "sic_sector int, sector_name string")
    return facts.with_sectors(_info(t), codes, sectors).select("cw_id", "year", "industry_name", "sic_sector", "sector_name")


@query(f"""{_ALL}, {S.MASTER}, {_INFO}, fi AS (SELECT f.*, g.filing_date FROM filers f JOIN filings g USING (filing_id)), ri AS (SELECT r.*, g.filing_date FROM relationships r JOIN filings g USING (filing_id)
  WHERE cw_id IN (SELECT cw_id FROM info WHERE source_type = 'relationships')),
a AS (SELECT cw_id, match_name AS company_name, 'filer_match_name' AS source, min(filer_id) AS source_row_id, min(filing_date) AS date, year(min(filing_date)) AS min_year, year(max(filing_date)) AS max_year FROM fi GROUP BY 1, 2),
b AS (SELECT cw_id, conformed_name, 'filer_conformed_name', min(filer_id), min(filing_date), year(min(filing_date)), year(max(filing_date)) FROM fi WHERE conformed_name <> match_name GROUP BY 1, 2),
l AS (SELECT i.cw_id, m.match_name AS former, m.row_id FROM master m JOIN (SELECT cik, min(cw_id) AS cw_id FROM info WHERE cik IS NOT NULL GROUP BY 1) i USING (cik)),
c AS (SELECT a.cw_id, former, 'cik_former_name', min(row_id), NULL::DATE, min(i.year), max(i.year) FROM a JOIN info i ON i.cw_id = a.cw_id AND i.year BETWEEN min_year AND max_year JOIN l ON l.cw_id = a.cw_id AND former <> a.company_name GROUP BY 1, 2),
d AS (SELECT cw_id, company_name, 'relationships_company_name', min(relationship_id), min(filing_date), year(min(filing_date)), year(max(filing_date)) FROM ri GROUP BY 1, 2),
e AS (SELECT cw_id, clean_company, 'relationships_clean_company', min(relationship_id), min(filing_date), year(min(filing_date)), year(max(filing_date)) FROM ri WHERE company_name <> clean_company GROUP BY 1, 2)
SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c UNION ALL SELECT * FROM d UNION ALL SELECT * FROM e""")
def company_names(spark: SparkSession, t: Tables) -> DataFrame:
    got = facts.company_names(S.placed_filers(t), S.placed_relationships(t), S.filings(t), _info(t), S.master_names(t))
    return got.drop("country_code", "subdiv_code")


@query(f"""{_ALL}, {_INFO}, fi AS (SELECT f.*, g.year AS gy FROM filers f JOIN filings g USING (filing_id)),
ri AS (SELECT r.*, g.year AS gy FROM relationships r JOIN filings g USING (filing_id) WHERE location IS NOT NULL AND cw_id IN (SELECT cw_id FROM info WHERE source_type = 'relationships')),
u AS (SELECT cw_id, 'business' AS type, business_raw_address AS raw_address, arg_min(business_state, filer_id) AS state, NULL AS cc, NULL AS sc, min(gy) AS min_year, max(gy) AS max_year FROM fi WHERE business_street_1 IS NOT NULL GROUP BY cw_id, business_raw_address
UNION ALL SELECT cw_id, 'mailing', mail_raw_address, arg_min(mail_state, filer_id), NULL, NULL, min(gy), max(gy) FROM fi WHERE mail_street_1 IS NOT NULL GROUP BY cw_id, mail_raw_address
UNION ALL SELECT cw_id, 'state_of_incorp', state_of_incorporation, NULL, arg_min(incorp_country_code, filer_id), arg_min({{'x': incorp_subdiv_code}}, filer_id).x, min(gy), max(gy) FROM fi WHERE state_of_incorporation IS NOT NULL GROUP BY cw_id, state_of_incorporation
UNION ALL SELECT cw_id, 'relation_loc', arg_min(location, relationship_id), NULL, country_code, subdiv_code, min(gy), max(gy) FROM ri GROUP BY cw_id, country_code, subdiv_code)
SELECT cw_id, type, raw_address, state, CASE WHEN state LIKE 'S%' THEN 'US' ELSE cc END AS country_code, CASE WHEN state LIKE 'S%' THEN 'X' || substr(state, 2) ELSE sc END AS subdiv_code, min_year, max_year FROM u""")
def company_locations(spark: SparkSession, t: Tables) -> DataFrame:
    codes = spark.range(25).select(S.text("S{i}", i=F.col("id")).alias("code"), F.lit("US").alias("country_code"), S.text("X{i}", i=F.col("id")).alias("subdiv_code"))
    got = facts.company_locations(S.placed_filers(t), S.placed_relationships(t), S.filings(t), _info(t), codes)
    return got.drop("street_1", "date")


@query("""WITH i AS (SELECT DISTINCT o_custkey AS cw_id, year(o_orderdate) AS year, CASE WHEN o_custkey % 3 = 0 THEN o_custkey * 10 END AS location_id FROM orders),
l AS (SELECT o_orderkey AS location_id, o_custkey AS cw_id, CASE WHEN o_orderkey % 4 = 0 THEN 'US' END AS country_code FROM orders)
SELECT i.cw_id, i.year, CASE WHEN l.country_code IS NOT NULL THEN i.location_id ELSE coalesce(a.any_id, i.location_id) END AS location_id
FROM i LEFT JOIN l ON l.location_id = i.location_id LEFT JOIN (SELECT cw_id, max(location_id) AS any_id FROM l WHERE country_code IS NOT NULL GROUP BY 1) a ON a.cw_id = i.cw_id""")
def location_fallback(spark: SparkSession, t: Tables) -> DataFrame:
    info = t.orders.select(F.col("o_custkey").alias("cw_id"), F.year("o_orderdate").alias("year"), F.when(F.col("o_custkey") % 3 == 0, F.col("o_custkey") * 10).alias("location_id")).distinct()
    places = t.orders.select(F.col("o_orderkey").alias("location_id"), F.col("o_custkey").alias("cw_id"), F.when(F.col("o_orderkey") % 4 == 0, "US").alias("country_code"))
    return locate.fill_locations(info, places)


@query("""WITH i AS (SELECT DISTINCT o_custkey AS cw_id, year(o_orderdate) AS year FROM orders), n AS (SELECT c_custkey AS cw_id, (1995 + c_custkey % 8)::INT AS max_year FROM customer)
SELECT cw_id, max_year, EXISTS (SELECT 1 FROM i WHERE i.cw_id = n.cw_id AND i.year = n.max_year) AS most_recent FROM n""")
def recent_flags(spark: SparkSession, t: Tables) -> DataFrame:
    info = t.orders.select(F.col("o_custkey").alias("cw_id"), F.year("o_orderdate").alias("year")).distinct()
    return facts.flag_recent(t.customer.select(F.col("c_custkey").alias("cw_id"), (F.col("c_custkey") % 8 + 1995).cast("int").alias("max_year")), info)


_LOOKUP = """own AS (SELECT DISTINCT f.cw_id, g.filing_id FROM filers f JOIN filings g ON f.cik = g.cik WHERE g.type LIKE '10-K%'),
lookup AS (SELECT cw_id, filing_id, true AS company_is_filer FROM own UNION ALL SELECT DISTINCT cw_id, filing_id, false FROM relationships r WHERE cw_id <> parent_cw_id
  AND NOT EXISTS (SELECT 1 FROM own WHERE own.cw_id = r.cw_id AND own.filing_id = r.filing_id))"""


@query(f"{_ALL}, {_LOOKUP} SELECT * FROM lookup")
def filings_lookup(spark: SparkSession, t: Tables) -> DataFrame:
    return facts.filings_lookup(S.placed_filers(t), S.filings(t), S.placed_relationships(t))


@query(f"{_ALL}, {_LOOKUP} SELECT filing_id, cik, year, quarter, 'https://example.org/' || filename AS form_url FROM filings WHERE filing_id IN (SELECT filing_id FROM lookup)")
def company_filings(spark: SparkSession, t: Tables) -> DataFrame:
    lookup = facts.filings_lookup(S.placed_filers(t), S.filings(t), S.placed_relationships(t))
    return facts.published_filings(S.filings(t), lookup, "https://example.org/").drop("filing_date", "sec_21_url")


@query(f"""{_ALL}, {_INFO}, deg AS (SELECT i.*, coalesce(c.n, 0) AS nc, coalesce(p.n, 0) AS np FROM info i LEFT JOIN (SELECT source AS cw_id, year, count(DISTINCT target) AS n FROM edges GROUP BY 1, 2) c USING (cw_id, year)
  LEFT JOIN (SELECT target AS cw_id, year, count(DISTINCT source) AS n FROM edges GROUP BY 1, 2) p USING (cw_id, year)),
base AS (SELECT year, count(*) FILTER (has_sec21) AS e, count(*) FILTER (filing_id IN (SELECT filing_id FROM relationships)) AS p, count(*) FILTER (filing_id % 6 = 0) AS z FROM filings GROUP BY 1),
long AS (SELECT year, 'filing_companies' AS metric, count(*)::DOUBLE AS value FROM filers GROUP BY 1
UNION ALL SELECT year, unnest(['with_exhibit', 'parsed', 'empty', 'percent_parsed', 'percent_true_parsed']), unnest([e::DOUBLE, p::DOUBLE, z::DOUBLE, p / nullif(e, 0)::DOUBLE * 100, p / nullif(e - z, 0)::DOUBLE * 100]) FROM base
UNION ALL SELECT year, 'relationships', count(*) FROM relationships GROUP BY 1 UNION ALL SELECT year, 'companies', count(*) FROM info GROUP BY 1 UNION ALL SELECT year, 'company_relations', count(*) FROM edges GROUP BY 1
UNION ALL SELECT year, 'isolated', count(DISTINCT cw_id) FROM deg WHERE nc = 0 AND np = 0 GROUP BY 1
UNION ALL SELECT year, 'top_level', count(DISTINCT cw_id) FROM info i WHERE NOT EXISTS (SELECT 1 FROM edges e WHERE e.target = i.cw_id AND e.year = i.year) GROUP BY 1
UNION ALL SELECT year, 'top_level_with_children', count(DISTINCT cw_id) FROM info i WHERE EXISTS (SELECT 1 FROM edges e WHERE e.source = i.cw_id AND e.year = i.year) AND NOT EXISTS (SELECT 1 FROM edges e WHERE e.target = i.cw_id) GROUP BY 1
UNION ALL SELECT g.year, 'filers_with_hierarchy', count(DISTINCT i.cw_id) FROM relationships r JOIN filings g USING (filing_id) JOIN info i ON i.cik = g.cik AND i.year = g.year WHERE parent_cw_id <> i.cw_id OR relationship_id % 7 = 0 GROUP BY 1)
SELECT year, metric, round(value, 6) AS value FROM long""")
def coverage_metrics(spark: SparkSession, t: Tables) -> DataFrame:
    filings = S.filings(t)
    empty = filings.filter("filing_id % 6 = 0").select("filing_id", F.lit(1).alias("code"))
    r = S.placed_relationships(t).withColumn("parent_cw_id", F.when(F.col("relationship_id") % 7 == 0, F.lit(-1).cast("long")).otherwise(F.col("parent_cw_id")))
    info = graph.degrees(_info(t), S.edges(t))
    got = report.coverage_metrics(filings, S.filers(t), r, empty, info, S.edges(t))
    return got.select("year", "metric", F.round("value", 6).alias("value"))


@query(f"""WITH {S.FILINGS}, u AS (SELECT cik, year, max(filing_id) AS filing_id FROM filings WHERE cik <> 0 AND NOT bad_header AND type NOT IN ('4', 'REGDEX') GROUP BY 1, 2)
SELECT cik, year, filing_id FROM u WHERE NOT EXISTS (SELECT 1 FROM filings g WHERE g.cik = u.cik AND g.year = u.year AND g.filing_id % 9 = 0)""")
def header_candidates(spark: SparkSession, t: Tables) -> DataFrame:
    f = S.filings(t)
    return raw.header_candidates(f, f.filter("filing_id % 9 = 0").select("cik", "year", "filing_id")).select("cik", "year", "filing_id")


@query(f"{_ALL} SELECT filing_id FROM filings WHERE has_sec21 AND NOT bad_sec21 AND filing_id NOT IN (SELECT filing_id FROM relationships WHERE relationship_id % 11 < 4)")
def filings_to_parse(spark: SparkSession, t: Tables) -> DataFrame:
    return raw.to_parse(S.filings(t), S.relationships(t).filter("relationship_id % 11 < 4")).select("filing_id")


@query(f"""WITH {S.FILINGS} SELECT cik, filename, type, year FROM filings f WHERE filing_id % 3 <> 1""")
def new_index_rows(spark: SparkSession, t: Tables) -> DataFrame:
    f = S.filings(t).select("cik", "filename", "type", "year", "filing_id")
    return raw.new_index_rows(f.unionByName(f.limit(0)).drop("filing_id"), f.filter("filing_id % 3 = 1")).select("cik", "filename", "type", "year")


@query(f"""WITH {S.FILINGS} SELECT filing_id, 'file' AS gone FROM filings WHERE filing_id % 5 = 0 AND filing_id % 4 <> 0 UNION ALL SELECT filing_id, 'row' FROM filings WHERE filing_id % 4 = 0 AND filing_id % 5 <> 0""")
def reconcile_files(spark: SparkSession, t: Tables) -> DataFrame:
    from corvane.sources.sinks import reconcile

    f = S.filings(t).select("filing_id")
    files, rows = reconcile(f.filter("filing_id % 5 = 0"), f.filter("filing_id % 4 = 0"), ["filing_id"])
    return files.withColumn("gone", F.lit("file")).unionByName(rows.withColumn("gone", F.lit("row")))


@query("""SELECT c_custkey, 'US' AS country_code FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT c_custkey, NULL FROM customer WHERE c_custkey % 3 <> 0""")
def reject_split(spark: SparkSession, t: Tables) -> DataFrame:
    from corvane.sources.sinks import split_rejects

    kept, bad = split_rejects(t.customer.select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, "US").alias("country_code")))
    return kept.unionByName(bad)


@query("""SELECT * FROM (SELECT o_orderkey AS id, row_number() OVER (ORDER BY md5(o_orderkey::VARCHAR), o_orderkey) AS n FROM orders) WHERE n <= 20""")
def random_sample(spark: SparkSession, t: Tables) -> DataFrame:
    """A sample of 20 rows in a reproducible random order (the limit is the feature)."""
    top = t.orders.select(F.col("o_orderkey").alias("id"), F.md5(F.col("o_orderkey").cast("string")).alias("h")).orderBy("h", "id").limit(20)
    return relational.surrogate_ids(top, ["h", "id"], "n").select("id", "n")


@query(f"{_ALL} SELECT relationship_id, filer_cik, year, quarter FROM relationships JOIN (SELECT filing_id, quarter FROM filings) USING (filing_id)")
def relation_filing_fields(spark: SparkSession, t: Tables) -> DataFrame:
    return facts.filing_fields(S.relationships(t).drop("filer_cik", "year"), S.filings(t)).select("relationship_id", "filer_cik", "year", "quarter")


@query(f"{_ALL} SELECT filer_id, EXISTS (SELECT 1 FROM filings g WHERE g.cik = f.cik AND g.year = f.year AND has_sec21) AS sec_21 FROM filers f")
def exhibit_flags(spark: SparkSession, t: Tables) -> DataFrame:
    return facts.exhibit_flags(S.filers(t), S.filings(t)).select("filer_id", "sec_21")


@query(f"""{_ALL}, c AS (SELECT country_code AS code FROM relationships UNION ALL SELECT country_code || ':' || subdiv_code FROM relationships WHERE subdiv_code IS NOT NULL)
SELECT code, count(*) AS count, round(1 / (ln(count(*)) + 1), 9) AS weight FROM c GROUP BY 1""")
def location_weights(spark: SparkSession, t: Tables) -> DataFrame:
    return facts.location_weights(S.relationships(t)).withColumn("weight", F.round("weight", 9))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_nationkey * 1.5::DOUBLE END AS latitude, CASE WHEN c_custkey % 2 = 0 THEN c_nationkey * -2.0::DOUBLE END AS longitude FROM customer""")
def place_coordinates(spark: SparkSession, t: Tables) -> DataFrame:
    n = F.col("n_nationkey")
    gazetteer = t.nation.select(F.lit("XX").alias("country_code"), F.lower("n_name").alias("place"), (n * 1.5).alias("latitude"), (n * -2.0).alias("longitude"))
    city = F.when(F.col("c_custkey") % 2 == 0, S.text("Nation_{n}", n=F.col("c_nationkey"))).otherwise("nowhere")
    rows = t.customer.select("c_custkey", F.lit("XX").alias("country_code"), city.alias("city"))
    return facts.with_coordinates(rows, gazetteer).select("c_custkey", "latitude", "longitude")


@query()
def company_graph(spark: SparkSession, t: Tables) -> DataFrame:
    """The whole build; its parts have SQL of their own, this query shows that they fit together."""
    from corvane.plans.build import company_graph as build

    states = spark.range(25).select(S.text("S{i}", i=F.col("id")).alias("code"), F.lit("US").alias("country_code"), S.text("X{i}", i=F.col("id")).alias("subdiv_code"))
    codes = spark.createDataFrame([(i, f"industry {i}", i % 4) for i in range(15)], "sic_code int, industry_name string, sic_sector int")
    sectors = spark.createDataFrame([(i, f"sector {i}") for i in range(4)], "sic_sector int, sector_name string")
    filers = S.filers(t).withColumn("filing_id", F.col("filer_id"))
    tables = {
        "filings": S.filings(t), "filers": filers, "relationships": S.relationships(t).drop("clean_company"), "registry": S.registry(t), "master_names": S.master_names(t),
        "region_codes": states, "sic_codes": codes, "sic_sectors": sectors,
    }
    made = build(tables, list(range(1995, 2003)))
    out = None
    for name in ("companies", "company_info", "company_names", "company_locations", "company_relations", "company_filings", "filings_lookup", "registry"):
        one = made[name].agg(F.count("*").alias("rows")).select(F.lit(name).alias("name"), "rows")
        out = one if out is None else out.unionByName(one)
    return out
