"""Filing tables made from the driver's orders, customers and suppliers, in Spark and as SQL: the same rows by key arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.operators.relational import latest
from corvane.plans.registry import Tables


def text(template: str, **keys: Column) -> Column:
    parts = []
    rest = template
    for name, column in keys.items():
        before, rest = rest.split("{" + name + "}", 1)
        parts += [F.lit(before), column.cast("string")]
    return F.concat(*parts, F.lit(rest))


def filings(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    return t.orders.select(
        k.alias("filing_id"), F.col("o_custkey").alias("cik"), F.year("o_orderdate").alias("year"), F.quarter("o_orderdate").alias("quarter"),
        F.to_date("o_orderdate").alias("filing_date"), F.element_at(F.array(F.lit("10-K"), F.lit("10-K/A"), F.lit("8-K")), (k % 3 + 1).cast("int")).alias("type"),
        (k % 2 == 0).alias("has_sec21"), text("f/{k}.txt", k=k).alias("filename"), F.lit(None).cast("string").alias("sec_21_url"), (k % 17 == 0).alias("bad_header"),
        (k % 19 == 0).alias("bad_sec21"),
    )


def filers(t: Tables) -> DataFrame:
    f = latest(filings(t).select("cik", "year", "filing_id"), ["cik", "year"], ["filing_id"])
    c = F.col("cik")
    return f.select(
        F.col("filing_id").alias("filer_id"), "filing_id", "cik", "year", text("Customer {c} Corporation", c=c % 400).alias("conformed_name"),
        F.when(c % 6 == 0, text("Customer {c} Corporation", c=c % 400)).otherwise(text("Customer {c} Corp", c=c % 400)).alias("match_name"),
        (c % 50).cast("int").alias("irs_number"), (c % 20).cast("int").alias("sic_code"), text("R{c}", c=c % 5).alias("incorp_country_code"),
        F.when(c % 4 != 0, text("N{c}", c=c % 25)).alias("incorp_subdiv_code"), F.when(c % 3 != 0, text("S{c}", c=c % 25)).alias("state_of_incorporation"),
        F.when(c % 2 == 0, text("{c} Main St", c=c)).alias("business_street_1"), text("{c} Main St, City", c=c).alias("business_raw_address"), text("S{c}", c=c % 25).alias("business_state"),
        F.when(c % 5 == 0, text("Box {c}", c=c)).alias("mail_street_1"), text("Box {c}, Town", c=c).alias("mail_raw_address"), text("T{c}", c=c % 25).alias("mail_state"),
        (F.col("filing_id") % 2 == 0).alias("sec_21"),
    )


def relationships(t: Tables) -> DataFrame:
    f = filings(t).filter("has_sec21").select("filing_id", F.col("cik").alias("filer_cik"), "year", F.explode(F.array(*[F.lit(k) for k in range(3)])).alias("k"))
    n = F.col("filing_id") + F.col("k")
    sub = (F.col("filing_id") * 7 + F.col("k")) % 300
    return f.select(
        (F.col("filing_id") * 3 + F.col("k")).alias("relationship_id"), "filing_id", "filer_cik", "year",
        F.when(n % 4 == 0, text("Customer {c} Corp", c=F.col("filing_id") % 400)).otherwise(text("Sub {s} Limited", s=sub)).alias("company_name"),
        F.when(n % 4 == 0, text("Customer {c} Corp", c=F.col("filing_id") % 400)).otherwise(text("Sub {s} Ltd", s=sub)).alias("clean_company"),
        text("R{n}", n=n % 5).alias("country_code"), F.when(n % 3 != 0, text("N{n}", n=n % 25)).alias("subdiv_code"), F.when(n % 8 != 0, text("place {n}", n=n % 40)).alias("location"),
        (F.col("k") % 2).alias("hierarchy"),
    )


def registry(t: Tables) -> DataFrame:
    c = F.col("c_custkey")
    own = t.customer.filter("c_custkey % 3 = 0 and c_custkey > 0").select(
        (c + 10).alias("cw_id"), text("Customer {c} Corp", c=c % 400).alias("company_name"), c.alias("cik"), text("R{c}", c=c % 5).alias("country_code"),
        F.when(c % 4 != 0, text("N{c}", c=c % 25)).otherwise("").alias("subdiv_code"), F.lit("filers").alias("source"),
    )
    subs = t.customer.filter("c_custkey < 60").select(
        (c + 100000).alias("cw_id"), text("Sub {c} Ltd", c=c).alias("company_name"), F.lit(0).cast("long").alias("cik"), text("R{c}", c=c % 5).alias("country_code"),
        F.lit("").alias("subdiv_code"), F.lit("relationships").alias("source"),
    )
    return own.unionByName(subs)


def master_names(t: Tables) -> DataFrame:
    s = F.col("s_suppkey")
    return t.supplier.select(s.alias("row_id"), text("Sub {s} Ltd", s=s).alias("match_name"), F.when(s % 10 == 0, s).otherwise(s % 30 + 50000).alias("cik"))


def placed_filers(t: Tables) -> DataFrame:
    return filers(t).withColumn("cw_id", F.col("cik") + 10)


def placed_relationships(t: Tables) -> DataFrame:
    n = F.col("filing_id") + F.col("relationship_id") % 3
    sub = (F.col("filing_id") * 7 + F.col("relationship_id") % 3) % 300
    own = F.when(n % 4 == 0, F.col("filing_id") % 400 + 10).otherwise(sub + 100000)
    return relationships(t).withColumn("cw_id", own).withColumn("parent_cw_id", F.col("filer_cik") + 10).withColumn("cik", F.lit(None).cast("long"))


def edges(t: Tables) -> DataFrame:
    r = placed_relationships(t).filter("cw_id <> parent_cw_id")
    return r.select(F.col("parent_cw_id").alias("source"), F.col("cw_id").alias("target"), "year").distinct()


FILINGS = """filings AS (SELECT o_orderkey AS filing_id, o_custkey AS cik, year(o_orderdate) AS year, quarter(o_orderdate) AS quarter, o_orderdate::DATE AS filing_date,
  ['10-K', '10-K/A', '8-K'][(o_orderkey % 3 + 1)::INT] AS type, o_orderkey % 2 = 0 AS has_sec21, 'f/' || o_orderkey || '.txt' AS filename, NULL::VARCHAR AS sec_21_url,
  o_orderkey % 17 = 0 AS bad_header, o_orderkey % 19 = 0 AS bad_sec21 FROM orders)"""
FILERS = """filers AS (SELECT filing_id AS filer_id, filing_id, cik, year, 'Customer ' || cik % 400 || ' Corporation' AS conformed_name,
  'Customer ' || cik % 400 || CASE WHEN cik % 6 = 0 THEN ' Corporation' ELSE ' Corp' END AS match_name, (cik % 50)::INT AS irs_number, (cik % 20)::INT AS sic_code, 'R' || cik % 5 AS incorp_country_code,
  CASE WHEN cik % 4 <> 0 THEN 'N' || cik % 25 END AS incorp_subdiv_code, CASE WHEN cik % 3 <> 0 THEN 'S' || cik % 25 END AS state_of_incorporation,
  CASE WHEN cik % 2 = 0 THEN cik || ' Main St' END AS business_street_1, cik || ' Main St, City' AS business_raw_address, 'S' || cik % 25 AS business_state,
  CASE WHEN cik % 5 = 0 THEN 'Box ' || cik END AS mail_street_1, 'Box ' || cik || ', Town' AS mail_raw_address, 'T' || cik % 25 AS mail_state, filing_id % 2 = 0 AS sec_21, cik + 10 AS cw_id
  FROM (SELECT cik, year, max(filing_id) AS filing_id FROM filings GROUP BY 1, 2))"""
RELATIONSHIPS = """relationships AS (SELECT filing_id * 3 + k AS relationship_id, filing_id, cik AS filer_cik, year,
  CASE WHEN (filing_id + k) % 4 = 0 THEN 'Customer ' || filing_id % 400 || ' Corp' ELSE 'Sub ' || (filing_id * 7 + k) % 300 || ' Limited' END AS company_name,
  CASE WHEN (filing_id + k) % 4 = 0 THEN 'Customer ' || filing_id % 400 || ' Corp' ELSE 'Sub ' || (filing_id * 7 + k) % 300 || ' Ltd' END AS clean_company,
  'R' || (filing_id + k) % 5 AS country_code, CASE WHEN (filing_id + k) % 3 <> 0 THEN 'N' || (filing_id + k) % 25 END AS subdiv_code,
  CASE WHEN (filing_id + k) % 8 <> 0 THEN 'place ' || (filing_id + k) % 40 END AS location, k % 2 AS hierarchy,
  CASE WHEN (filing_id + k) % 4 = 0 THEN filing_id % 400 + 10 ELSE (filing_id * 7 + k) % 300 + 100000 END AS cw_id, cik + 10 AS parent_cw_id
  FROM filings, (SELECT unnest([0, 1, 2]) AS k) WHERE has_sec21)"""
REGISTRY = """registry AS (SELECT c_custkey + 10 AS cw_id, 'Customer ' || c_custkey % 400 || ' Corp' AS company_name, c_custkey AS cik, 'R' || c_custkey % 5 AS country_code,
  CASE WHEN c_custkey % 4 <> 0 THEN 'N' || c_custkey % 25 ELSE '' END AS subdiv_code FROM customer WHERE c_custkey % 3 = 0 AND c_custkey > 0
  UNION ALL SELECT c_custkey + 100000, 'Sub ' || c_custkey || ' Ltd', 0, 'R' || c_custkey % 5, '' FROM customer WHERE c_custkey < 60)"""
MASTER = """master AS (SELECT s_suppkey AS row_id, 'Sub ' || s_suppkey || ' Ltd' AS match_name, CASE WHEN s_suppkey % 10 = 0 THEN s_suppkey ELSE s_suppkey % 30 + 50000 END AS cik FROM supplier)"""
EDGES = "edges AS (SELECT DISTINCT parent_cw_id AS source, cw_id AS target, year FROM relationships WHERE cw_id <> parent_cw_id)"
