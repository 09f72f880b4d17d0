"""Coverage metrics by year."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.operators.relational import ratio
from corvane.shared import written


def coverage_metrics(filings: DataFrame, filers: DataFrame, relationships: DataFrame, empty_exhibits: DataFrame, info: DataFrame, edges: DataFrame) -> DataFrame:
    """(year, metric, value) of the thirteen metrics; every table is read once.

    A company-year's memberships are bits, set by info and by both ends of the edges and combined by one aggregation; distinct, semi
    and anti counts are counts of rows by their bits. What a filing's relationships say of its parents is their least and largest
    one: some parent isn't the filer if one of the two isn't. Top-level companies with children ignore the year when they look for a
    parent; all other metrics don't.
    """
    parent = F.col("parent_cw_id")
    per = relationships.groupBy("filing_id", "year").agg(F.count("*").alias("n"), F.min(parent).alias("lo"), F.max(parent).alias("hi"))
    per = written(per, "parents-of-filings")
    named = per.groupBy("filing_id").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.lit(1).alias("_parsed"))
    empty = empty_exhibits.filter("code = 1").select("filing_id").distinct().withColumn("_empty", F.lit(1))
    f = filings.join(named, "filing_id", "left").join(empty, "filing_id", "left").groupBy("cik", "year").agg(
        F.sum(F.col("has_sec21").cast("double")).alias("with_exhibit"), F.count("_parsed").alias("parsed"), F.count("_empty").alias("empty"),
        F.min("lo").alias("lo"), F.max("hi").alias("hi"),
    )
    f = written(f, "filings-of-filers")
    years = f.groupBy("year").agg(*[F.sum(c).cast("double").alias(c) for c in ("with_exhibit", "parsed", "empty")])
    years = years.withColumn("percent_parsed", ratio(F.col("parsed"), F.col("with_exhibit")))
    years = years.withColumn("percent_true_parsed", ratio(F.col("parsed"), F.col("with_exhibit") - F.col("empty")))

    bit = lambda k, c: F.when(c, F.lit(1 << k)).otherwise(F.lit(0))
    known = f.filter("lo is not null").select(F.col("cik").alias("_cik"), F.col("year").alias("_year"), "lo", "hi")
    of = info.select("cw_id", "year", "cik", "num_children", "num_parents").join(known, (F.col("cik") == F.col("_cik")) & (F.col("year") == F.col("_year")), "left")
    other = F.coalesce((F.col("lo") != F.col("cw_id")) | (F.col("hi") != F.col("cw_id")), F.lit(False))
    alone = F.coalesce((F.col("num_children") == 0) & (F.col("num_parents") == 0), F.lit(False))
    mine = of.select("cw_id", "year", F.lit(1).alias("rows"), F.lit(0).alias("edges"), (F.lit(1) + bit(1, alone) + bit(2, other)).alias("bits"))
    dated = F.col("year").isNotNull()
    end = lambda c, k, edge: F.struct(F.col(c).alias("cw_id"), F.lit(edge).alias("edges"), bit(k, dated).alias("bits"))
    ends = edges.select("year", F.explode(F.array(end("source", 3, 1), end("target", 4, 0))).alias("e"))
    ends = ends.select("e.cw_id", "year", F.lit(0).alias("rows"), "e.edges", (F.col("e.bits") + bit(5, (F.col("e.edges") == 0))).alias("bits"))
    both = mine.unionByName(ends).groupBy("cw_id", "year").agg(F.sum("rows").alias("rows"), F.sum("edges").alias("edges"), F.bit_or("bits").alias("bits"))
    both = both.groupBy("cw_id").agg(F.bit_or("bits").alias("ever"), F.collect_list(F.struct("year", "rows", "edges", "bits")).alias("y"))  # one entry a year
    both = both.select("cw_id", "ever", F.inline("y"))
    has = lambda k, c="bits": F.col(c).bitwiseAND(1 << k) != 0
    company = F.col("cw_id").isNotNull() & has(0)
    n = lambda c: F.count(F.when(company & c, 1)).cast("double")
    counts = both.groupBy("year").agg(
        F.sum("rows").cast("double").alias("companies"), F.sum("edges").cast("double").alias("company_relations"), n(has(1)).alias("isolated"),
        n(~has(4)).alias("top_level"), n(has(3) & ~has(5, "ever")).alias("top_level_with_children"), n(has(2)).alias("filers_with_hierarchy"),
    )
    long = lambda t: t.unpivot("year", [c for c in t.columns if c != "year"], "metric", "value")
    rows = [filers.groupBy("year").agg(F.count("*").cast("double").alias("filing_companies")), per.groupBy("year").agg(F.sum("n").cast("double").alias("relationships"))]
    return reduce(DataFrame.unionByName, [long(years), long(counts).filter("value > 0"), *map(long, rows)])


def by_year(metrics: DataFrame, years: list[int] | None = None) -> DataFrame:
    """One row a metric and one column a year."""
    wide = metrics.groupBy("metric")
    wide = wide.pivot("year", years) if years else wide.pivot("year")
    return wide.agg(F.first("value"))


def as_html(metrics: DataFrame) -> str:
    """The metrics as an HTML table; as many rows as there are metrics come to the driver."""
    import html

    wide = by_year(metrics).orderBy("metric")
    head = "".join(f"<th>{html.escape(c)}</th>" for c in wide.columns)
    body = "".join("<tr>" + "".join(f"<td>{'' if v is None else html.escape(str(v))}</td>" for v in r) + "</tr>" for r in wide.collect())
    return f"<table><tr>{head}</tr>{body}</table>"
