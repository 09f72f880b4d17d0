"""Queries of sources, sinks, text functions and the facade over generated documents, beside SQL with the rows that they must give."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.functions import text as T
from corvane.operators import graph, locate, relational, report
from corvane.plans import api, build
from corvane.plans.registry import Tables, query
from corvane.shared import fresh_path
from corvane.sources import exhibits, filings, sinks


def _say(template: str, **columns) -> Column:
    """A template whose {name} are replaced by columns."""
    out = F.lit(template)
    for name, c in columns.items():
        out = F.replace(out, F.lit("{" + name + "}"), (F.col(c) if isinstance(c, str) else c).cast("string"))
    return out


def _quoted(x) -> str:
    return "NULL" if x is None else "'" + str(x).replace("'", "''") + "'"


def _values(rows) -> str:
    """Rows of strings and nulls as a VALUES list that begins with their number."""
    return "VALUES " + ", ".join(f"({k}, {', '.join(map(_quoted, r))})" for k, r in enumerate(rows))


def _variants(t: Tables, options) -> DataFrame:
    """(id, text): the options in turn, with {p} for a part's name."""
    chosen = F.element_at(F.array(*[F.lit(o) for o in options]), (F.col("p_partkey") % len(options) + 1).cast("int"))
    return t.part.select(F.col("p_partkey").alias("id"), F.replace(chosen, F.lit("{p}"), F.col("p_name")).alias("text"))


def _golden(cases, column: str) -> str:
    return (
        f"SELECT p_partkey AS id, replace(x.want, '{{p}}', p_name) AS {column} FROM part "
        f"JOIN ({_values([(c[1],) for c in cases])}) x(k, want) ON p_partkey % {len(cases)} = x.k"
    )


# (text, ASCII)
_SIGNS = (
    ("O’{p} “x”", "O'{p} \"x\""), ("{p}–Ł—ß", "{p}-L--ss"), ("Ærø {p}®", "AEro {p}(r)"), ("ОАО {p} Щука", "OAO {p} Shchuka"), ("Ελλάς {p}", "Ellas {p}"),
    ("{p}…№5", "{p}...No 5"), ("ＣＯ {p}", "CO {p}"), ("Ñandú {p} ﬁn", "Nandu {p} fin"), ("{p} 日本", "{p} 日本"),
)


@query(_golden(_SIGNS, "plain"))
def transliterate(spark: SparkSession, t: Tables) -> DataFrame:
    return _variants(t, [c[0] for c in _SIGNS]).select("id", T.to_ascii(F.col("text")).alias("plain"))


# (text, folded)
_FOLDED = (("‘{p}’ “x” — y", "'{p}' \"x\" - y"), ("• {p} § ®", " {p}  "), ("{p}\x96\x92\xa0z", "{p}-' z"), ("ˆ{p}·", "^{p}"))


@query(_golden(_FOLDED, "folded"))
def fold_signs(spark: SparkSession, t: Tables) -> DataFrame:
    return _variants(t, [c[0] for c in _FOLDED]).select("id", T.fold_signs(F.col("text")).alias("folded"))


# (text, clean)
_CONTENTS = ((" {p}\n\tb  ", "{p} b"), ("{p}", "{p}"), ("\r\n", ""), ("a   {p} \t c", "a {p} c"))


@query(_golden(_CONTENTS, "clean"))
def clean_contents(spark: SparkSession, t: Tables) -> DataFrame:
    return _variants(t, [c[0] for c in _CONTENTS]).select("id", T.clean_contents(F.col("text")).alias("clean"))


# (text, trimmed)
_TRIMMED = (("  {p}  q ", "{p}  q"), ("\n{p}\t", "{p}"), ("{p}", "{p}"), (" ", ""))


@query(_golden(_TRIMMED, "trimmed"))
def trim_text(spark: SparkSession, t: Tables) -> DataFrame:
    return _variants(t, [c[0] for c in _TRIMMED]).select("id", T.trim(F.col("text")).alias("trimmed"))


# (text, decoded)
_ENTITIES = (("{p} &amp; Caf&eacute;", "{p} & Café"), ("&#233;&#xe9; {p}", "éé {p}"), ("{p}&rsquo;s &#146;", "{p}’s ’"), ("&amp;lt; {p} &nosuch;", "&lt; {p} &nosuch;"), ("a&nbsp;{p}&#160;&hellip;", "a {p} …"))


@query(_golden(_ENTITIES, "decoded"))
def decode_entities(spark: SparkSession, t: Tables) -> DataFrame:
    return _variants(t, [c[0] for c in _ENTITIES]).select("id", T.decode_entities(F.col("text")).alias("decoded"))


# (place in free text, country, subdivision, what was looked up)
_PLACES = (
    ("a Delaware corporation", "US", "DE", "Delaware"), ("organized under the laws of the Ireland", "IE", None, "Ireland"), ("Austin, TX", "US", "TX", "Austin, TX"),
    ("Ontario - Canada", "CA", "ON", "Ontario , Canada"), ("incorporated in the state of New York", "US", "NY", "New York"), ("100% Ireland", "IE", None, "Ireland"), ("Canada (1999)", "CA", None, "Canada"),
    ("formed in: Texas", "US", "TX", "Texas"), ("Atlantis", None, None, "Atlantis"), ("England", "GB", "ENG", "England"), ("Canada, Ontario", "CA", "ON", "Canada, Ontario"), ("Limited, INC", None, None, "Limited, INC"),
)


def _place_tables(spark: SparkSession) -> dict[str, DataFrame]:
    countries = spark.createDataFrame([("US", "United States"), ("CA", "Canada"), ("IE", "Ireland"), ("GB", "United Kingdom")], "country_code string, country_name string")
    aliases = spark.createDataFrame([("GB", "England", "ENG")], "country_code string, country_name string, subdiv_code string")
    subdivisions = [("US", "DE", "Delaware"), ("US", "NY", "New York"), ("US", "TX", "Texas"), ("CA", "ON", "Ontario")]
    return {"countries": countries, "aliases": aliases, "subdivisions": spark.createDataFrame(subdivisions, "country_code string, subdivision_code string, subdivision_name string")}


def _lookups(spark: SparkSession) -> locate.Places:
    return locate.Places(**_place_tables(spark))


@query(f"""SELECT p_partkey AS id, x.cc AS country_code, x.sc AS subdiv_code, x.clean AS place_clean FROM part
JOIN ({_values([p[1:] for p in _PLACES])}) x(k, cc, sc, clean) ON p_partkey % {len(_PLACES)} = x.k""")
def clean_places(spark: SparkSession, t: Tables) -> DataFrame:
    """Places in phrases, cleaned and looked up."""
    rows = _variants(t, [p[0] for p in _PLACES])
    return locate.resolve_places(rows, "text", _lookups(spark)).select("id", "country_code", "subdiv_code", "place_clean")


# (company, place, status, company kept, country, subdivision): guards against captions, stop terms, figures, long cells, two places.
_CELLS = (
    ("{p} Ltd", "Ireland", "ok", "{p} Ltd", "IE", None), ("Ireland", "{p} Ltd", "ok", "{p} Ltd", "IE", None), ("Ireland", "Texas", "rejected", None, None, None), ("{p} Ltd", "Atlantis", "bad_location", None, None, None),
    ("Name of Subsidiary", "Ireland", "rejected", None, None, None), ("1.", "Ireland", "rejected", None, None, None), ("2. {p} Co.", "New York", "ok", "{p} Co", "US", "NY"), ("Total", "Ireland", "rejected", None, None, None),
    ("", "Ireland", "rejected", None, None, None), (None, "Ireland", "rejected", None, None, None), ("{p}" + "A" * 130, "Ireland", "rejected", None, None, None), ("{p} (100%)", "Ontario, Canada", "ok", "{p}", "CA", "ON"),
    ("{p}" * 60, "Ireland", "rejected", None, None, None), ("combined ownership of {p}", "Ireland", "rejected", None, None, None), ("* {p} Inc;", "Texas", "ok", "{p} Inc", "US", "TX"), ("12345", "Texas", "rejected", None, None, None),
    ("{p} Inc is a wholly-owned unit", "Texas", "ok", "{p} Inc", "US", "TX"), ("Exhibit 21 List of Subsidiaries of the registrant {p}", "Texas", "ok", "{p}", "US", "TX"), ("x", "Texas", "rejected", None, None, None),
)


@query(f"""SELECT p_partkey AS id, x.status, CASE WHEN x.status = 'ok' THEN replace(x.company, '{{p}}', p_name) END AS company, x.cc AS country_code, x.sc AS subdiv_code FROM part
JOIN ({_values([c[2:] for c in _CELLS])}) x(k, status, company, cc, sc) ON p_partkey % {len(_CELLS)} = x.k""")
def validate_cells(spark: SparkSession, t: Tables) -> DataFrame:
    """Candidate pairs of company and place, judged in bulk."""
    at = (F.col("p_partkey") % len(_CELLS) + 1).cast("int")
    pick = lambda k: F.replace(F.element_at(F.array(*[F.lit(c[k]) for c in _CELLS]), at), F.lit("{p}"), F.col("p_name"))
    rows = t.part.select(F.col("p_partkey").alias("id"), pick(0).alias("c"), pick(1).alias("p"))
    judged = exhibits.validate(rows, "c", "p", _lookups(spark), spark.createDataFrame([("Total",)], "term string"))
    ok = F.col("status") == "ok"
    show = lambda c: F.when(ok, F.col(c))
    return judged.select("id", "status", show("company_clean").alias("company"), show("country_code").alias("country_code"), show("subdiv_code").alias("subdiv_code"))


_HEADER = """<html><div id="filerDiv"><div class="mailer">Business Address <span>{k} Main St</span>{suite}<span>Town {s} {zip}</span><span>212-555-{zip}</span></div>
<div class="mailer">Mailing Address <span>PO Box {k}</span><span>NULL</span><span>Austin TX 78701</span></div>
<div class="companyInfo"><span class="companyName">Firm{k} &amp; Sons&rsquo; Company (Filer) <acronym>CIK</acronym>: {cik}</span><p class="identInfo"><acronym>IRS No.</acronym>: <strong>{irs}</strong> |
State of Incorp.: <strong>{s}</strong> | Fiscal Year End: <strong>1231</strong><br/>SIC: <b><a href="x">37{sic}</a></b></p></div></div></html>"""


@query("""SELECT c_custkey AS filing_id, 700000 + c_custkey AS cik, 'Firm' || c_custkey || ' & Sons Co' AS match_name, (11000000 + c_custkey)::INT AS irs_number, ('37' || (10 + c_custkey % 9))::INT AS sic_code,
  1231 AS fiscal_year_end, s AS state_of_incorporation, c_custkey || ' Main St' AS business_street_1, CASE WHEN c_custkey % 4 <> 0 THEN 'Suite ' || c_custkey END AS business_street_2, 'Town' AS business_city,
  s AS business_state, (10000 + c_custkey % 9000)::VARCHAR AS business_zip, '212-555-' || (10000 + c_custkey % 9000) AS business_phone, 'PO Box ' || c_custkey || ', Austin TX 78701' AS mail_raw_address, 'TX' AS mail_state
FROM (SELECT c_custkey, ['NY', 'TX', 'DE'][(c_custkey % 3 + 1)::INT] AS s FROM customer) WHERE c_custkey % 5 <> 0""")  # fmt: skip
def header_fields(spark: SparkSession, t: Tables) -> DataFrame:
    """Filers of header pages; every fifth page doesn't mention its filer."""
    k = F.col("c_custkey")
    state = F.element_at(F.array(F.lit("NY"), F.lit("TX"), F.lit("DE")), (k % 3 + 1).cast("int"))
    suite = F.when(k % 4 != 0, _say("<span>Suite {k}</span>", k=k)).otherwise(F.lit(""))
    pages = t.customer.select(
        k.alias("filing_id"), (700000 + k).alias("cik"),
        _say(_HEADER, suite=suite, k=k, s=state, zip=10000 + k % 9000, cik=F.when(k % 5 != 0, 700000 + k).otherwise(F.lit(1)), irs=11000000 + k, sic=10 + k % 9).alias("content"),
    )
    rows = filings.typed_filers(filings.header_rows(pages, ["NY", "TX", "DE"]))
    return rows.select(
        "filing_id", "cik", "match_name", "irs_number", "sic_code", "fiscal_year_end", "state_of_incorporation", "business_street_1", "business_street_2", "business_city", "business_state",
        "business_zip", "business_phone", "mail_raw_address", "mail_state",
    )


# (exhibit, company, place, country, subdivision, indent, tables, tables parsed)
_EXHIBITS = (
    ("<html><table><tr><td>Name</td><td>Jurisdiction</td></tr><tr><td>Firm {k} Ltd</td><td></td><td>Ireland</td></tr></table></html>", "Firm {k} Ltd", "Ireland", "IE", None, 0, 1, 1),
    ("<html><body><div>Firm {k} Inc, a Delaware corporation</div><p>nothing here</p></body></html>", "Firm {k} Inc", "Delaware", "US", "DE", 0, 0, 0),
    ("Subsidiaries\n\nFirm {k} Ltd         Ireland\n", "Firm {k} Ltd", "Ireland", "IE", None, 0, 0, 0),
    ("<table><tr><td>1.</td><td>Firm {k} Ltd</td><td>England</td></tr></table>", "Firm {k} Ltd", "England", "GB", "ENG", 0, 1, 1),
    ("<table><tr><td>Firm {k} Ltd</td><td>Atlantis</td></tr></table>", None, None, None, None, None, 1, 0),
    ("<html><table><tr><td>Top Co</td><td>Nowhere</td></tr><tr><td style='margin-left: 20px; text-indent: 5px'>Firm {k} LLC</td><td>Texas</td></tr></table></html>", "Firm {k} LLC", "Texas", "US", "TX", 25, 1, 1),
    ("", None, None, None, None, None, 0, 0),
)
_EXHIBITS_SQL = f"({_values([e[1:5] for e in _EXHIBITS])}) x(k, company, place, cc, sc)"


def _exhibits(spark: SparkSession, t: Tables) -> tuple[DataFrame, DataFrame]:
    k = F.col("c_custkey")
    content = F.element_at(F.array(*[F.lit(e[0]) for e in _EXHIBITS]), (k % len(_EXHIBITS) + 1).cast("int"))
    d = t.customer.select(k.alias("filing_id"), F.replace(content, F.lit("{k}"), k.cast("string")).alias("content"))
    rows, _ = exhibits.extract_subsidiaries(d, _lookups(spark), spark.createDataFrame([("Total",)], "term string"))
    return d, rows


@query(f"""SELECT c_custkey AS filing_id, replace(company, '{{k}}', c_custkey::VARCHAR) AS company_name, place AS location, cc AS country_code, sc AS subdiv_code,
  {[e[5] or 0 for e in _EXHIBITS]}[(c_custkey % {len(_EXHIBITS)} + 1)::INT]::INT AS hierarchy FROM customer JOIN {_EXHIBITS_SQL} ON c_custkey % {len(_EXHIBITS)} = x.k WHERE company IS NOT NULL""")
def exhibit_rows(spark: SparkSession, t: Tables) -> DataFrame:
    """Subsidiaries in exhibits of every layout."""
    return _exhibits(spark, t)[1].select("filing_id", "company_name", "location", "country_code", "subdiv_code", "hierarchy")


# (exhibit, company, place, the strategy that finds them); by captions only where no row or cell by itself gives anything
_METHODS = (
    ("<html><table><tr><td>Firm {k} Ltd<sup>(1)</sup></td><td>Ireland<sub>2</sub></td></tr><tr></tr></table></html>", "Firm {k} Ltd", "Ireland", "row, cells 0 and 1"),
    ("<table><tr><td>Name of Subsidiary</td><td>Class</td><td>Held</td><td>Jurisdiction</td></tr><tr><td>1.</td><td>Firm {k} Ltd</td><td>common</td><td>fully</td><td>Texas</td></tr></table>", "Firm {k} Ltd", "Texas", "by captions"),
    ("<table><tr><td>Entity</td><td>a</td><td>Domicile</td></tr><tr><td>Firm {k} Ltd</td><td>class b</td><td></td><td>class c</td><td>Ireland</td></tr></table>", None, None, None),
    ("<table><tr><td>Entity</td><td>Domicile</td></tr><tr><td>Firm {k} SA</td><td></td><td>Ireland</td></tr></table>", "Firm {k} SA", "Ireland", "row, cells 0 and 1"),
    ("<table><tr><td>Firm {k} Inc</td><td>100%</td><td>50%</td><td>Canada</td></tr></table>", "Firm {k} Inc", "Canada", "first two cells"),
    ("<table><tr><td><p>Firm {k} Co - Texas</p><p>more</p></td><td>one</td><td>two</td></tr></table>", "Firm {k} Co", "Texas", "p"),
    ("<table><tr><td>Firm {k} LLC - Ireland<br>Other words</td></tr></table>", "Firm {k} LLC", "Ireland", "between breaks"),
    ("Firm {k} Ltd (Ireland)", "Firm {k} Ltd", "Ireland", "text, one field"),
    ("100%   Ireland   Firm {k} Ltd", "Firm {k} Ltd", "Ireland", "text, fields 2 and 1"),
    ("<div><div><div>Firm {k} GmbH (Ireland)</div></div></div>", "Firm {k} GmbH", "Ireland", "div"),
)


@query(f"""SELECT c_custkey AS filing_id, replace(company, '{{k}}', c_custkey::VARCHAR) AS company_name, place AS location, method AS parse_method FROM customer
JOIN ({_values([m[1:] for m in _METHODS])}) x(k, company, place, method) ON c_custkey % {len(_METHODS)} = x.k WHERE company IS NOT NULL""")
def exhibit_methods(spark: SparkSession, t: Tables) -> DataFrame:
    """Exhibits that each strategy decides, with its label."""
    k = F.col("c_custkey")
    content = F.element_at(F.array(*[F.lit(m[0]) for m in _METHODS]), (k % len(_METHODS) + 1).cast("int"))
    d = t.customer.select(k.alias("filing_id"), F.replace(content, F.lit("{k}"), k.cast("string")).alias("content"))
    rows, _ = exhibits.extract_subsidiaries(d, _lookups(spark), spark.createDataFrame([("Total",)], "term string"))
    return rows.select("filing_id", "company_name", "location", "parse_method")


@query(f"""SELECT c_custkey AS filing_id, {[e[0].startswith("<") for e in _EXHIBITS]}[i] AS has_html, {[e[6] for e in _EXHIBITS]}[i]::INT AS num_tables, {[e[7] for e in _EXHIBITS]}[i]::INT AS tables_parsed,
  {[int(e[1] is not None) for e in _EXHIBITS]}[i]::BIGINT AS rows_parsed, {[e[1] is None for e in _EXHIBITS]}[i] AS bad_sec21 FROM (SELECT c_custkey, (c_custkey % {len(_EXHIBITS)} + 1)::INT AS i FROM customer)""")
def parse_accounting(spark: SparkSession, t: Tables) -> DataFrame:
    return exhibits.parse_accounting(*_exhibits(spark, t))


@query("""SELECT c_custkey AS k, c_nationkey AS year, 'a' AS v, 'appended' AS sink FROM customer WHERE c_nationkey < 3
UNION ALL SELECT c_custkey, c_nationkey, 'b', 'appended' FROM customer WHERE c_nationkey = 3
UNION ALL SELECT c_custkey, c_nationkey, CASE WHEN c_nationkey = 2 THEN 'new' ELSE 'a' END, 'rebuilt' FROM customer WHERE c_nationkey < 3
UNION ALL SELECT c_custkey, c_nationkey, 'a', 'copied' FROM customer WHERE c_nationkey < 3""")
def sinks_written(spark: SparkSession, t: Tables) -> DataFrame:
    """Full replacement, append, the rebuild of one partition and a dump, as read back."""
    rows = t.customer.select(F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("year"), F.lit("a").alias("v"))
    root = fresh_path(spark, "sinks")
    sinks.replace(rows.filter("year = 20"), f"{root}/appended", ["year"])
    sinks.replace(rows.filter("year < 3"), f"{root}/appended", ["year"])
    sinks.append(rows.filter("year = 3").withColumn("v", F.lit("b")), f"{root}/appended", ["year"])
    sinks.replace(rows.filter("year < 3"), f"{root}/rebuilt", ["year"])
    sinks.replace_partitions(rows.filter("year = 2").withColumn("v", F.lit("new")), f"{root}/rebuilt", ["year"])
    sinks.replace(rows.filter("year < 3"), f"{root}/from/copied")
    sinks.copy_tables(spark, ["copied"], f"{root}/from", root)
    read = lambda name: spark.read.parquet(f"{root}/{name}").select("k", F.col("year").cast("int").alias("year"), "v", F.lit(name).alias("sink"))
    return read("appended").unionByName(read("rebuilt")).unionByName(read("copied"))


@query("""SELECT '<table><tr><th>metric</th>' || string_agg('<th>' || r || '</th>', '' ORDER BY r) || '</tr><tr><td>nations &lt;x&gt;</td>' || string_agg('<td>' || n || '.0</td>', '' ORDER BY r) || '</tr></table>' AS html
FROM (SELECT 2000 + n_regionkey AS r, count(*) AS n FROM nation GROUP BY 1)""")
def report_html(spark: SparkSession, t: Tables) -> DataFrame:
    counts = t.nation.groupBy((2000 + F.col("n_regionkey")).alias("year")).agg(F.count("*").cast("double").alias("value"))
    return spark.createDataFrame([(report.as_html(counts.withColumn("metric", F.lit("nations <x>"))),)], "html string")


@query("SELECT max(year) AS year, max(quarter) AS quarter FROM (SELECT year(o_orderdate)::INT AS year, quarter(o_orderdate)::INT AS quarter FROM orders) o WHERE year = (SELECT max(year(o_orderdate)) FROM orders)")
def latest_loaded(spark: SparkSession, t: Tables) -> DataFrame:
    rows = t.orders.select(F.year("o_orderdate").alias("year"), F.quarter("o_orderdate").alias("quarter"))
    return filings.latest_loaded(rows)


@query("""SELECT y AS year, count(*) AS n, y BETWEEN 2003 AND year(current_date) AS available, true AS stamped FROM (SELECT (year(o_orderdate) + 9)::INT AS y FROM orders) GROUP BY y""")
def years_available(spark: SparkSession, t: Tables) -> DataFrame:
    """Orders by year, against the list of years and with the time of their load."""
    years = t.orders.groupBy((F.year("o_orderdate") + 9).alias("year")).agg(F.count("*").alias("n"))
    now = F.abs(F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp("loaded_at")) < 3600
    return sinks.stamped(years).select(F.col("year").cast("int").alias("year"), "n", F.array_contains(T.years_available(), F.col("year")).alias("available"), now.alias("stamped"))


_FILES_SQL = "SELECT o_custkey AS cik, 'd/' || o_orderkey || '.txt' AS filename, '10-K' AS type, year(o_orderdate)::INT AS year, quarter(o_orderdate) <= 2 AS first FROM orders"


@query(f"""SELECT cik, filename, type, year, row_number() OVER (ORDER BY NOT first, cik, filename, year) AS filing_id FROM ({_FILES_SQL})""")
def stable_file_ids(spark: SparkSession, t: Tables) -> DataFrame:
    """Files of half the quarters, then of all: the former keep their identifiers, the others go on from the last."""
    files = t.orders.select(
        F.col("o_custkey").alias("cik"), _say("d/{k}.txt", k="o_orderkey").alias("filename"), F.lit("10-K").alias("type"), F.year("o_orderdate").alias("year"), F.quarter("o_orderdate").alias("quarter"),
    )
    return build.numbered_files(files, build.numbered_files(files.filter("quarter <= 2")))


@query("""SELECT page_id, 'https://example.org/p/' || page_id || '/' || page_id || '.htm' AS url, regexp_matches(html, '(?i)<(?:html|table|body|div|p|br|font|pre)\\b') AS has_html,
  len(regexp_extract_all(html, '(?i)<table\\b'))::INT AS num_tables, true AS parsed FROM pages WHERE page_id % 3 <> 2 UNION ALL SELECT page_id, NULL, NULL, NULL, false FROM pages WHERE page_id % 3 = 2""")
def incremental_documents(spark: SparkSession, t: Tables) -> DataFrame:
    """Pages as submissions that arrive in several batches, after an index of which a batch was repeated; a third have no exhibit."""
    from corvane.streaming.documents import FilingStore, each_batch
    from corvane.streaming.ingest import read_stream

    base = fresh_path(spark, "documents")
    store = FilingStore(spark, f"{base}/store")
    p = F.col("page_id")
    index = t.pages.select(p.alias("cik"), F.lit("a").alias("company_name"), F.lit("10-K").alias("type"), F.lit(None).cast("date").alias("filing_date"), _say("p/{p}.txt", p=p).alias("filename"), F.lit(2004).alias("year"), F.lit(1).alias("quarter"))
    store.store_index(index.filter("cik % 2 = 0"), 0)
    store.store_index(index, 1)
    store.store_index(index, 1)
    ids = store.table("filings").rows().select("filing_id", F.col("cik").alias("page_id"))
    kind = F.when(p % 3 == 2, F.lit("10-K")).otherwise(F.lit("EX-21"))
    wrapped = _say("<DOCUMENT>\n<TYPE>{t}\n<FILENAME>{p}.htm\n<TEXT>{h}</TEXT></DOCUMENT>", t=kind, p=p, h="html")
    t.pages.repartition(2, "page_id").write.parquet(f"{base}/pages")
    lookups = _place_tables(spark) | {"stop_terms": spark.createDataFrame([("Total",)], "term string")}

    def store_batch(rows: DataFrame, n: int) -> None:
        documents = rows.join(ids, "page_id").select("filing_id", wrapped.alias("content"))
        store.store_submissions(documents, n, lookups, "https://example.org/")

    for _ in range(2):
        each_batch(read_stream(spark, f"{base}/pages", ["page_id", "html"], files_per_batch=1), store_batch, f"{base}/checkpoint")
    found = store.table("documents").rows().join(ids, "filing_id")
    return found.select("page_id", F.col("sec_21_url").alias("url"), "has_html", "num_tables", F.col("has_sec21").alias("parsed"))


_DIRECTORY_SQL = """info AS (SELECT c_custkey AS cw_id, y AS year, 'Firm ' || c_custkey || ' ' || c_mktsegment AS company_name, min(y) OVER (PARTITION BY c_custkey) AS min_year,
  max(y) OVER (PARTITION BY c_custkey) AS max_year, y = max(y) OVER (PARTITION BY c_custkey) AS most_recent FROM customer, range(2004, 2007) r(y) WHERE (c_custkey + y) % 4 <> 0)"""


def _directory(t: Tables) -> api.Directory:
    years = F.explode(F.array(*[F.lit(y) for y in (2004, 2005, 2006)])).alias("year")
    info = t.customer.select(F.col("c_custkey").alias("cw_id"), _say("Firm {k} {m}", k="c_custkey", m="c_mktsegment").alias("company_name"), years).filter("(cw_id + year) % 4 <> 0")
    names = t.customer.select(F.col("c_custkey").alias("cw_id"), _say("Old {k}", k="c_custkey").alias("company_name"), F.lit(2004).alias("min_year"), F.lit(2005).alias("max_year"))
    places = t.customer.select(
        F.col("c_custkey").alias("cw_id"), _say("{k} Main Street", k="c_custkey").alias("raw_address"), F.lit("business").alias("type"), F.lit(2004).alias("min_year"), F.lit(2006).alias("max_year")
    )
    edges = info.select((F.col("cw_id") / 2).cast("long").alias("source"), F.col("cw_id").alias("target"), "year").filter("source <> target")
    return api.Directory(relational.with_year_range(graph.degrees(info, edges), "cw_id", "year"), edges, names, places)


@query(f"""WITH {_DIRECTORY_SQL} SELECT 'company' AS method, cw_id, company_name AS said FROM info WHERE cw_id = 7 AND most_recent
UNION ALL SELECT 'in 2005', cw_id, company_name FROM info WHERE cw_id = 8 AND year = 2005
UNION ALL SELECT 'names', c_custkey, 'Old 7' FROM customer WHERE c_custkey = 7 AND (SELECT max(year) FROM info WHERE cw_id = 7) <= 2005
UNION ALL SELECT 'locations', c_custkey, '9 Main Street' FROM customer WHERE c_custkey = 9
UNION ALL SELECT 'years', NULL, year::VARCHAR FROM (SELECT DISTINCT year FROM info)
UNION ALL SELECT 'name search', c_custkey, 'Old ' || c_custkey FROM customer WHERE c_custkey = 12
UNION ALL SELECT 'location search', c_custkey, c_custkey || ' Main Street' FROM customer WHERE c_custkey = 13
UNION ALL SELECT 'meta', NULL, 'OK ' || count(*) FROM info WHERE most_recent AND company_name LIKE '%BUILDING'""")
def api_lookups(spark: SparkSession, t: Tables) -> DataFrame:
    """One company, names, places and years, the searches of names and places, and a result's description."""
    d = _directory(t)
    show = lambda method, rows, c, cw_id=F.col("cw_id"): rows.select(F.lit(method).alias("method"), cw_id.cast("long").alias("cw_id"), F.col(c).cast("string").alias("said"))
    about = api.meta(d.search(company_name="building"), company_name="building", year=None)
    said = spark.createDataFrame([(f"{about['status_string']} {about['total_results']}",)], "said string")
    parts = [
        show("company", d.company(7), "company_name"), show("in 2005", d.company(8, 2005), "company_name"), show("names", d.names_of(7), "company_name"), show("locations", d.locations_of(9), "raw_address"),
        show("years", d.years(), "year", F.lit(None)), show("name search", d.search_names("OLD 12", max_year=2006), "company_name"), show("location search", d.search_locations("main 13", "business"), "raw_address"),
        show("meta", said, "said", F.lit(None)),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("""SELECT c_custkey AS id FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey = 7""")
def api_text_index(spark: SparkSession, t: Tables) -> DataFrame:
    """A search by words through the stored index."""
    named = t.customer.select(F.col("c_custkey").alias("id"), _say("{m}/Firm nation{n}", m="c_mktsegment", n="c_nationkey").alias("name"))
    index = api.TextIndex.build(named, "id", "name", fresh_path(spark, "text-index"))
    return index.search("nation7 Building").select("id")
