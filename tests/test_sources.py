import random
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from corvane.operators import locate
from corvane.plans import queries as _queries  # noqa: F401  registers its queries
from corvane.plans import registry
from corvane.sources import exhibits, filings, sinks
from corvane.sources.tree import parse
from corvane.streaming.ingest import ingest_index


@pytest.fixture(scope="module")
def places(spark):
    countries = spark.createDataFrame([("US", "United States"), ("CA", "Canada"), ("IE", "Ireland"), ("GB", "United Kingdom"), ("FR", "France")], "country_code string, country_name string")
    aliases = spark.createDataFrame([("GB", "England", "ENG")], "country_code string, country_name string, subdiv_code string")
    subs = spark.createDataFrame([("US", "DE", "Delaware"), ("US", "NY", "New York"), ("US", "TX", "Texas"), ("CA", "ON", "Ontario")], "country_code string, subdivision_code string, subdivision_name string")
    return locate.Places(countries, aliases, subs)


@pytest.fixture(scope="module")
def stop(spark):
    return spark.createDataFrame([("Total",)], "term string")


SINGLE = [
    ("Acme Inc, incorporated in Ireland", 0, "Acme Inc", "Ireland"), ("Acme LLC, a Delaware corporation", 1, "Acme LLC", "Delaware"),
    ("Acme Bank, organized under the laws of France", 2, "Acme Bank", "France"), ("Acme was formed in Texas", 3, "Acme was", "Texas"), ("Acme Services (Ireland)", 4, "Acme Services", "Ireland"),
    ("Acme (Ireland) Two", 4, "Acme (Ireland) Two", "Ireland"), ("Acme jurisdiction of organization: Texas", 5, "Acme ", "Texas"), ("Acme - Texas", 6, "Acme", "Texas"), ("Acme    Texas", 7, "Acme", "Texas"),
    ("Acme  x  Texas", 8, "Acme", "Texas"), ("Acme Ireland Ltd", 9, "Acme Ireland Ltd", "Ireland"), ("plain", None, None, None), ("x" * 400, None, None, None), ("---", None, None, None),
]


def test_single_strings(spark):
    d = spark.createDataFrame([(i, t) for i, (t, *_) in enumerate(SINGLE)], "i int, t string")
    got = {r.i: r.c for r in d.select("i", exhibits.single_candidates(F.col("t")).alias("c")).collect()}
    for i, (_, sub, company, place) in enumerate(SINGLE):
        hit = [c for c in got[i] if c["sub"] == sub]
        assert (hit[0]["company"], hit[0]["place"].strip()) == (company, place) if sub is not None else not got[i], SINGLE[i]


def test_validation(spark, places, stop):
    rows = [
        ("Acme Ltd", "Ireland", "ok", "Acme Ltd", "IE", None), ("Ireland", "Acme Ltd", "ok", "Acme Ltd", "IE", None), ("Ireland", "Texas", "rejected", None, None, None), ("Acme Ltd", "Atlantis", "bad_location", None, None, None),
        ("Name of Subsidiary", "Ireland", "rejected", None, None, None), ("1.", "Ireland", "rejected", None, None, None), ("2. Acme Co.", "New York", "ok", "Acme Co", "US", "NY"), ("Total", "Ireland", "rejected", None, None, None),
        ("", "Ireland", "rejected", None, None, None), (None, "Ireland", "rejected", None, None, None), ("A" * 130, "Ireland", "rejected", None, None, None), ("Acme (100%)", "Ontario, Canada", "ok", "Acme", "CA", "ON"),
    ]
    d = spark.createDataFrame([(i, r[0], r[1]) for i, r in enumerate(rows)], "i int, c string, p string")
    got = {r.i: r for r in exhibits.validate(d, "c", "p", places, stop).collect()}
    for i, (_, _, status, company, cc, sc) in enumerate(rows):
        assert got[i].status == status, (rows[i], got[i])
        if status == "ok":
            assert (got[i].company_clean, got[i].country_code, got[i].subdiv_code) == (company, cc, sc), got[i]


EXHIBITS = {
    1: "<html><table><tr><td>Name of Subsidiary</td><td>Jurisdiction</td></tr><tr><td>Acme Ltd</td><td></td><td>Ireland</td></tr><tr><td style='margin-left: 20px; text-indent: 5px'>Beta LLC</td><td>Delaware</td></tr></table></html>",
    2: "<html><body><div>Gamma Inc, a Delaware corporation</div><div>Delta SA (France)</div><p>nothing here</p></body></html>",
    3: "Subsidiaries\n\nAcme Two Ltd         Ireland\nEpsilon Corp, a Texas corporation\nZeta      Ontario, Canada      100%\n",
    4: "<html><table><tr><td>Eta Ltd - Ireland<br>Theta Ltd - Atlantis</td></tr></table></html>",
    5: "",
    6: "<table><tr><td>Iota Ltd</td><td>Atlantis</td></tr></table>",
    7: "<table><tr><td>1.</td><td>Kappa Ltd</td><td>England</td></tr></table><p>Lambda Ltd (Ireland)</p>",
}


def test_exhibits(spark, places, stop):
    d = spark.createDataFrame(list(EXHIBITS.items()), "filing_id long, content string")
    rows, bad = exhibits.extract_subsidiaries(d, places, stop)
    got = {}
    for r in rows.collect():
        got.setdefault(r.filing_id, {})[r.company_name] = (r.country_code, r.subdiv_code)
    assert got[1] == {"Acme Ltd": ("IE", None), "Beta LLC": ("US", "DE")}
    assert got[2] == {"Gamma Inc": ("US", "DE"), "Delta SA": ("FR", None)}
    assert got[3] == {"Acme Two Ltd": ("IE", None), "Epsilon Corp": ("US", "TX"), "Zeta": ("CA", "ON")}
    assert got[4] == {"Eta Ltd": ("IE", None)}
    assert got[7] == {"Kappa Ltd": ("GB", "ENG")} and 5 not in got and 6 not in got
    assert ("Iota Ltd", 6) in {(r.company_name, r.filing_id) for r in bad.collect()}
    acc = {r.filing_id: r for r in exhibits.parse_accounting(d, rows).collect()}
    assert (acc[1].num_tables, acc[1].tables_parsed, acc[1].rows_parsed, acc[1].bad_sec21, acc[3].has_html, acc[5].bad_sec21) == (1, 1, 2, False, False, True)
    indents = {r.company_name: r.hierarchy for r in rows.filter("filing_id = 1").collect()}
    assert indents == {"Acme Ltd": 0, "Beta LLC": 25}


def test_tree_survives_bad_markup():
    root = parse("<table><tr><td>a<td>b<tr><td><b>c</table><p>x<p>y<script>var t='</p>';</script></div>")
    assert [[c.trimmed() for c in r] for r in exhibits.table_rows(root.find("table")[0])] == [["a", "b"], ["c"]]
    assert [p.trimmed() for p in root.find("p")] == ["x", "y"]


HEADER = """<html><div id="filerDiv"><div class="mailer">Business Address <span>1 Main St</span><span>Suite 5</span><span>New York NY 10001</span><span>212-555-0100</span></div>
<div class="mailer">Mailing Address <span>PO Box 9</span><span>NULL</span><span>Austin TX 78701</span></div>
<div class="companyInfo"><span class="companyName">ACME &amp; CO (Filer) <acronym>CIK</acronym>: 123456</span><p class="identInfo"><acronym>IRS No.</acronym>: <strong>11223344</strong> | State of Incorp.: <strong>DE</strong> | Fiscal Year End: <strong>1231</strong>
<br/>SIC: <b><a href="x">3711</a></b></p></div></div></html>"""


def test_headers(spark):
    d = spark.createDataFrame([(1, 123456, HEADER), (2, 999, HEADER), (3, 5, None)], "filing_id long, cik long, content string")
    got = filings.typed_filers(filings.header_rows(d, ["NY", "TX", "DE"])).collect()
    assert len(got) == 1
    r = got[0]
    assert (r.conformed_name, r.match_name, r.irs_number, r.sic_code, r.fiscal_year_end, r.state_of_incorporation) == ("ACME & CO", "ACME & CO", 11223344, 3711, 1231, "DE")
    assert (r.business_street_1, r.business_street_2, r.business_city, r.business_state, r.business_zip, r.business_phone) == ("1 Main St", "Suite 5", "New York", "NY", "10001", "212-555-0100")
    assert (r.mail_street_1, r.mail_city, r.mail_state, r.mail_raw_address) == ("PO Box 9", "Austin", "TX", "PO Box 9, Austin TX 78701")
    codes = d.select("filing_id", filings.document_code(F.col("content"), F.col("cik")).alias("c")).collect()
    assert {x.filing_id: x.c for x in codes} == {1: 0, 2: 2, 3: 1}


def test_files(spark, tmp_path):
    folder = tmp_path / "in" / "2005" / "2"
    folder.mkdir(parents=True)
    (folder / "master.idx").write_text("Last Data Received:    June 30, 2005\nCIK|Company Name|Form Type|Date Filed|Filename\n-----\n7|ACME|10-K|2005-04-01|data/7.txt\n8|B|8-K|2005-04-02|data/8.txt\nbad|line\n")
    got = filings.read_index(spark, str(tmp_path / "in")).collect()
    assert [(r.cik, r.type, str(r.filing_date), r.year, r.quarter) for r in got] == [(7, "10-K", "2005-04-01", 2005, 2), (8, "8-K", "2005-04-02", 2005, 2)]
    assert str(filings.freshness(spark.read.text(str(folder))).first().update_date) == "2005-06-30"
    (folder / "12.sec21").write_text("x\ny")
    docs = filings.read_documents(spark, str(tmp_path / "in"), ".sec21").collect()
    assert [(d.filing_id, d.year, d.quarter, d.content) for d in docs] == [(12, 2005, 2, "x\ny")]
    (tmp_path / "names").write_text("ACME, INC.:0000000007:\nNO NUMBER\n")
    assert [(r.name, r.cik, r.match_name) for r in filings.read_names(spark, str(tmp_path / "names")).collect()] == [("ACME, INC.", 7, "ACME INC")]


def test_streaming_ingest_skips_what_it_has(spark, tmp_path):
    source, target, checkpoint = (tmp_path / x for x in ("src", "out", "check"))
    source.mkdir()
    (source / "a.idx").write_text("7|ACME|10-K|2005-04-01|e/7.txt\n7|ACME|10-K|2005-04-01|e/7.txt\n8|B|10-K|2005-04-01|e/7.txt\n")
    ingest_index(spark, str(source), str(target), str(checkpoint))
    (source / "b.idx").write_text("7|ACME|10-K|2005-04-01|e/7.txt\n9|C|10-K|2005-04-01|e/9.txt\n")
    ingest_index(spark, str(source), str(target), str(checkpoint))
    ingest_index(spark, str(source), str(target), str(checkpoint))
    assert sorted(r.cik for r in spark.read.parquet(str(target)).collect()) == [7, 8, 9]


def test_sinks(spark, tmp_path):
    p = str(tmp_path / "t")
    a = spark.createDataFrame([(1, 2004, "a"), (2, 2005, "b")], "k int, year int, v string")
    sinks.replace(a, p, ["year"])
    sinks.replace_partitions(spark.createDataFrame([(3, 2005, "c")], "k int, year int, v string"), p, ["year"])
    assert sorted((r.k, r.year) for r in spark.read.parquet(p).collect()) == [(1, 2004), (3, 2005)]
    sinks.replace(a, p)
    sinks.append_missing(spark, spark.createDataFrame([(1, 2009, "x"), (4, 2009, "z"), (4, 2009, "y")], "k int, year int, v string"), p, ["k"], "v")
    assert sorted((r.k, r.v) for r in spark.read.parquet(p).collect()) == [(1, "a"), (2, "b"), (4, "y")]
    state = str(tmp_path / "state")
    assert sinks.get_state(spark, state) == {}
    sinks.set_state(spark, state, update_date="2005-01-01", previous_update="2004-01-01")
    sinks.set_state(spark, state, update_date="2006-01-01")
    assert sinks.get_state(spark, state) == {"update_date": "2006-01-01", "previous_update": "2004-01-01"}


def test_submissions(spark):
    text = "<SEC>\n<DOCUMENT>\n<TYPE>10-K\n<FILENAME>main.htm\n</DOCUMENT>\n<DOCUMENT>\n<TYPE>EX-21.1\n<FILENAME>ex21.htm\nbody</DOCUMENT>\n<DOCUMENT>\n<TYPE>EX-21.2\n</DOCUMENT>"
    d = spark.createDataFrame([("data/7/0001-05-9.txt", text), ("data/7/1.txt", "<DOCUMENT>\n<TYPE>10-K\n</DOCUMENT>"), ("x", None)], "filename string, content string")
    got = filings.with_exhibits(d, "https://e.org").collect()
    assert [(r.has_sec21, r.sec_21_url) for r in got] == [(True, "https://e.org/data/7/0001059/ex21.htm"), (False, None), (False, None)] and "body" in got[0].exhibit


def test_costly_rows_of_one_file_are_dealt_to_tasks(spark):
    pages = spark.range(64).coalesce(1).select(F.col("id").alias("filing_id"), F.col("id").alias("cik"), F.lit("<table><tr><td>Firm Ltd</td><td>Ireland</td></tr></table>").alias("content"))
    headers = pages.withColumn("content", F.format_string("<div id='filerDiv'>%d</div>", "cik"))
    places = locate.Places(
        spark.createDataFrame([("IE", "Ireland")], "country_code string, country_name string"), spark.createDataFrame([], "country_code string, country_name string, subdiv_code string"),
        spark.createDataFrame([], "country_code string, subdivision_code string, subdivision_name string"),
    )
    cells = spark.range(64).coalesce(1).select(F.format_string("Firm %d Ltd", "id").alias("cell"))
    judged = exhibits.judged_cells(cells, places, spark.createDataFrame([], "term string"))
    tasks = lambda d: d.select(F.spark_partition_id()).distinct().count()
    assert tasks(exhibits.exhibit_units(pages)) > 4 and tasks(filings.header_rows(headers, [])) > 4
    assert judged.count() == 64 and exhibits.exhibit_units(pages).select("filing_id").distinct().count() == 64


def test_units_leave_a_worker_by_their_size():
    """A batch of documents of many units isn't held as a whole; what goes out doesn't change."""
    content = "<table>" + "<tr><td>Firm Ltd</td><td>Ireland</td></tr>" * 12000 + "</table>"
    made = list(exhibits.unit_frames(iter([pd.DataFrame({"filing_id": [1, 2], "content": [content, "<p>Firm Ltd</p>"]}), pd.DataFrame({"filing_id": [3], "content": [""]})])))
    want = [(k, *u) for k, c in ((1, content), (2, "<p>Firm Ltd</p>")) for u in exhibits.units_of(c)]
    assert [tuple(None if x != x else x for x in r) for m in made for r in m.itertuples(index=False)] == want and max(map(len, made)) < len(want) / 1.5


def test_cascade_runs_its_patterns_once_and_in_many_tasks(spark):
    made = registry.QUERIES["single_string_cascade"](spark, "/root/testdata/sf0.001")
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert not any("Filter" in line and "regexp_replace" in line for line in plan.splitlines()) and "RepartitionByExpression" in plan


def test_last_pattern_gives_its_groups_without_trying_every_place(spark):
    """Against the pattern as it stands on short texts of its parts; on long ones it took a time that grew with the third power or more."""
    r = random.Random(5)
    parts = ["Firm", "x", "b1", " ", " ", " ", "(", ")", ".", ",", "\n", "\r\n", "\u2028", "ltd", "Co", "S", "S.", "A", "A.", "R.L.", "SAS?", "S.A.S?", "sa", "E", "G", "inc", "orporated", "L.P.", "B.V", "GmbH"]
    texts = ["".join(r.choices(parts, k=r.randrange(1, 10))) + r.choice(["", "", ".", " Ltd", ", S.A.R.L.", " SAG", " Inc\n", "\n co."]) for _ in range(6000)]
    pattern, *groups = exhibits.SINGLE_PATTERNS[exhibits.WHOLE_ALWAYS]
    d = spark.createDataFrame([(x,) for x in texts], "t string")
    got = d.select("t", exhibits._before_forms(F.col("t")).alias("got"), exhibits._groups(F.col("t"), pattern, groups).alias("want")).collect()
    assert all(x.got == x.want for x in got) and sum(bool(x.got) for x in got) > 300
    prose = ["word " * 59 + f"{k}" for k in range(3000)] + ["Firm " + "S." * 140 + f" {k} Ltd. " for k in range(9)]
    began = time.monotonic()
    long = spark.createDataFrame([(x,) for x in prose], "t string").select(exhibits.single_candidates(F.col("t")).alias("c")).collect()
    assert time.monotonic() - began < 10 and [any(y["sub"] == exhibits.WHOLE_ALWAYS for y in x.c) for x in long] == [False] * 3000 + [True] * 9
