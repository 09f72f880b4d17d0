import os
import subprocess
import sys
from pathlib import Path

from pyspark.sql import functions as F

from corvane.plans import build
from corvane.plans import standin as S
from corvane.plans.registry import Tables
from corvane.sources import filings as sources
from corvane.streaming.documents import FilingStore


def inputs(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    # cik 0 stands for none
    keep = lambda d, c="cik": d.filter(F.col(c).between(1, 39))
    filers = keep(S.filers(t)).withColumn("filing_id", F.col("filer_id"))
    return {
        "filings": keep(S.filings(t)), "filers": filers, "relationships": keep(S.relationships(t), "filer_cik").drop("clean_company"), "registry": S.registry(t),
        "master_names": S.master_names(t), "region_codes": spark.createDataFrame([("S1", "US", "X1")], "code string, country_code string, subdiv_code string"),
        "sic_codes": spark.createDataFrame([(1, "mining", 2)], "sic_code int, industry_name string, sic_sector int"), "sic_sectors": spark.createDataFrame([(2, "earth")], "sic_sector int, sector_name string"),
    }


def test_build_and_rebuild(spark):
    tables = inputs(spark)
    made = build.company_graph(tables, list(range(1995, 2003)))
    info = made["company_info"]
    assert info.count() == info.select("cw_id", "year").distinct().count() > 0
    edges = made["all_relations"]
    kids = edges.groupBy(F.col("source").alias("cw_id"), "year").agg(F.count_distinct("target").alias("k"))
    assert info.join(kids, ["cw_id", "year"], "left").filter("coalesce(k, 0) <> num_children").count() == 0
    assert info.filter("best_location_id is null or top_parent_id is null or company_name is null").count() == 0
    assert info.filter("most_recent and year <> max_year").count() == 0
    tops = info.select(F.col("top_parent_id").alias("target"), "year").distinct()
    assert made["company_relations"].join(tops, ["target", "year"]).count() == 0
    assert made["companies"].count() == made["companies"].select("cw_id").distinct().count()
    assert {r.sector_name for r in info.filter("sic_code = 1").select("sector_name").distinct().collect()} == {"earth"}

    again = build.company_graph(tables | {"registry": build.next_registry(made["registry"])}, list(range(1995, 2003)))
    key = lambda m: sorted((r.cik or 0, r.company_name, r.cw_id) for r in m["companies"].filter("source_type = 'filers'").collect())
    assert key(made) == key(again)


def lookup_tables(spark):
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    return {
        "countries": frame([("US", "United States"), ("IE", "Ireland")], "country_code string, country_name string"), "aliases": frame([], "country_code string, country_name string, subdiv_code string"),
        "subdivisions": frame([("US", "DE", "Delaware")], "country_code string, subdivision_code string, subdivision_name string"), "stop_terms": frame([("Total",)], "term string"),
        "region_codes": frame([("DE", "US", "DE")], "code string, country_code string, subdiv_code string"), "sic_codes": frame([(1, "mining", 2)], "sic_code int, industry_name string, sic_sector int"),
        "sic_sectors": frame([(2, "earth")], "sic_sector int, sector_name string"),
    }


def put(folder, files):
    for name, content in files.items():
        (folder / name).parent.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text(content)


def header(k, name):
    return (
        f'<div id="filerDiv"><div class="mailer">Business Address <span>{k} Main St</span><span>Dover DE 19901</span></div><span class="companyName">{name} (Filer) CIK: {k}</span>'
        f'<p class="identInfo">IRS No.: 1{k} | State of Incorp.: DE | Fiscal Year End: 1231<br/>SIC: 1</p></div>'
    )


def index_file(quarter, rows):
    return {f"index/2004/{quarter}/company.idx": "CIK|Company Name|Form Type|Date Filed|Filename\n-----\n" + "".join(f"{cik}|{name}|{kind}|2004-0{3 * quarter}-01|d/{cik}.txt\n" for cik, name, kind in rows)}


def submission(*rows):
    cells = "".join(f"<tr><td>{a}</td><td>{b}</td></tr>" for a, b in rows)
    return f"<DOCUMENT>\n<TYPE>EX-21\n<FILENAME>ex.htm\n<TEXT><html><table>{cells}</table></html></TEXT></DOCUMENT>" if rows else "<DOCUMENT>\n<TYPE>10-K\n<FILENAME>b.htm\n</DOCUMENT>"


def rows_of(table, *without):
    columns = sorted(c for c in table.columns if c not in without)
    return sorted(str(tuple(r)) for r in table.select(*columns).collect())


def two_quarters(folder):
    """Documents of quarter 1, and those of quarter 2, whose filers have the smaller numbers."""
    first = index_file(1, [(700003, "ACME CORP", "10-K"), (700005, "GAMMA", "8-K"), (700004, "BETA CORP", "10-K")])
    first |= {"submissions/2004/1/1.txt": submission(("Beta Corporation", "Delaware"), ("Delta Ltd", "Ireland"), ("Foo Ltd", "Atlantis")), "submissions/2004/1/2.txt": submission()}
    first |= {"headers/2004/1/1.html": header(700003, "ACME CORP"), "headers/2004/1/2.html": header(700004, "BETA CORP"), "names/list.txt": "ACME CORP:700003:\nBETA CORP:700004:\n"}
    second = index_file(2, [(700001, "SMALL CORP", "10-K"), (700003, "ACME CORP", "10-K"), (700002, "EARLY CORP", "10-K/A")])
    second |= {"submissions/2004/2/4.txt": submission(("Acme Corp", "Delaware"), ("Kappa Ltd", "Ireland")), "submissions/2004/2/5.txt": submission(("Lambda Ltd", "Ireland"))}
    second |= {"headers/2004/2/4.html": header(700001, "SMALL CORP"), "headers/2004/2/5.html": header(700002, "EARLY CORP")}
    return first, second


def test_filings_keep_their_identifiers(spark, tmp_path):
    first, second = two_quarters(tmp_path)
    put(tmp_path, first)
    lookups = lookup_tables(spark)
    one = build.from_documents(spark, str(tmp_path), lookups, [2004])
    before = {tuple(r) for r in one["filing_ids"].collect()}
    was = {name: rows_of(one[name], "relationship_id", "loaded_at") for name in ("filings", "filers")}
    put(tmp_path, second)
    two = build.from_documents(spark, str(tmp_path), lookups | {"filing_ids": one["filing_ids"]}, [2004])
    after = {tuple(r) for r in two["filing_ids"].collect()}
    assert before < after and {r[-1] for r in after} == {1, 2, 3, 4, 5}
    assert [(r[0], r[-1]) for r in sorted(after - before)] == [(700001, 4), (700002, 5)]
    for name in was:
        assert set(was[name]) < set(rows_of(two[name], "relationship_id", "loaded_at"))
    edges = {r.company_name for r in two["companies"].collect()}
    assert {"Kappa Ltd", "Lambda Ltd", "Delta Ltd", "SMALL CORP"} <= edges


def test_batches_give_the_tables_of_one_load(spark, tmp_path):
    first, second = two_quarters(tmp_path)
    lookups, names = lookup_tables(spark), None
    store = FilingStore(spark, str(tmp_path / "store"), files_per_batch=1)
    late = {k: v for k, v in first.items() if k.startswith("index")}
    put(tmp_path / "in", {k: v for k, v in first.items() if k not in late} | {"index/readme": ""})
    store.load(str(tmp_path / "in"), lookups)  # documents before their index: they wait
    assert store.table("documents").rows() is None
    put(tmp_path / "in", late)
    store.load(str(tmp_path / "in"), lookups)
    put(tmp_path / "in", second)
    store.load(str(tmp_path / "in"), lookups)
    store.load(str(tmp_path / "in"), lookups)  # nothing new
    put(tmp_path / "in", {"submissions/2004/3/4.txt": submission(("Wrong Ltd", "Ireland"))})  # the first stays
    store.load(str(tmp_path / "in"), lookups)
    put(tmp_path / "all", first)
    one = build.from_documents(spark, str(tmp_path / "all"), lookups, [2004])
    put(tmp_path / "all", second)
    whole = build.from_documents(spark, str(tmp_path / "all"), lookups | {"filing_ids": one["filing_ids"]}, [2004])
    names = sources.read_names(spark, str(tmp_path / "all/names"))
    got = store.publish(lookups, names, [2004])
    for name in ("filing_ids", "filings", "filers", "bad_locations"):
        assert rows_of(got[name], "loaded_at") == rows_of(whole[name], "loaded_at"), name
    named = lambda made: {r.cw_id: r.company_name for r in made["companies"].collect()}
    edges = lambda made, n: sorted((n[r.source], n[r.target], r.year) for r in made["all_relations"].collect())
    assert edges(got, named(got)) == edges(whole, named(whole)) and len(edges(got, named(got))) == 5


def test_a_repeated_batch_stores_its_rows_once(spark, tmp_path):
    first, _ = two_quarters(tmp_path)
    put(tmp_path, first)
    lookups = lookup_tables(spark)
    store = FilingStore(spark, str(tmp_path / "store"))
    index = sources.read_index(spark, str(tmp_path / "index"))
    documents = sources.read_documents(spark, str(tmp_path / "submissions"), ".txt")
    for _ in range(2):
        store.store_index(index, 0)
        store.store_submissions(documents, 0, lookups, "")
    assert store.table("filing_ids").rows().count() == 3 and store.table("documents").rows().count() == 2 and store.table("relationships").rows().count() == 2


def test_table_functions_reach_workers_without_a_path(tmp_path):
    """A program elsewhere that finds the package by its own sys.path only."""
    root = str(Path(__file__).resolve().parents[1])
    code = f"""
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from corvane.sources import exhibits, filings
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
d = spark.createDataFrame([(1, 7, '<table><tr><td>a b</td><td>c</td></tr></table><div id="filerDiv">7</div>')], "filing_id long, cik long, content string")
print("FOUND", exhibits.exhibit_units(d).count() > 0, filings.header_rows(d, ["DE"]).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    got = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "FOUND True 1" in got.stdout, got.stderr[-2000:]


def test_from_documents(spark, tmp_path):
    """Files in, published tables out."""
    files = {
        "index/2004/1/company.idx": "CIK|Company Name|Form Type|Date Filed|Filename\n-----\n700001|ACME CORP|10-K|2004-02-01|d/1.txt\n700002|BETA CORP|10-K|2004-02-03|d/2.txt\n700003|GAMMA|8-K|2004-02-03|d/3.txt\n",
        "names/list.txt": "ACME CORP:700001:\nBETA CORP:700002:\n",
        "submissions/2004/1/1.txt": "<DOCUMENT>\n<TYPE>10-K\n<FILENAME>a.htm\n</DOCUMENT>\n<DOCUMENT>\n<TYPE>EX-21\n<FILENAME>ex.htm\n<TEXT><html><table><tr><td>Beta Corporation</td><td>Delaware</td></tr><tr><td>Delta Ltd</td><td>Ireland</td></tr><tr><td>Foo Ltd</td><td>Atlantis</td></tr></table></html></TEXT></DOCUMENT>",
        "submissions/2004/1/2.txt": "<DOCUMENT>\n<TYPE>10-K\n<FILENAME>b.htm\n</DOCUMENT>",
    }
    for k, name in ((1, "ACME CORP"), (2, "BETA CORP")):
        files[f"headers/2004/1/{k}.html"] = (
            f'<div id="filerDiv"><div class="mailer">Business Address <span>{k} Main St</span><span>Dover DE 19901</span></div><span class="companyName">{name} (Filer) CIK: 70000{k}</span>'
            f'<p class="identInfo">IRS No.: 1100{k} | State of Incorp.: DE | Fiscal Year End: 1231<br/>SIC: 1</p></div>'
        )
    for name, content in files.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(content)
    lookups = lookup_tables(spark)
    made = build.from_documents(spark, str(tmp_path), lookups, [2004])
    named = {r.cw_id: r.company_name for r in made["companies"].collect()}
    edges = sorted((named[r.source], named[r.target], r.year) for r in made["all_relations"].collect())
    assert edges == [("ACME CORP", "BETA CORP", 2004), ("ACME CORP", "Delta Ltd", 2004)]  # the filer itself, found by its name and place, and a new company
    info = {r.company_name: r for r in made["company_info"].collect()}
    assert info["ACME CORP"].num_children == 2 and info["Delta Ltd"].top_parent_id == info["ACME CORP"].cw_id and info["BETA CORP"].sector_name == "earth"
    assert [r.company_name for r in made["bad_locations"].collect()] == ["Foo Ltd"]
    got = {r.filing_id: r for r in made["filings"].collect()}
    assert (got[1].has_sec21, got[1].rows_parsed, got[1].tables_parsed, got[2].has_sec21, got[2].rows_parsed) == (True, 2, 1, False, None) and len(got) == 2
