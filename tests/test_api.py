import hashlib

import pytest
from pyspark.sql import functions as F

from corvane.operators import graph, relational, report
from corvane.plans import api


@pytest.fixture(scope="module")
def directory(spark):
    nodes = [(i, y, f"Company {i} Holdings", i % 3) for i in range(1, 30) for y in (2004, 2005, 2006) if (i + y) % 4]
    edges = [(i // 3, i, y) for i, y, *_ in nodes if i // 3 and any(n[:2] == (i // 3, y) for n in nodes)]
    info = spark.createDataFrame(nodes, "cw_id long, year int, company_name string, sic_code int")
    edges = spark.createDataFrame(edges, "source long, target long, year int")
    info = relational.with_year_range(graph.degrees(info, edges), "cw_id", "year")
    names = spark.createDataFrame([(i, f"Old {i}", 2004, 2005) for i in range(1, 30)], "cw_id long, company_name string, min_year int, max_year int")
    locations = spark.createDataFrame([(i, "1 Main Street", "business", 2004, 2006) for i in range(1, 30)], "cw_id long, raw_address string, type string, min_year int, max_year int")
    return api.Directory(info, edges, names, locations)


def test_children_equal_the_objects_themselves(directory):
    kids = directory.children(2, 2005).collect()
    assert kids
    for k in kids:
        assert directory.company(k.cw_id, 2005).collect() == [k]


def test_counts_equal_the_lists(directory):
    for cw_id in (1, 2, 5, 9):
        for row in directory.history(cw_id).collect():
            assert row.num_children == directory.children(cw_id, row.year).count()
            assert row.num_parents == directory.parents(cw_id, row.year).count()


def test_unversioned_is_the_latest(directory):
    for cw_id in (2, 5):
        last = max(r.year for r in directory.history(cw_id).collect())
        for f in (directory.company, directory.children, directory.parents, directory.names_of, directory.locations_of):
            assert sorted(f(cw_id).collect()) == sorted(f(cw_id, last).collect())


def test_searches(directory):
    assert {r.cw_id for r in directory.search(company_name="company 7").collect()} == {7}
    assert directory.search(company_name="ompan", substring=True).count() == directory.search().count() > directory.search(company_name="ompan").count() == 0
    assert directory.search(sic_code=1, company_name="").count() == directory.search(sic_code=1).count()
    assert directory.search_names("old 3", min_year=2006).count() == 0 and directory.search_names("OLD 3").count() == 1
    assert directory.search_locations("main", type_="business").count() == 29 and directory.search_locations(type_="x").count() == 0
    assert [r.year for r in directory.years().collect()] == [2004, 2005, 2006]


def test_indexes_find_what_scans_find(spark, directory, tmp_path):
    indexed = directory.with_indexes(str(tmp_path / "index"))
    for text, substring in (("company 7", False), ("COMPANY", False), ("ompan", True), ("7 h", True), ("y", True), ("nobody", True), ("nobody", False), ("old 3", False), ("d 1", True), ("/", False), ("Ó", True)):
        for f in ("search", "search_names"):
            assert sorted(getattr(indexed, f)(company_name=text, substring=substring).collect()) == sorted(getattr(directory, f)(company_name=text, substring=substring).collect()), (text, f)
        assert sorted(indexed.search_locations(text, substring=substring).collect()) == sorted(directory.search_locations(text, substring=substring).collect())
    assert indexed.search_locations("ain str", substring=True).count() == 29


def test_an_index_reads_few_files_and_grows(spark, tmp_path):
    names = spark.range(40_000).select("id", F.concat(F.lit("Firm "), F.md5(F.col("id").cast("string")), F.lit(" Inc")).alias("name"))
    index = api.TextIndex.build(names, "id", "name", str(tmp_path / "index"))
    wanted = hashlib.md5(b"777").hexdigest()
    for text, substring in ((wanted, False), (wanted[3:20], True)):
        assert [r.id for r in index.search(text, substring).collect()] == [777]
    rows = spark.read.parquet(str(tmp_path / "index/words")).filter(F.col("_token") == wanted)
    files = [m["numOutputRows"] for m in scans(rows)]
    assert len(files) == 1 and files[0] < 30_000
    index.extend(spark.createDataFrame([(777, "Changed"), (50_000, "Ünique Words"), (50_001, None)], "id long, name string"), "id", "name")
    assert [r.id for r in index.search("unique").collect()] == [r.id for r in index.search("QUE WO", True).collect()] == [50_000]
    assert index.search("changed").count() == 0


def scans(df):
    """The metrics of a plan's scans after it ran."""
    df.collect()
    plan, out = df._jdf.queryExecution().executedPlan(), []
    leaves = plan.collectLeaves()
    for i in range(leaves.size()):
        metrics = leaves.apply(i).metrics()
        out.append({k: metrics.apply(k).value() for k in ("numOutputRows", "numFiles") if metrics.contains(k)})
    return out


def test_pages_by_key(spark, tmp_path):
    rows = spark.range(20_000).select((F.col("id") * 7919 % 500).cast("int").alias("k"), "id", F.when(F.col("id") % 9 == 0, None).otherwise(F.lit("x")).alias("v"))
    rows = rows.withColumn("k", F.when(F.col("k") < 3, None).otherwise(F.col("k")))
    pages = api.KeyedPages.build(rows, ("k", "id"), str(tmp_path / "pages"), part_rows=900)
    want = sorted(((r.k, r.id) for r in rows.collect()), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    after, got = None, []
    for n in range(9):
        found = pages.after(after, 1300)
        if n in (0, 7):
            assert "offset" not in found._jdf.queryExecution().optimizedPlan().toString().lower().replace("globallimit", "")
            assert 0 < sum(m.get("numFiles", 0) for m in scans(found)) <= 5
        page = [(r.k, r.id) for r in found.collect()]
        got += page
        after = page[-1]
    assert got == want[: 9 * 1300]
    assert pages.after(want[-1]).count() == 0 and [(r.k, r.id) for r in pages.after(want[-4], 10).collect()] == want[-3:]
    assert api.KeyedPages.build(rows.limit(0), ("k", "id"), str(tmp_path / "none")).after().count() == 0


def test_pages_and_meta(directory):
    rows = directory.search()
    first, second = (api.page(rows, "cw_id", limit=5, offset=o).collect() for o in (0, 5))
    assert [r.cw_id for r in first + second] == sorted(r.cw_id for r in rows.collect())[:10]
    empty = api.meta(directory.search(company_name="nobody"), company_name="nobody", year=None)
    assert empty == {"total_results": 0, "parameters": {"company_name": "nobody"}, "status_string": "OK"}


def test_report(spark):
    long = spark.createDataFrame([(2004, "a", 1.0), (2005, "a", 2.0), (2005, "b<", 3.0)], "year int, metric string, value double")
    assert report.as_html(long) == "<table><tr><th>metric</th><th>2004</th><th>2005</th></tr><tr><td>a</td><td>1.0</td><td>2.0</td></tr><tr><td>b&lt;</td><td></td><td>3.0</td></tr></table>"


def test_small_parts_share_files(spark, tmp_path):
    """Tasks and files follow the rows, not the number of parts."""
    rows = spark.range(3000).select((F.col("id") % 7).alias("k"), "id")
    pages = api.KeyedPages.build(rows, ("k", "id"), str(tmp_path / "pages"), part_rows=10)
    assert len(list((tmp_path / "pages" / "rows").glob("_file=*"))) == 1
    want = sorted((i % 7, i) for i in range(3000))
    assert [tuple(r) for r in pages.after(want[1234], 25).collect()] == want[1235:1260] and spark.read.parquet(f"{pages.path}/parts").count() == 300
