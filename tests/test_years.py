import random
from pathlib import Path

from corvane.operators import graph
from corvane.plans.years import SCHEMAS, YearlyGraph
from tests.test_graph import plain_tops


def frames(spark, edges, filers):
    return spark.createDataFrame([(t, s, y) for s, t, y in edges], "cw_id long, parent_cw_id long, year int"), spark.createDataFrame(filers, "cw_id long, year int")


def content(graph):
    return {name: sorted(map(tuple, graph.table(name).collect()), key=str) for name in SCHEMAS}


def files(folder, year):
    return {(p.relative_to(folder), p.stat().st_mtime_ns) for p in Path(folder).rglob(f"year={year}/*.parquet")}


def test_one_year_equals_a_full_build(spark, tmp_path):
    r = random.Random(3)
    years = [2001, 2002, 2003]
    some = lambda y: [(r.randrange(12), r.randrange(12), y) for _ in range(9)]  # noqa: E731  with cycles and loops
    edges, filers = {y: some(y) for y in years}, [(i, y) for y in years for i in range(4)]
    flat = lambda: [e for y in edges for e in edges[y]]
    mine = YearlyGraph(spark, str(tmp_path / "mine"))
    assert mine.rebuild(*frames(spark, flat(), filers), []) == [] and mine.table("company_years").isEmpty()
    mine.rebuild(*frames(spark, flat(), filers), years)
    # a short chain first; then one that moves the step at which all years' search ends
    for k, chain in enumerate(([(i, i + 1, 2002) for i in range(20, 23)], [(i, i + 1, 2002) for i in range(20, 40)])):
        edges[2002] = some(2002) + chain
        kept = {y: files(tmp_path / "mine", y) for y in years}
        made = mine.rebuild(*frames(spark, flat(), filers), [2002])
        full = YearlyGraph(spark, str(tmp_path / f"full{k}"))
        full.rebuild(*frames(spark, flat(), filers), years)
        assert content(mine) == content(full)
        for y in years:
            assert (files(tmp_path / "mine", y) == kept[y]) == (y not in made)
    rows = [(x.cw_id, x.year) for x in mine.table("company_years").collect()]
    loops = [e for e in flat() if e[0] != e[1]]
    want = plain_tops(rows, loops, 100)
    for x in mine.table("company_years").collect():
        up = want[x.cw_id, x.year]
        mutual = (up, x.year) in want and want[up, x.year] != up and want.get((want[up, x.year], x.year)) == up
        assert x.top_parent_id == (max(up, want[up, x.year]) if mutual else up)


def test_years_without_cycles_stay_untouched_and_empty_years_go(spark, tmp_path):
    edges = [(i, i + 1, y) for y in (1, 2) for i in range(3)] + [(7, 8, 3)]
    mine = YearlyGraph(spark, str(tmp_path))
    assert mine.rebuild(*frames(spark, edges, [(5, 2), (6, None)]), [1, 2, 3]) == [1, 2, 3]
    kept = files(tmp_path, 1) | files(tmp_path, 3)
    more = [e for e in edges if e[2] != 2] + [(i, i + 1, 2) for i in range(6)]
    assert mine.rebuild(*frames(spark, more, []), [2]) == [2]
    assert files(tmp_path, 1) | files(tmp_path, 3) == kept and len(kept) >= 7
    assert {(x.cw_id, x.top_parent_id) for x in mine.table("company_years").filter("year = 2").collect()} == {(i, 0) for i in range(1, 7)}
    assert mine.rebuild(*frames(spark, [e for e in edges if e[2] == 1], []), [2, 3]) == [2, 3]
    assert {x.year for name in SCHEMAS for x in mine.table(name).select("year").collect()} == {1}


def test_degrees_and_tops_take_one_shuffle_and_the_same_rows(spark):
    """Mutual tops are sought among the companies without a top only; those of the others and degrees need no join."""
    r = random.Random(8)
    for most, cycles in ((100, True), (3, True), (100, False)):
        pairs = {(r.randrange(30), r.randrange(30), y) for y in (1, 2) for _ in range(24)}
        edges = spark.createDataFrame([e for e in pairs if (e[0] != e[1] if cycles else e[0] < e[1])], "source long, target long, year int").cache()
        info = spark.createDataFrame([(i, y) for i in range(0, 40, 3) for y in (1, 2)], "cw_id long, year int").unionByName(edges.selectExpr("target as cw_id", "year")).distinct().cache()
        found = graph.closure(info, edges, most)
        steps = graph.last_step({x.n for x in found.distances().filter("not open").collect()}, most)
        made = graph.tops_with_degrees(found.tops(steps, merge=True), edges)
        want = graph.degrees(info, edges).join(graph.merge_mutual(found.tops(steps)), ["cw_id", "year"])
        assert sorted(map(tuple, made.select(want.columns).collect())) == sorted(map(tuple, want.collect())) and made.count() == info.count()
        assert sorted(graph.top_parents(info, edges, most, merge=True).collect()) == sorted(want.select("cw_id", "year", "top_parent_id").collect())
        if not cycles:
            plan = made._jdf.queryExecution().executedPlan().toString()
            assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
