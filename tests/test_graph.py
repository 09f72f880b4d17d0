import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corvane.operators import graph


def stack(indents):
    """Parents and levels by an explicit stack; rows are numbered from 1, 0 is no parent."""
    entries, level, out = [(0, 0)], 0, []
    for row, h in enumerate(indents, 1):
        if h > entries[level][0]:
            level += 1
        else:
            while level > 0 and h < entries[level][0]:
                level -= 1
        del entries[level:]
        entries.append((h, row))
        out.append((entries[level - 1][1] if level else 0, level))
    return out


def frame(spark, groups):
    rows = [(g, n, n + 1, float(h)) for g, hs in groups.items() for n, h in enumerate(hs)]
    return spark.createDataFrame(rows, "g long, o int, id long, h double")


def test_indents(spark):
    got = graph.indent_parents(frame(spark, {1: [0, 2, 4, 3, 0, 1], 2: [0, 0, 0], 3: [5, 1, 7]}), "g", "o", "id", "h").collect()
    assert {(r.g, r.id): r.parent for r in got} == {(1, 2): 1, (1, 3): 2, (1, 4): 1, (1, 6): 5, (3, 3): 2}


def test_last_row_of_a_repeated_entity_wins(spark):
    rows = [(1, 0, 10, 0.0), (1, 1, 20, 1.0), (1, 2, 30, 0.0), (1, 3, 20, 1.0)]
    got = graph.indent_parents(spark.createDataFrame(rows, "g long, o int, id long, h double"), "g", "o", "id", "h").collect()
    assert [(r.id, r.parent) for r in got] == [(20, 30)]


def test_indents_of_long_groups(spark):
    """Groups of several blocks, one of them far deeper than the others."""
    r = random.Random(1)
    groups = {1: [r.randrange(6) for _ in range(3 * graph.BLOCK + 7)], 2: [r.randrange(3) for _ in range(graph.BLOCK)], 3: list(range(40))}
    got = {(x.g, x.pos): x.level for x in graph.indent_levels(frame(spark, groups), "g", "o", "id", "h").collect()}
    assert got == {(g, n): level for g, hs in groups.items() for n, (_, level) in enumerate(stack(hs))}


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.integers(0, 5), min_size=1, max_size=12), min_size=1, max_size=6))
def test_indents_against_a_stack(spark, groups):
    groups = dict(enumerate(groups))
    got = {(r.g, r.pos): r.level for r in graph.indent_levels(frame(spark, groups), "g", "o", "id", "h").collect()}
    assert got == {(g, n): level for g, hs in groups.items() if len(set(hs)) > 1 for n, (_, level) in enumerate(stack(hs))}


def info_edges(spark, nodes, edges):
    return spark.createDataFrame(nodes, "cw_id long, year int"), spark.createDataFrame(edges, "source long, target long, year int")


def tops(spark, nodes, edges):
    return {(r.cw_id, r.year): r.top_parent_id for r in graph.top_parents(*info_edges(spark, nodes, edges)).collect()}


def test_closure(spark):
    chain = [(i, 2000) for i in range(1, 7)] + [(3, 2001)]
    assert tops(spark, chain, [(i, i + 1, 2000) for i in range(1, 6)] + [(4, 3, 2001)]) == {**{(i, 2000): 1 for i in range(1, 7)}, (3, 2001): 4}
    assert tops(spark, [(1, 1), (2, 1), (3, 1)], [(2, 3, 1), (1, 3, 1)])[(3, 1)] == 1  # of two parents the smaller
    three = tops(spark, [(1, 1), (2, 1), (3, 1)], [(1, 2, 1), (2, 3, 1), (3, 1, 1)])
    assert set(three.values()) <= {1, 2, 3}


def test_mutual_parents_and_cut(spark):
    info = spark.createDataFrame([(1, 1, 2), (2, 1, 1), (3, 1, 1), (4, 1, 2), (1, 2, 1)], "cw_id long, year int, top_parent_id long")
    got = {(r.cw_id, r.year): r.top_parent_id for r in graph.merge_mutual(info).collect()}
    assert got == {(1, 1): 2, (2, 1): 2, (3, 1): 2, (4, 1): 2, (1, 2): 1}
    edges = spark.createDataFrame([(1, 2, 1), (2, 3, 1), (1, 2, 2)], "source long, target long, year int")
    assert sorted(map(tuple, graph.cut_top_edges(edges, graph.merge_mutual(info)).collect())) == [(1, 2, 2), (2, 3, 1)]


def test_degrees_do_not_multiply(spark):
    info, edges = info_edges(spark, [(1, 1), (2, 1), (9, 1)], [(1, 2, 1), (1, 3, 1), (5, 1, 1), (6, 1, 1)])
    got = {r.cw_id: (r.num_children, r.num_parents) for r in graph.degrees(info, edges).collect()}
    assert got == {1: (2, 2), 2: (0, 1), 9: (0, 0)}


def plain_tops(rows, edges, most_steps):
    up = {}
    for source, target, year in edges:
        up[target, year] = min(source, up.get((target, year), source))
    up = {k: v for k, v in up.items() if k[0] != v}
    now, before = {r: r[0] for r in rows}, None
    for _ in range(most_steps):
        moved = sum((top, y) in up for (_, y), top in now.items())
        now = {(c, y): up.get((top, y), top) for (c, y), top in now.items()}
        if moved in (0, before):
            break
        before = moved
    return now


def test_tops_are_those_of_single_steps(spark, monkeypatch):
    r = random.Random(3)
    for nodes, steps in ((12, 100), (12, 5), (40, 100), (40, 3), (40, 1)):
        rows = sorted({(r.randrange(nodes), r.choice([2001, 2002, None])) for _ in range(2 * nodes)}, key=repr)  # not every parent is a row
        edges = [(r.randrange(nodes), r.randrange(nodes), r.choice([2001, 2001, 2002, None])) for _ in range(nodes)]
        info, links = spark.createDataFrame(rows, "cw_id long, year int"), spark.createDataFrame(edges, "source long, target long, year int")
        got = {(x.cw_id, x.year): x.top_parent_id for x in graph.top_parents(info, links, steps).collect()}
        assert got == plain_tops(rows, edges, steps)
    chain = spark.createDataFrame([(i, i + 1, 2001) for i in range(1000)], "source long, target long, year int")
    info = spark.range(1001).select(F.col("id").alias("cw_id"), F.lit(2001).alias("year"))
    made = []
    monkeypatch.setattr(graph, "written", lambda d, name, f=graph.written: made.append(name) or f(d, name))
    assert {x.top_parent_id for x in graph.top_parents(info, chain, 2000).collect()} == {0}
    assert made.count("paths") == 11


def plain_indents(rows):
    """(id, parent, level) by one stack."""
    parents, level, out = [(0.0, 0)], 0, []
    for _, i, h in rows:
        if h > parents[level][0]:
            level += 1
        else:
            while level > 0 and parents[level][0] > h:
                level -= 1
        out.append((i, parents[level - 1][1] if level else 0, level))
        parents[level:] = [(h, i)]
    return out


def test_parts_of_a_group_are_one_stack(spark):
    r = random.Random(4)
    rows = [(g, k, 10_000 * g + k, float(r.choice([-1, 0, 0, 3, 5, 5, 8, 8.5, 13, 20]))) for g in range(6) for k in range(r.choice([1, 2, 30, 200]))]
    rows += [(9, k, 90_000 + k, float(abs(k % 40 - 20))) for k in range(400)] + [(10, k, k, 4.0) for k in range(50)]
    d = spark.createDataFrame(rows, "g long, o long, id long, h double")
    for part_rows in (10**6, 37, 3):
        got = {}
        for x in graph._indents(d, "g", "o", "id", "h", part_rows).collect():
            got.setdefault(x.g, []).append((x.pos, x.id, x.parent, x.level))
        for g in {x[0] for x in rows}:
            mine = [x[1:] for x in rows if x[0] == g]
            want = [(k, *x) for k, x in enumerate(plain_indents(mine))] if len({x[2] for x in mine}) > 1 else None
            assert (sorted(got[g]) if g in got else None) == want, (g, part_rows)


def test_a_large_group_is_several_tasks(spark):
    n = 300_000
    d = spark.range(n).select(F.lit(1).alias("g"), F.col("id").alias("o"), F.col("id"), (F.xxhash64("id") % 7).cast("double").alias("h"))
    got = graph._indents(d, "g", "o", "id", "h", 20_000)
    want = plain_indents([(x.o, x.id, x.h) for x in d.collect()])
    assert [(x.id, x.parent, x.level) for x in got.orderBy("pos").collect()] == want
