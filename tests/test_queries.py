"""Every query with SQL gives the same rows as DuckDB; the others at least run."""

import duckdb
import pytest

from corvane.plans import entity_queries, queries, registry, source_queries  # noqa: F401

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents pages".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(rows, names):
    order = sorted(range(len(names)), key=names.__getitem__)
    show = lambda v: round(v, 9) if isinstance(v, float) else v
    return sorted(str([show(r[i]) for i in order]) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, con, name):
    got = registry.QUERIES[name](spark, SF)
    rows = got.collect()
    if name in registry.ORACLES:
        want = con.execute(registry.ORACLES[name])
        columns = [d[0] for d in want.description]
        assert sorted(columns) == sorted(got.columns)
        assert plain(rows, got.columns) == plain(want.fetchall(), columns)
    else:
        assert rows
