import random

from corvane.operators import report


def plain(filings, filers, relationships, empty, info, edges):
    """Each metric by its definition, with sets; a null year or identifier equals nothing, but years are grouped with null as one."""
    out = {}
    years = lambda rows, k: {r[k] for r in rows}
    put = lambda y, m, v: out.__setitem__((y, m), v)
    parsed, blank = {r[1] for r in relationships}, {r[0] for r in empty if r[1] == 1}
    for y in years(filings, 2):
        of = [r for r in filings if r[2] == y]
        known = [r[3] for r in of if r[3] is not None]
        e, p, z = (float(sum(known)) if known else None), float(sum(r[0] in parsed for r in of)), float(sum(r[0] in blank for r in of))
        share = lambda w, p=p: p / w * 100 if w else None
        for m, v in (("with_exhibit", e), ("parsed", p), ("empty", z), ("percent_parsed", share(e)), ("percent_true_parsed", share(None if e is None else e - z))):
            put(y, m, v)
    for name, rows, k in (("filing_companies", filers, 0), ("relationships", relationships, 2), ("companies", info, 1), ("company_relations", edges, 2)):
        for y in years(rows, k):
            put(y, name, float(sum(r[k] == y for r in rows)))
    child = {(r[1], r[2]) for r in edges if r[2] is not None}
    ever, parent = {r[1] for r in edges}, {(r[0], r[2]) for r in edges if r[2] is not None}
    year_of = {r[0]: (r[1], r[2]) for r in filings}
    for y in years(info, 1):
        of = {r[0] for r in info if r[1] == y and r[0] is not None}
        found = {
            "isolated": {r[0] for r in info if r[1] == y and r[3] == 0 and r[4] == 0 and r[0] is not None}, "top_level": {c for c in of if (c, y) not in child},
            "top_level_with_children": {c for c in of if (c, y) in parent and c not in ever},
            "filers_with_hierarchy": {
                r[0] for r in info for x in relationships if r[1] == y is not None and None not in (r[0], r[2], x[3]) and year_of.get(x[1]) == (r[2], y) and x[3] != r[0]
            },
        }
        for m, s in found.items():
            if s:
                put(y, m, float(len(s)))
    return out


def test_coverage_against_sets(spark):
    r = random.Random(1)
    pick = lambda n: None if r.random() < 0.1 else r.randrange(n)
    filings = [(i, pick(12), pick(4), r.choice([True, False, None])) for i in range(200)]
    relationships = [(i, pick(220), pick(4), pick(12)) for i in range(300)]
    empty = [(pick(200), r.choice([1, 2])) for i in range(60)]
    info = [(pick(14), pick(4), pick(12), r.choice([0, 1, None]), r.choice([0, 1])) for i in range(60)]
    edges = [(pick(14), pick(14), pick(4)) for i in range(25)]
    filers = [(r[2],) for r in filings]
    schemas = (
        "filing_id long, cik long, year int, has_sec21 boolean", "year int", "relationship_id long, filing_id long, year int, parent_cw_id long", "filing_id long, code int",
        "cw_id long, year int, cik long, num_children long, num_parents long", "source long, target long, year int",
    )
    frames = [spark.createDataFrame(rows, s) for rows, s in zip((filings, filers, relationships, empty, info, edges), schemas, strict=True)]
    got = {(x.year, x.metric): x.value for x in report.coverage_metrics(*frames).collect()}
    want = plain(filings, filers, relationships, empty, info, edges)
    assert got.keys() == want.keys() and all(got[k] == want[k] or abs(got[k] - want[k]) < 1e-9 for k in want)
    assert report.coverage_metrics(*[f.limit(0) for f in frames]).count() == 0
