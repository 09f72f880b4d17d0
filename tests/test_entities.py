import random

import pytest

from corvane.functions import text as T
from corvane.operators import fuzzy, locate, relational, resolve
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def places(spark):
    countries = spark.createDataFrame([("US", "United States"), ("CA", "Canada"), ("GE", "Georgia"), ("IE", "Ireland"), ("GB", "United Kingdom")], "country_code string, country_name string")
    aliases = spark.createDataFrame([("GB", "England", "ENG"), ("GB", "Great Britain", None), ("US", "U.S.A.", None)], "country_code string, country_name string, subdiv_code string")
    subs = spark.createDataFrame(
        [("US", "DE", "Delaware"), ("US", "NY", "New York"), ("US", "GA", "Georgia"), ("US", "CA", "California"), ("CA", "ON", "Ontario"), ("CA", "BC", "British Columbia")],
        "country_code string, subdivision_code string, subdivision_name string",
    )
    return locate.Places(countries, aliases, subs)


PLACES = [
    ("Ontario, Canada", "CA", "ON"), ("Canada, Ontario", "CA", "ON"), ("New York", "US", "NY"), ("NY", "US", "NY"), ("a Delaware corporation", "US", "DE"), ("England", "GB", "ENG"),
    ("Great Britain", "GB", None), ("organized under the laws of Ireland", "IE", None), ("ireland", "IE", None), ("Albany, New York", "US", "NY"), ("Albany, NY", "US", "NY"), ("Atlantis", None, None),
    ("Georgia", "US", "GA"), ("Ontario (Canada)", "CA", "ON"), ("Acme, Inc", None, None), ("", None, None), (None, None, None), ("incorporated in the state of California", "US", "CA"), ("CANADA", "CA", None),
]


def test_places(spark, places):
    d = spark.createDataFrame([(i, p) for i, (p, _, _) in enumerate(PLACES)], "i int, place string")
    got = {r.i: (r.country_code, r.subdiv_code) for r in locate.resolve_places(d, "place", places).collect()}
    want = {i: (cc, sc) for i, (_, cc, sc) in enumerate(PLACES)}
    assert got[13] in (("CA", "ON"), ("US", "CA"), (None, None))  # text in parentheses is dropped, which leaves "Ontario,"
    got.pop(13), want.pop(13)
    assert got == want


def test_batch_tags(spark, places):
    rows = [("ny", "US", "NY"), ("Georgia", "US", "GA"), ("Ireland", "IE", None), ("England", "GB", "ENG"), ("Albany, NY", "US", "NY"), ("Ontario", "CA", "ON"), ("Dublin, Ireland", "IE", None), ("X", None, None), (None, None, None)]
    codes = spark.createDataFrame([("NY", "US", "NY")], "code string, country_code string, subdiv_code string")
    d = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "i int, place string")
    assert {r.i: (r.country_code, r.subdiv_code) for r in locate.tag_places(d, "place", codes, places).collect()} == {i: r[1:] for i, r in enumerate(rows)}


def overlap(a, b, w):
    weight = lambda t: w.get(t, 0.2)
    whole = sum(map(weight, a)) + sum(map(weight, b))
    return 2 * sum(weight(t) for t in a if t in b) / whole if whole else 0.0


def test_scores(spark):
    names = ["acme corp", "acme acme acme", "acme", "zeta corp", "unknown tokens here", "", "the acme corp"]
    w = {"acme": 0.5, "corp": 0.1, "zeta": 0.7}
    weights = spark.createDataFrame(list(w.items()), "word string, weight double")
    d = spark.createDataFrame(list(enumerate(names)), "id int, name string")
    tw = fuzzy.weighted_tokens(d, weights, T.words(F.col("name")), "word")
    a, b = tw.select(F.col("id").alias("a"), F.col("tw").alias("x")), tw.select(F.col("id").alias("b"), F.col("tw").alias("y"))
    got = {(r.a, r.b): r.s for r in a.crossJoin(b).select("a", "b", fuzzy.overlap(F.col("x"), F.col("y")).alias("s")).collect()}
    for (i, j), s in got.items():
        assert s == pytest.approx(overlap(names[i].split(), names[j].split(), w)), (names[i], names[j])
    assert got[1, 2] == pytest.approx(1.5) and got[2, 1] < 1  # occurrences count, so it isn't symmetric


def test_fuzzy_matches(spark):
    left = spark.createDataFrame([(1, "Acme Widget Corp"), (2, "The Corp")], "id int, name string")
    right = spark.createDataFrame([(10, "ACME WIDGET CORP"), (11, "acme widgets corp"), (12, "acme widget corp intl"), (13, "the corp")], "id int, name string")
    both = left.unionByName(right)
    ww, bw = relational.token_counts(both, T.words(F.col("name")), "word"), relational.token_counts(both, T.bigrams(F.col("name")), "bigram")
    stop = spark.createDataFrame([("corp",), ("the",)], "word string")
    got = {(r.a_id, r.b_id, r.match_type): r.score for r in fuzzy.fuzzy_matches(left, right, ww, bw, stop).collect()}
    assert got[1, 10, "term"] == got[1, 10, "bigram"] == 100 and (1, 12, "term") not in got  # intl is rare and weighs much
    assert got[2, 13, "term"] == 100  # all its words are stop terms, so all right names are candidates


def test_frequent_tokens_make_no_pairs(spark):
    """A token that very many names share is joined for none of those that have a rarer one."""
    left = spark.createDataFrame([(i, f"holding name{i}") for i in range(300)], "id int, name string")
    both = left.unionByName(left)
    weights = relational.token_counts(both, T.words(F.col("name")), "word")
    tw = fuzzy.weighted_tokens(left, weights, T.words(F.col("name")), "word")
    pairs = fuzzy.scoring_pairs(tw.selectExpr("id a_id", "tw a_tw"), tw.selectExpr("id b_id", "tw b_tw"), 75.0)
    assert pairs.count() == 300


@pytest.mark.parametrize("least,substring", [(75.0, False), (40.0, False), (75.0, True), (40.0, True)])
def test_no_pair_is_lost(spark, least, substring):
    r = random.Random(int(least))
    frequent, rare = ["the", "corp", "first", "inc", "group"], ["acme", "acm", "delta", "xdeltax"]
    some = lambda n, ws: sorted({" ".join(r.choices(ws, k=r.randrange(1, 6))) for _ in range(n)})
    a_names, b_names = ["The Corp", "", "corp corp corp first", *some(40, frequent), *some(20, frequent + rare)], ["the corp", "", *some(80, frequent + rare)]
    left = spark.createDataFrame(list(enumerate(a_names)), "id int, name string")
    right = spark.createDataFrame(list(enumerate(b_names)), "id int, name string")
    both = left.unionByName(right)
    ww, bw = relational.token_counts(both, T.words(F.col("name")), "word"), relational.token_counts(both, T.bigrams(F.col("name")), "bigram")
    stop = spark.createDataFrame([(w,) for w in frequent], "word string")
    two = lambda ws: [f"{x} {y}" for x, y in zip(ws, ws[1:], strict=False)]
    want = {}
    for kind, table, of in (("term", ww, list), ("bigram", bw, two)):
        w = {x[0]: x.weight for x in table.collect()}
        for i, a in enumerate(a_names):
            a = a.lower().split()
            for j, b in enumerate(b_names):
                b = b.split()
                score = 100 if a == b else 100 * overlap(of(a), of(b), w)
                own = set(a) - set(frequent)
                if score > least and (not own or (any(x in " ".join(b) for x in own) if substring else own & set(b))):
                    want[i, j, kind] = score
    got = fuzzy.fuzzy_matches(left, right, ww, bw, stop, least, substring).collect()
    assert len(got) == len(want) and {(x.a_id, x.b_id, x.match_type): x.score for x in got} == pytest.approx(want)
    assert want[0, 0, "term"] == want[1, 1, "bigram"] == 100


def test_keyed_tables(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "x"), (3, "z"), (3, "c"), (None, "n")], "k int, v string")
    assert sorted(relational.insert_ignore(t, new, ["k"], "v").collect(), key=str) == sorted([(1, "a"), (2, "b"), (3, "c"), (None, "n")], key=str)
    target = spark.createDataFrame([(1, None), (2, "old"), (4, None)], "k int, v string")
    source = spark.createDataFrame([(1, "second", 2), (1, "first", 1), (2, "new", 1)], "k int, w string, o int")
    assert dict(map(tuple, relational.update_from(target, source, ["k"], "o", {"v": "w"}).collect())) == {1: "first", 2: "old", 4: None}
    assert dict(map(tuple, relational.update_from(target, source, ["k"], "o", {"v": "w"}, only_null=False).collect())) == {1: "first", 2: "new", 4: None}
    ids = relational.surrogate_ids(spark.range(1000).withColumn("k", F.col("id") * 7 % 1000).repartition(5), ["k"], "n", 100).collect()
    assert sorted(r.n for r in ids) == list(range(101, 1101)) and all(r.n == r.k + 101 for r in ids)


def filers(spark, rows):
    return spark.createDataFrame(rows, "filer_id long, filing_id long, cik long, match_name string, incorp_country_code string, incorp_subdiv_code string, year int, sec_21 boolean")


def test_resolution_keeps_identifiers(spark):
    f = filers(spark, [(1, 1, 100, "Acme Corp", "US", "DE", 2005, True), (2, 2, 100, "Acme Corp", "US", "DE", 2006, True), (3, 3, 200, "Beta Inc", "US", None, 2005, False), (4, 4, None, "Nobody", None, None, 2005, False)])
    registry = spark.createDataFrame([(7, "Acme Corp", 100, "US", "DE", "filers"), (8, "Known Sub", 0, "IE", "", "relationships")], resolve.REGISTRY)
    names = spark.createDataFrame([("Listed Ltd", 300), ("Listed Ltd", 299), ("Beta Twin", 200)], "match_name string, cik long")
    r = spark.createDataFrame(
        [(1, "KNOWN SUB", "IE", None, 2005), (2, "Beta Inc", "US", None, 2005), (3, "Listed Ltd", "GB", None, 2005), (4, "New Sub", "GB", None, 2005), (5, "new sub", "GB", None, 2006), (6, "New Sub", "IE", None, 2005), (7, "Beta Twin", "FR", None, 2005)],
        "relationship_id long, clean_company string, country_code string, subdiv_code string, year int",
    )

    def run(reg):
        fi, companies, reg = resolve.resolve_filers(f, reg)
        return resolve.resolve_relationships(r, fi, companies, reg, names)

    first = run(registry)
    cw = {x.relationship_id: x.cw_id for x in first.relationships.collect()}
    own = {x.cik: x.cw_id for x in first.companies.filter("source_type = 'filers'").collect()}
    assert own[100] == 7 and own[200] == 9 and cw[1] == 8 and cw[2] == 9 and cw[7] == 9
    assert cw[4] == cw[5] and len({cw[3], cw[4], cw[6]}) == 3 and min(cw[3], cw[4], cw[6]) > 9
    assert {x.relationship_id: x.cik for x in first.relationships.collect()}[3] == 299
    second = run(first.registry)  # a rebuild from the registry finds the same identifiers
    assert {x.relationship_id: x.cw_id for x in second.relationships.collect()} == cw
    assert first.companies.select("cw_id").distinct().count() == first.companies.count()


def test_suppression_codes(spark):
    f = filers(spark, [(1, 1, 100, "Same", "US", None, 2005, True), (2, 2, 200, "SAME", "US", None, 2005, False), (3, 3, 300, "Other", None, None, 2005, False), (4, 4, 250, "other", None, None, 2005, False)])
    registry = spark.createDataFrame([(7, "Same", 100, "US", "", "filers")], resolve.REGISTRY)
    got = {r.filer_id: r.code for r in resolve.suppressed_filers(f, registry).collect()}
    assert got == {2: 1, 4: 4}
    filings = spark.createDataFrame([(i, c) for i, c in ((1, 100), (2, 200), (3, 300), (4, 250))], "filing_id long, cik long")
    hidden = {r.filer_id: (r.bad_cik, r.cik) for r in resolve.hide_suppressed(f, registry, filings).collect()}
    assert hidden == {1: (0, 100), 2: (1, None), 3: (0, 300), 4: (4, None)}


def test_rows_without_a_key_are_dealt_to_tasks(spark):
    target = spark.range(4000).select("id", F.when(F.col("id") % 10 == 0, F.col("id")).alias("cik"), F.lit(None).cast("long").alias("cw_id"))
    source = spark.range(0, 4000, 20).select(F.col("id").alias("cik"), (F.col("id") + 1).alias("cw_id")).unionByName(spark.createDataFrame([(None, 7)], "cik long, cw_id long"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        made = relational.update_from(target, source, ["cik"], "cw_id", {"cw_id": "cw_id"}).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted((r.id, r.cw_id) for r in made) == [(i, i + 1 if i % 20 == 0 else None) for i in range(4000)]
    per = [sum(r.task == k for r in made) for k in {r.task for r in made}]
    assert max(per) < 2000


def test_only_counted_tables_are_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before, one = spark.conf.get(key), spark.range(10)
    with relational.counted_broadcasts(spark):
        assert "Broadcast" not in one.join(spark.range(5), "id")._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" in one.join(relational.small(spark.range(5)), "id")._jdf.queryExecution().executedPlan().toString()
    assert spark.conf.get(key) == before
