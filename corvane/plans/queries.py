"""Queries over the driver's tables, one for each operator or group of operators, beside their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvane.functions import text as T
from corvane.operators import fuzzy, graph, locate, relational
from corvane.plans.registry import Tables, query
from corvane.plans.years import YearlyGraph
from corvane.shared import fresh_path, spread, written
from corvane.sources import exhibits, filings

SUFFIXES = (
    " Corporation", " Company", " L.L.C.", " /DE/", " Incorporated", ", Inc.", " Limited", " Limited Partnership", " and Sons, Ltd.", " (the 51% owned)",
    " [old]", "--Senior", " L.P. Holding", " <b>", ' "X" S.A.', " /NY/ /ADV",
)
PREFIXES = ("", "The ", 'LLC "', "A ", "An ", "O'")


def _pick(options, key: str) -> Column:
    return F.element_at(F.array(*[F.lit(o) for o in options]), (F.col(key) % len(options) + 1).cast("int"))


def _variant(d: DataFrame) -> DataFrame:
    name = F.concat(_pick(PREFIXES, "p_partkey"), "p_name", F.when(F.col("p_partkey") % 6 == 2, F.lit('"')).otherwise(F.lit("")), _pick(SUFFIXES, "p_partkey"))
    return d.select("p_partkey", name.alias("name"))


def _duck_list(options) -> str:
    return "[" + ", ".join("'" + o.replace("'", "''") + "'" for o in options) + "]"


_VARIANT_SQL = f"""SELECT p_partkey, {_duck_list(PREFIXES)}[(p_partkey % {len(PREFIXES)} + 1)::INT] || p_name
  || CASE WHEN p_partkey % 6 = 2 THEN '"' ELSE '' END || {_duck_list(SUFFIXES)}[(p_partkey % {len(SUFFIXES)} + 1)::INT] AS name FROM part"""


# What the key of each variant must be, written down by hand: what stands before and after the part's name.
_KEY_PREFIXES = ("", "", "", "", "", "O")
_KEY_SUFFIXES = (
    " Corp", " Co", " LLC", "", " Inc", " Inc", " Ltd", " Limited Partnership", " & Sons Ltd", "", "", " Sr", " L.P. Holding", "", " X SA", "",
)


@query(f"""SELECT {_duck_list(_KEY_PREFIXES)}[(p_partkey % {len(PREFIXES)} + 1)::INT] || p_name || CASE WHEN p_partkey % 6 = 2 THEN ' LLC' ELSE '' END
  || {_duck_list(_KEY_SUFFIXES)}[(p_partkey % {len(SUFFIXES)} + 1)::INT] AS match_name, count(*) AS n, min(p_partkey) AS least FROM part GROUP BY 1""")
def name_normalize(spark: SparkSession, t: Tables) -> DataFrame:
    named = _variant(t.part).withColumn("match_name", T.match_key(F.col("name")))
    return named.groupBy("match_name").agg(F.count("*").alias("n"), F.min("p_partkey").alias("least"))


# (before, after, what is left before, what is left after) a name, written down by hand.
_JUNK = (
    ("", " &nbsp;", "", ""), ("", " (wholly owned)", "", ""), ("", ", a wholly-owned subsidiary of X", "", ","), ("", " 51%", "", ""), ("", " - ", "", ""),
    ("", " (inactive)", "", ""), ("", " holds interest in Y", "", ""), ("", "  (LLC)", "", ""), ("", "..", "", "/"), ("", " dba Other", "", ""),
    ("State of ", "", "", ""), ("Limited State of ", "", "State of ", ""), ("• ", " (f/k/a X (Y) Z)", "", ""), ("the Republic of ", "", "the Republic of ", ""),
    ("Republic of ", ", U.S.A.", "", ""), ("U.S.-", " (5%-NV)", "", ""), ("** ", " — X", "", " - X"), ("a|b ", " a subsidiary of X", "ab ", " a"), ("filed in ", " L.L.C.", "", " L.L.C."),
    ("List of Subsidiaries", " and its subsidiaries:", "", ""), ("51.5% ", "\\ ", "", ""),
)


def _of_junk(k: int) -> str:
    return f"{_duck_list([j[k] for j in _JUNK])}[(p_partkey % {len(_JUNK)} + 1)::INT]"


@query(f"SELECT {_of_junk(2)} || p_name || {_of_junk(3)} AS cleaned, count(*) AS n FROM part GROUP BY 1")
def strip_junk(spark: SparkSession, t: Tables) -> DataFrame:
    text = F.concat(_pick([j[0] for j in _JUNK], "p_partkey"), "p_name", _pick([j[1] for j in _JUNK], "p_partkey"))
    return t.part.select(T.strip_junk(text).alias("cleaned")).groupBy("cleaned").agg(F.count("*").alias("n"))


_WORDS_SQL = "list_filter(string_split_regex(lower({0}), '[ /]'), lambda w: w <> '')"


@query(f"""WITH w AS (SELECT unnest({_WORDS_SQL.format("text")}) AS word FROM documents)
SELECT word, count(*) AS count, round(1 / (ln(count(*)) + 1), 9) AS weight FROM w GROUP BY word""")
def word_freq(spark: SparkSession, t: Tables) -> DataFrame:
    return relational.token_counts(t.documents, T.words(F.col("text")), "word").withColumn("weight", F.round("weight", 9))


@query(f"""WITH p AS (SELECT {_WORDS_SQL.format("regexp_replace(text, '[.,]', '', 'g')")} AS w FROM documents),
b AS (SELECT unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS bigram FROM p)
SELECT bigram, count(*) AS count, round(1 / (ln(count(*)) + 1), 9) AS weight FROM b GROUP BY bigram""")
def bigram_freq(spark: SparkSession, t: Tables) -> DataFrame:
    return relational.token_counts(t.documents, T.bigrams(F.col("text")), "bigram").withColumn("weight", F.round("weight", 9))


@query(f"""WITH w AS (SELECT unnest({_WORDS_SQL.format("text")}) AS word FROM documents), c AS (SELECT word, count(*) AS n FROM w GROUP BY word)
SELECT word FROM c ORDER BY n DESC, word LIMIT 75""")
def stop_terms(spark: SparkSession, t: Tables) -> DataFrame:
    return relational.stop_terms(relational.token_counts(t.documents, T.words(F.col("text")), "word"))


_LEFT_SQL = "SELECT DISTINCT p_name || ' ' || lower(p_type) AS name FROM part"
_RIGHT_SQL = "SELECT DISTINCT p_name || ' ' || lower(p_type) || ' ' || lower(p_brand) AS name FROM part"
_FUZZY_SQL = """WITH l AS (SELECT row_number() OVER (ORDER BY name) AS id, name FROM ({left})), r AS (SELECT row_number() OVER (ORDER BY name) AS id, name FROM ({right})),
lt AS (SELECT id, name, {tok} AS tok, {words} AS wrd FROM l), rt AS (SELECT id, name, {tok} AS tok, {words} AS wrd FROM r),
every AS (SELECT unnest(tok) AS tk FROM lt UNION ALL SELECT unnest(tok) FROM rt), wt AS (SELECT tk, 1 / (ln(count(*)) + 1) AS w FROM every GROUP BY tk),
wc AS (SELECT wd, count(*) AS n FROM (SELECT unnest(wrd) AS wd FROM lt UNION ALL SELECT unnest(wrd) FROM rt) GROUP BY wd),
stop AS (SELECT wd FROM wc ORDER BY n DESC, wd LIMIT 8), stops AS (SELECT list(wd) AS s FROM stop),
pairs AS (SELECT DISTINCT a.id AS a_id, b.id AS b_id FROM (SELECT id, unnest(wrd) AS wd FROM lt) a JOIN (SELECT id, unnest(wrd) AS wd FROM rt) b USING (wd) WHERE wd NOT IN (SELECT wd FROM stop)
  UNION SELECT lt.id, rt.id FROM lt, rt, stops WHERE len(list_filter(lt.wrd, lambda x: NOT list_contains(s, x))) = 0),
lw AS (SELECT id, tk, w FROM (SELECT id, unnest(tok) AS tk FROM lt) JOIN wt USING (tk)), rw AS (SELECT id, tk, w FROM (SELECT id, unnest(tok) AS tk FROM rt) JOIN wt USING (tk)),
ls AS (SELECT id, sum(w) AS s FROM lw GROUP BY id), rs AS (SELECT id, sum(w) AS s FROM rw GROUP BY id),
hit AS (SELECT p.a_id, p.b_id, sum(lw.w) AS s FROM pairs p JOIN lw ON lw.id = p.a_id WHERE EXISTS (SELECT 1 FROM rw WHERE rw.id = p.b_id AND rw.tk = lw.tk) GROUP BY ALL)
SELECT p.a_id, p.b_id, round(100 * 2 * coalesce(hit.s, 0) / (ls.s + rs.s), 6) AS score
FROM pairs p JOIN ls ON ls.id = p.a_id JOIN rs ON rs.id = p.b_id LEFT JOIN hit ON hit.a_id = p.a_id AND hit.b_id = p.b_id
WHERE 100 * 2 * coalesce(hit.s, 0) / (ls.s + rs.s) > 75"""
_BIGRAMS_SQL = f"list_transform(range(1, len({_WORDS_SQL.format('name')})), lambda i: ({_WORDS_SQL.format('name')})[i] || ' ' || ({_WORDS_SQL.format('name')})[i + 1])"


def _numbered(d: DataFrame) -> DataFrame:
    return relational.surrogate_ids(d.distinct(), ["name"], "id")


def _scores(t: Tables, kind: str, substring: bool = False) -> DataFrame:
    left = _numbered(t.part.select(F.concat_ws(" ", "p_name", F.lower("p_type")).alias("name")))
    first = F.concat(F.lit("x"), "p_name") if substring else F.col("p_name")
    right = _numbered(t.part.select(F.concat_ws(" ", first, F.lower("p_type"), F.lower("p_brand")).alias("name")))
    both = left.unionByName(right)
    word_weights = relational.token_counts(both, T.words(F.col("name")), "word")
    bigram_weights = relational.token_counts(both, T.bigrams(F.col("name")), "bigram")
    stop = relational.stop_terms(word_weights, n=8)
    found = fuzzy.fuzzy_matches(left, right, word_weights, bigram_weights, stop, substring=substring, kinds=(kind,))
    return found.select("a_id", "b_id", F.round("score", 6).alias("score"))


@query(_FUZZY_SQL.format(left=_LEFT_SQL, right=_RIGHT_SQL, tok=_WORDS_SQL.format("name"), words=_WORDS_SQL.format("name")))
def term_score(spark: SparkSession, t: Tables) -> DataFrame:
    return _scores(t, "term")


@query(_FUZZY_SQL.format(left=_LEFT_SQL, right=_RIGHT_SQL, tok=_BIGRAMS_SQL, words=_WORDS_SQL.format("name")))
def bigram_score(spark: SparkSession, t: Tables) -> DataFrame:
    return _scores(t, "bigram")


_ANYWHERE = ("(SELECT id, unnest(wrd) AS wd FROM lt) a JOIN (SELECT id, unnest(wrd) AS wd FROM rt) b USING (wd) WHERE wd NOT IN (SELECT wd FROM stop)", """(SELECT id, unnest(wrd) AS wd FROM lt) a
  JOIN (SELECT wd, rt.id FROM (SELECT DISTINCT unnest(wrd) AS wd FROM lt) JOIN rt ON contains(rt.name, wd) WHERE wd NOT IN (SELECT wd FROM stop)) b USING (wd)""")


@query(_FUZZY_SQL.replace(*_ANYWHERE).format(left=_LEFT_SQL, right=_RIGHT_SQL.replace("p_name ||", "'x' || p_name ||"), tok=_WORDS_SQL.format("name"), words=_WORDS_SQL.format("name")))
def substring_score(spark: SparkSession, t: Tables) -> DataFrame:
    """Candidates that hold a word of the left name anywhere, be it inside another word, as the first one here."""
    return _scores(t, "term", substring=True)


@query("""SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN 25.0 WHEN p_brand <> 'Brand#' || (p_size % 25) THEN 0.0
  ELSE 100 * (0.5 + CASE WHEN p_type = 'ECONOMY' THEN 0.25 ELSE 0 END) END::DOUBLE AS score FROM part""")
def location_score(spark: SparkSession, t: Tables) -> DataFrame:
    other = F.concat(F.lit("Brand#"), F.col("p_size") % 25)
    unknown = F.when(F.col("p_size") % 5 != 0, F.col("p_brand"))
    return t.part.select("p_partkey", fuzzy.location_score(unknown, F.col("p_type"), other, F.lit("ECONOMY"), F.lit(0.5), F.lit(0.25)).alias("score"))


@query("""SELECT a.c_custkey AS keep_key, count(*) AS n, min(b.c_custkey) AS least FROM customer a JOIN customer b
ON a.c_mktsegment = b.c_mktsegment AND a.c_nationkey = b.c_nationkey AND nullif(a.c_custkey % 7, 0) IS NOT DISTINCT FROM nullif(b.c_custkey % 7, 0) AND a.c_custkey > b.c_custkey
GROUP BY 1""")
def null_safe_self_join(spark: SparkSession, t: Tables) -> DataFrame:
    """How many rows of the same group have a smaller key, and which is the smallest: the join's answer without its pairs."""
    c = t.customer.select("c_custkey", "c_mktsegment", "c_nationkey", F.nullif(F.col("c_custkey") % 7, F.lit(0)).alias("k"))
    same = Window.partitionBy("c_mktsegment", "c_nationkey", "k").orderBy("c_custkey")
    ranked = c.select(F.col("c_custkey").alias("keep_key"), (F.row_number().over(same) - 1).cast("long").alias("n"), F.first("c_custkey").over(same).alias("least"))
    return ranked.filter("n > 0")


@query("""SELECT o_custkey, year(o_orderdate) AS year, max(o_orderkey) AS o_orderkey, arg_max(o_totalprice, o_orderkey) AS o_totalprice FROM orders GROUP BY 1, 2""")
def latest_per_group(spark: SparkSession, t: Tables) -> DataFrame:
    o = t.orders.select("o_custkey", F.year("o_orderdate").alias("year"), "o_orderkey", "o_totalprice")
    return relational.latest(o, ["o_custkey", "year"], ["o_orderkey"])


@query("""SELECT o_custkey, min(o_orderkey) AS o_orderkey, arg_min(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders GROUP BY 1""")
def first_of_group(spark: SparkSession, t: Tables) -> DataFrame:
    return relational.first_of_group(t.orders.select("o_custkey", "o_orderkey", "o_orderstatus"), ["o_custkey"], "o_orderkey")


@query("""SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND year(o_orderdate) = 1997)
AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""")
def anti_join_new_rows(spark: SparkSession, t: Tables) -> DataFrame:
    o = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderstatus", "o_orderpriority", F.year("o_orderdate").alias("y"))
    return relational.unseen(t.customer.select("c_custkey"), o.filter("o_orderstatus = 'F' and y = 1997"), o.filter("o_orderpriority = '1-URGENT'"), keys=["c_custkey"])


@query("""WITH old AS (SELECT o_custkey, o_orderpriority, min(o_orderkey) AS o_orderkey FROM orders WHERE o_orderkey % 3 = 0 GROUP BY 1, 2),
new AS (SELECT o_custkey, o_orderpriority, min(o_orderkey) AS o_orderkey FROM orders WHERE o_orderkey % 3 <> 0 GROUP BY 1, 2)
SELECT * FROM old UNION ALL SELECT * FROM new WHERE NOT EXISTS (SELECT 1 FROM old WHERE old.o_custkey = new.o_custkey AND old.o_orderpriority = new.o_orderpriority)""")
def insert_ignore(spark: SparkSession, t: Tables) -> DataFrame:
    o = t.orders.select("o_custkey", "o_orderpriority", "o_orderkey")
    keys = ["o_custkey", "o_orderpriority"]
    old = o.filter("o_orderkey % 3 = 0").groupBy(*keys).agg(F.min("o_orderkey").alias("o_orderkey"))
    return relational.insert_ignore(old, o.filter("o_orderkey % 3 <> 0"), keys, "o_orderkey")


@query("""WITH s AS (SELECT s_nationkey, min(s_suppkey) AS k FROM supplier GROUP BY 1)
SELECT c_custkey, c_nationkey, CASE WHEN c_custkey % 4 = 0 THEN c_custkey ELSE s.k END AS ref FROM customer LEFT JOIN s ON c_nationkey = s_nationkey""")
def update_from_join(spark: SparkSession, t: Tables) -> DataFrame:
    target = t.customer.select("c_custkey", "c_nationkey", F.when(F.col("c_custkey") % 4 == 0, F.col("c_custkey")).alias("ref"))
    source = t.supplier.select(F.col("s_nationkey").alias("c_nationkey"), "s_suppkey")
    return relational.update_from(target, source, ["c_nationkey"], "s_suppkey", {"ref": "s_suppkey"})


@query("""SELECT row_number() OVER (ORDER BY c_mktsegment, c_name) + (SELECT max(s_suppkey) FROM supplier) AS new_id, c_custkey FROM customer""")
def surrogate_ids(spark: SparkSession, t: Tables) -> DataFrame:
    start = t.supplier.agg(F.max("s_suppkey")).first()[0]
    return relational.surrogate_ids(t.customer.select("c_custkey", "c_mktsegment", "c_name"), ["c_mktsegment", "c_name"], "new_id", start).select("new_id", "c_custkey")


def _forest(t: Tables) -> tuple[DataFrame, DataFrame]:
    """info (cw_id, year) of customers by order year, and a forest child -> child div 3 in it, a few of whose edges are doubled."""
    info = t.orders.select(F.col("o_custkey").alias("cw_id"), F.year("o_orderdate").alias("year")).distinct()
    child = info.filter("cw_id > 0")
    edges = child.select(F.expr("cw_id div 3").alias("source"), F.col("cw_id").alias("target"), "year")
    return info, edges.unionByName(child.filter("cw_id % 10 = 9").select(F.expr("cw_id div 2").alias("source"), F.col("cw_id").alias("target"), "year")).distinct()


_FOREST_SQL = """info AS (SELECT DISTINCT o_custkey AS cw_id, year(o_orderdate) AS year FROM orders),
edges AS (SELECT cw_id // 3 AS source, cw_id AS target, year FROM info WHERE cw_id > 0 UNION SELECT cw_id // 2, cw_id, year FROM info WHERE cw_id % 10 = 9)"""


@query(f"""WITH RECURSIVE {_FOREST_SQL}, up AS (SELECT target, year, min(source) AS parent FROM edges GROUP BY 1, 2),
walk AS (SELECT cw_id, year, cw_id AS top, 0 AS d FROM info UNION ALL SELECT w.cw_id, w.year, u.parent, d + 1 FROM walk w JOIN up u ON u.target = w.top AND u.year = w.year)
SELECT cw_id, year, arg_max(top, d) AS top_parent_id FROM walk GROUP BY 1, 2""")
def top_parent(spark: SparkSession, t: Tables) -> DataFrame:
    return graph.top_parents(*_forest(t))


@query(f"""WITH RECURSIVE {_FOREST_SQL}, up AS (SELECT target, year, min(source) AS parent FROM edges GROUP BY 1, 2),
walk AS (SELECT cw_id, year, cw_id AS top, 0 AS d FROM info UNION ALL SELECT w.cw_id, w.year, u.parent, d + 1 FROM walk w JOIN up u ON u.target = w.top AND u.year = w.year)
SELECT w.cw_id, w.year, arg_max(top, d) AS top_parent_id, (SELECT count(DISTINCT target) FROM edges e WHERE e.source = w.cw_id AND e.year = w.year) AS num_children,
(SELECT count(DISTINCT source) FROM edges e WHERE e.target = w.cw_id AND e.year = w.year) AS num_parents FROM walk w GROUP BY 1, 2""")
def year_rebuild(spark: SparkSession, t: Tables) -> DataFrame:
    """The yearly graph after the last year, first built from half of its rows, was rebuilt alone."""
    # written, since each rebuild reads them several times
    info, edges = (written(d, "forest") for d in _forest(t))
    relations = edges.select(F.col("target").alias("cw_id"), F.col("source").alias("parent_cw_id"), "year")
    years = [r.year for r in info.select("year").distinct().orderBy("year").collect()]
    half = (F.col("year") != years[-1]) | (F.col("cw_id") % 2 == 0)
    graph_of_years = YearlyGraph(spark, fresh_path(spark, "yearly"))
    graph_of_years.rebuild(relations.filter(half), info.filter(half), years)
    graph_of_years.rebuild(relations, info, years[-1:])
    return graph_of_years.table("company_years")


_MUTUAL_SQL = """info AS (SELECT DISTINCT o_custkey AS cw_id, year(o_orderdate) AS year,
  CASE WHEN o_custkey % 5 = 0 THEN o_custkey + 1 WHEN o_custkey % 5 = 1 THEN o_custkey - 1 ELSE o_custkey - o_custkey % 5 END AS top_parent_id FROM orders)"""


def _mutual(t: Tables) -> DataFrame:
    k = F.col("o_custkey")
    top = F.when(k % 5 == 0, k + 1).when(k % 5 == 1, k - 1).otherwise(k - k % 5)
    return t.orders.select(k.alias("cw_id"), F.year("o_orderdate").alias("year"), top.alias("top_parent_id")).distinct()


@query(f"""WITH {_MUTUAL_SQL}, m AS (SELECT DISTINCT a.cw_id AS t, a.year, greatest(a.cw_id, b.cw_id) AS g FROM info a JOIN info b
  ON a.top_parent_id = b.cw_id AND b.top_parent_id = a.cw_id AND a.year = b.year AND a.cw_id <> b.cw_id)
SELECT i.cw_id, i.year, coalesce(m.g, i.top_parent_id) AS top_parent_id FROM info i LEFT JOIN m ON m.t = i.top_parent_id AND m.year = i.year""")
def mutual_cycles(spark: SparkSession, t: Tables) -> DataFrame:
    return graph.merge_mutual(_mutual(t))


@query(f"""WITH {_FOREST_SQL} SELECT source, target, year FROM edges e
WHERE NOT EXISTS (SELECT 1 FROM info i WHERE i.year = e.year AND i.cw_id // 7 = e.target)""")
def cut_top_edges(spark: SparkSession, t: Tables) -> DataFrame:
    info, edges = _forest(t)
    return graph.cut_top_edges(edges, info.withColumn("top_parent_id", F.expr("cw_id div 7")))


@query(f"""WITH {_FOREST_SQL} SELECT i.cw_id, i.year, coalesce(c.n, 0) AS num_children, coalesce(p.n, 0) AS num_parents FROM info i
LEFT JOIN (SELECT source, year, count(DISTINCT target) AS n FROM edges GROUP BY 1, 2) c ON c.source = i.cw_id AND c.year = i.year
LEFT JOIN (SELECT target, year, count(DISTINCT source) AS n FROM edges GROUP BY 1, 2) p ON p.target = i.cw_id AND p.year = i.year""")
def degree_counts(spark: SparkSession, t: Tables) -> DataFrame:
    return graph.degrees(*_forest(t))


@query(f"""WITH {_FOREST_SQL} SELECT i.cw_id, i.year FROM info i WHERE EXISTS (SELECT 1 FROM edges e WHERE e.source = i.cw_id AND e.year = i.year)
AND NOT EXISTS (SELECT 1 FROM edges e WHERE e.target = i.cw_id AND e.target % 4 <> 1)""")
def semi_anti_top_level(spark: SparkSession, t: Tables) -> DataFrame:
    info, edges = _forest(t)
    with_children = info.join(edges.select(F.col("source").alias("cw_id"), "year"), ["cw_id", "year"], "left_semi")
    return with_children.join(edges.filter("target % 4 <> 1").select(F.col("target").alias("cw_id")), "cw_id", "left_anti")


_INDENT_SQL = """r AS (SELECT user_id AS g, event_id AS id, (floor(value)::BIGINT % 4)::DOUBLE AS h, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events),
ok AS (SELECT g FROM r GROUP BY g HAVING min(h) <> max(h)), f AS (SELECT r.* FROM r JOIN ok USING (g)),
walk AS (
  SELECT g, 0::BIGINT AS n, [0.0::DOUBLE] AS hs, [0::BIGINT] AS ids, NULL::BIGINT AS id, 0::BIGINT AS parent, 0 AS level FROM ok
  UNION ALL
  SELECT w.g, f.n, list_concat(hs[:k], [f.h]), list_concat(w.ids[:k], [f.id]), f.id, CASE WHEN k > 0 THEN w.ids[k] ELSE 0 END, k
  FROM walk w JOIN f ON f.g = w.g AND f.n = w.n + 1,
  LATERAL (SELECT CASE WHEN f.h > w.hs[w.level + 1] THEN w.level + 1
                  ELSE list_max(list_filter(range(0, w.level + 1), lambda i: i = 0 OR w.hs[i + 1] <= f.h))::INT END AS k)
)"""


def _indented(t: Tables) -> DataFrame:
    return t.events.select(F.col("user_id").alias("g"), F.col("event_id").alias("id"), (F.floor("value") % 4).alias("h"))


@query(f"WITH RECURSIVE {_INDENT_SQL} SELECT g, id, parent FROM walk WHERE n > 0 AND parent <> 0 AND parent <> id")
def indent_parent(spark: SparkSession, t: Tables) -> DataFrame:
    return graph.indent_parents(_indented(t), "g", "id", "id", "h")


@query(f"WITH RECURSIVE {_INDENT_SQL} SELECT g, (n - 1)::INT AS pos, id, level::INT AS level FROM walk WHERE n > 0")
def indent_level(spark: SparkSession, t: Tables) -> DataFrame:
    return graph.indent_levels(_indented(t), "g", "id", "id", "h")


@query(f"""WITH {_FOREST_SQL} SELECT source, target, year FROM edges WHERE source <> target""")
def edge_dedupe(spark: SparkSession, t: Tables) -> DataFrame:
    _, edges = _forest(t)
    twice = edges.unionByName(edges.filter("target % 3 = 0"))
    return graph.distinct_edges(twice, "target", "source", "year")


@query("""WITH a AS (SELECT s_name AS name, s_nationkey AS n, s_suppkey AS id FROM supplier), c AS (SELECT c_custkey, 'Supplier#' || lpad((c_custkey % 150)::VARCHAR, 9, '0') AS name, c_nationkey AS n FROM customer),
by_both AS (SELECT name, n, min(id) AS id FROM a GROUP BY 1, 2), by_name AS (SELECT name, min(id) AS id FROM a GROUP BY 1), by_nation AS (SELECT n, min(id) AS id FROM a GROUP BY 1)
SELECT c_custkey, coalesce(x.id, y.id, z.id) AS id FROM c LEFT JOIN by_both x ON x.name = c.name AND x.n = c.n LEFT JOIN by_name y ON y.name = c.name AND c_custkey % 2 = 0 LEFT JOIN by_nation z ON z.n = c.n""")
def resolve_cascade(spark: SparkSession, t: Tables) -> DataFrame:
    s = t.supplier.select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("n"), F.col("s_suppkey").alias("sid"))
    name = F.concat(F.lit("Supplier#"), F.lpad((F.col("c_custkey") % 150).cast("string"), 9, "0"))
    c = t.customer.select("c_custkey", name.alias("name"), F.col("c_nationkey").alias("n"), F.lit(None).cast("long").alias("id"), F.when(F.col("c_custkey") % 2 == 0, name).alias("even_name"))
    c = relational.update_from(c, s, ["name", "n"], "sid", {"id": "sid"})
    c = relational.update_from(c, s.withColumnRenamed("name", "even_name"), ["even_name"], "sid", {"id": "sid"})
    return relational.update_from(c, s, ["n"], "sid", {"id": "sid"}).select("c_custkey", "id")


PLACES = ("NATION_{n}", "region_{r}, NATION_{n}", "NATION_{n}, AMERICA", "Delaware corporation", "alias {n}", "XX", "N{n}", "Somewhere, N{n}", "nation_{n}")


def _places(spark: SparkSession, t: Tables) -> locate.Places:
    """Regions are the countries (coded R0 ...), nations their subdivisions (N0 ...), and each nation has an alias."""
    countries = t.region.select(F.concat(F.lit("R"), "r_regionkey").alias("country_code"), F.col("r_name").alias("country_name"))
    subdivisions = t.nation.select(F.concat(F.lit("R"), "n_regionkey").alias("country_code"), F.concat(F.lit("N"), "n_nationkey").alias("subdivision_code"), F.col("n_name").alias("subdivision_name"))
    aliases = t.nation.select(F.concat(F.lit("R"), "n_regionkey").alias("country_code"), F.concat(F.lit("alias "), "n_nationkey").alias("country_name"), F.concat(F.lit("N"), "n_nationkey").alias("subdiv_code"))
    whole = t.region.select(F.concat(F.lit("R"), "r_regionkey").alias("country_code"), F.concat(F.lit("region_"), "r_regionkey").alias("country_name"), F.lit(None).cast("string").alias("subdiv_code"))
    return locate.Places(countries, aliases.unionByName(whole), subdivisions)


def _place(t: Tables) -> DataFrame:
    c = t.customer.join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey"))
    text = _pick(PLACES, "c_custkey")
    for k, v in (("{n}", "n_nationkey"), ("{r}", "n_regionkey")):
        text = F.replace(text, F.lit(k), F.col(v).cast("string"))
    return c.select("c_custkey", text.alias("place"))


_PLACES_SQL = f"""p AS (SELECT c_custkey, replace(replace({_duck_list(PLACES)}[(c_custkey % {len(PLACES)} + 1)::INT], '{{n}}', n_nationkey::VARCHAR), '{{r}}', n_regionkey::VARCHAR) AS place,
  n_nationkey AS n, n_regionkey AS r FROM customer JOIN nation ON c_nationkey = n_nationkey),
names AS (SELECT lower(r_name) AS k, 'R' || r_regionkey AS cc FROM region UNION SELECT 'region_' || r_regionkey, 'R' || r_regionkey FROM region),
subs AS (SELECT lower(n_name) AS k, 'R' || n_regionkey AS cc, 'N' || n_nationkey AS sc FROM nation UNION ALL SELECT 'alias ' || n_nationkey, 'R' || n_regionkey, 'N' || n_nationkey FROM nation),
codes AS (SELECT lower('N' || n_nationkey) AS k, 'R' || n_regionkey AS cc, 'N' || n_nationkey AS sc FROM nation),
s AS (SELECT *, lower(place) AS w, CASE WHEN place LIKE '%,%' THEN lower(trim(split_part(place, ',', 1))) END AS a, CASE WHEN place LIKE '%,%' THEN lower(trim(split_part(place, ',', 2))) END AS b FROM p)"""


@query(f"""WITH {_PLACES_SQL}
SELECT c_custkey,
  CASE WHEN w LIKE '%delaware%' THEN 'US' ELSE coalesce(c2.cc, c1.cc, sa.cc, sb.cc, ca.cc, cb.cc, cw.cc, sw.cc, kw.cc) END AS country_code,
  CASE WHEN w LIKE '%delaware%' THEN 'DE' WHEN c2.cc IS NOT NULL THEN s2.sc WHEN c1.cc IS NOT NULL THEN s1.sc WHEN coalesce(sa.sc, sb.sc, ca.sc, cb.sc) IS NOT NULL THEN coalesce(sa.sc, sb.sc, ca.sc, cb.sc)
       WHEN cw.cc IS NOT NULL THEN NULL ELSE coalesce(sw.sc, kw.sc) END AS subdiv_code
FROM s LEFT JOIN names c2 ON c2.k = b LEFT JOIN names c1 ON c1.k = a LEFT JOIN subs s2 ON s2.cc = c2.cc AND s2.k = a LEFT JOIN subs s1 ON s1.cc = c1.cc AND s1.k = b
LEFT JOIN subs sa ON sa.k = a LEFT JOIN subs sb ON sb.k = b LEFT JOIN codes ca ON ca.k = a LEFT JOIN codes cb ON cb.k = b
LEFT JOIN names cw ON cw.k = w LEFT JOIN subs sw ON sw.k = w LEFT JOIN codes kw ON kw.k = w""")
def location_cascade(spark: SparkSession, t: Tables) -> DataFrame:
    found = locate.resolve_places(_place(t), "place", _places(spark, t), clean=False)
    return found.select("c_custkey", "country_code", "subdiv_code")


@query(f"""WITH {_PLACES_SQL}
SELECT c_custkey, CASE WHEN w = 'xx' THEN 'ZZ' WHEN w LIKE '%delaware%' THEN 'US' ELSE coalesce(c.cc, al.cc, l.cc) END AS country_code,
  CASE WHEN w LIKE '%delaware%' THEN 'DE' WHEN w = 'xx' THEN '00' WHEN c.cc IS NOT NULL THEN NULL ELSE al.sc END AS subdiv_code
FROM s LEFT JOIN names c ON c.k = w LEFT JOIN subs al ON al.k = w AND al.k LIKE 'alias %' LEFT JOIN names l ON l.k = coalesce(b, w)""")
def location_batch_tags(spark: SparkSession, t: Tables) -> DataFrame:
    codes = spark.createDataFrame([("XX", "ZZ", "00")], "code string, country_code string, subdiv_code string")
    return locate.tag_places(_place(t), "place", codes, _places(spark, t)).select("c_custkey", "country_code", "subdiv_code")


@query("""WITH l AS (SELECT o_orderkey AS location_id, o_custkey AS cw_id, ['business', 'mailing', 'relation_loc', 'state_of_incorp'][(o_orderkey % 4 + 1)::INT] AS type,
  CASE WHEN o_orderkey % 3 = 0 THEN 'S' END AS sc, year(o_orderdate) AS lo, year(o_orderdate) + o_orderkey % 3 AS hi FROM orders), y AS (SELECT unnest(range(1996, 2001)) AS year)
SELECT cw_id, year::INT AS year, coalesce(max(CASE WHEN type = 'business' THEN location_id END), max(CASE WHEN type = 'mailing' THEN location_id END),
  max(CASE WHEN type = 'relation_loc' AND sc IS NOT NULL THEN location_id END), max(CASE WHEN type = 'relation_loc' THEN location_id END), max(CASE WHEN type = 'state_of_incorp' THEN location_id END)) AS location_id
FROM l JOIN y ON year BETWEEN lo AND hi GROUP BY 1, 2""")
def best_location(spark: SparkSession, t: Tables) -> DataFrame:
    o = t.orders
    year = F.year("o_orderdate")
    rows = o.select(
        F.col("o_orderkey").alias("location_id"), F.col("o_custkey").alias("cw_id"), _pick(("business", "mailing", "relation_loc", "state_of_incorp"), "o_orderkey").alias("type"),
        F.when(F.col("o_orderkey") % 3 == 0, "S").alias("subdiv_code"), year.alias("min_year"), (year + F.col("o_orderkey") % 3).alias("max_year"),
    )
    return locate.best_locations(rows, spark.range(1996, 2001).select(F.col("id").cast("int").alias("year")))


@query("""SELECT o_custkey AS cw_id, year(o_orderdate) AS year FROM orders WHERE o_orderstatus = 'F' UNION SELECT l_suppkey, year(l_shipdate) FROM lineitem WHERE l_returnflag = 'R'""")
def year_spine(spark: SparkSession, t: Tables) -> DataFrame:
    a = t.orders.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("cw_id"), F.year("o_orderdate").alias("year"))
    b = t.lineitem.filter("l_returnflag = 'R'").select(F.col("l_suppkey").alias("cw_id"), F.year("l_shipdate").alias("year"))
    return relational.year_spine(a, b)


@query("""WITH i AS (SELECT DISTINCT o_custkey AS cw_id, year(o_orderdate) AS year FROM orders)
SELECT cw_id, year, min(year) OVER w AS min_year, max(year) OVER w AS max_year, year = max(year) OVER w AS most_recent FROM i WINDOW w AS (PARTITION BY cw_id)""")
def min_max_year(spark: SparkSession, t: Tables) -> DataFrame:
    return relational.with_year_range(t.orders.select(F.col("o_custkey").alias("cw_id"), F.year("o_orderdate").alias("year")).distinct(), "cw_id", "year")


@query("""SELECT c_name AS name, 'customer' AS source FROM customer UNION SELECT s_name, 'supplier' FROM supplier UNION SELECT p_name, 'part' FROM part""")
def names_union(spark: SparkSession, t: Tables) -> DataFrame:
    tagged = lambda d, c, s: d.select(F.col(c).alias("name"), F.lit(s).alias("source"))
    return tagged(t.customer, "c_name", "customer").unionByName(tagged(t.supplier, "s_name", "supplier")).unionByName(tagged(t.part, "p_name", "part")).distinct()


@query("""SELECT year(o_orderdate) AS year, round(100.0 * count(*) FILTER (o_orderstatus = 'F') / nullif(count(*), 0), 9) AS percent_done,
  round(100.0 * count(DISTINCT o_custkey) FILTER (o_orderstatus = 'F') / nullif(count(*) - count(*) FILTER (o_orderpriority = '5-LOW'), 0), 9) AS percent_true FROM orders GROUP BY 1""")
def ratio_metrics(spark: SparkSession, t: Tables) -> DataFrame:
    done = F.col("o_orderstatus") == "F"
    per = t.orders.groupBy(F.year("o_orderdate").alias("year")).agg(
        F.count("*").alias("n"), F.count_if(done).alias("done"), F.count_distinct(F.when(done, F.col("o_custkey"))).alias("who"), F.count_if(F.col("o_orderpriority") == "5-LOW").alias("low")
    )
    r = lambda a, b: F.round(relational.ratio(a, b), 9)
    return per.select("year", r(F.col("done"), F.col("n")).alias("percent_done"), r(F.col("who"), F.col("n") - F.col("low")).alias("percent_true"))


@query("""SELECT o_orderstatus AS metric, count(*) FILTER (year(o_orderdate) = 1996) AS y1996, count(*) FILTER (year(o_orderdate) = 1997) AS y1997, count(*) FILTER (year(o_orderdate) = 1998) AS y1998
FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1998 GROUP BY 1""")
def metrics_pivot(spark: SparkSession, t: Tables) -> DataFrame:
    years = [1996, 1997, 1998]
    wide = t.orders.withColumn("year", F.year("o_orderdate")).filter(F.col("year").isin(years))
    wide = wide.groupBy(F.col("o_orderstatus").alias("metric")).pivot("year", years).agg(F.count(F.lit(1)))
    return wide.select("metric", *[F.coalesce(F.col(f"`{y}`"), F.lit(0)).alias(f"y{y}") for y in years])


@query("SELECT l_orderkey, min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem GROUP BY 1 HAVING min(l_quantity) <> max(l_quantity)")
def having_min_ne_max(spark: SparkSession, t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_orderkey").agg(F.min("l_quantity").alias("lo"), F.max("l_quantity").alias("hi")).filter("lo <> hi")


@query("""SELECT l_orderkey, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS flags FROM lineitem GROUP BY 1 HAVING string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) IN ('A', 'A,R')""")
def having_group_concat(spark: SparkSession, t: Tables) -> DataFrame:
    flags = F.array_join(F.array_sort(F.collect_set("l_returnflag")), ",")
    return t.lineitem.groupBy("l_orderkey").agg(flags.alias("flags")).filter(F.col("flags").isin("A", "A,R"))


@query("""WITH r AS (SELECT o_custkey, min(year(o_orderdate)) AS lo, max(year(o_orderdate)) - 1 AS hi FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT o.o_custkey, count(*) AS n FROM orders o JOIN r ON o.o_custkey = r.o_custkey AND year(o_orderdate) BETWEEN lo AND hi AND o_orderstatus <> 'F' GROUP BY 1""")
def range_join_years(spark: SparkSession, t: Tables) -> DataFrame:
    y = F.year("o_orderdate")
    r = t.orders.filter("o_orderstatus = 'F'").groupBy("o_custkey").agg(F.min(y).alias("lo"), (F.max(y) - 1).alias("hi"))
    joined = t.orders.filter("o_orderstatus <> 'F'").join(r, "o_custkey").filter(y.between(F.col("lo"), F.col("hi")))
    return joined.groupBy("o_custkey").agg(F.count("*").alias("n"))


@query("""SELECT o_orderpriority, count(*) AS n, count(DISTINCT o_custkey) AS who, min(year(o_orderdate)) AS lo, max(o_orderdate) AS hi FROM orders
WHERE regexp_matches(o_orderpriority, '^[1-3]-') AND o_totalprice BETWEEN 1000 AND 400000 AND o_orderpriority NOT LIKE '%HIGH' GROUP BY 1""")
def filtered_counts(spark: SparkSession, t: Tables) -> DataFrame:
    kept = t.orders.filter(F.col("o_orderpriority").rlike("^[1-3]-") & F.col("o_totalprice").between(1000, 400000) & ~F.col("o_orderpriority").like("%HIGH"))
    return kept.groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.count_distinct("o_custkey").alias("who"), F.min(F.year("o_orderdate")).alias("lo"), F.max("o_orderdate").alias("hi"))


@query("""SELECT n_name, r_name, count(*) AS customers, sum(c_acctbal)::DECIMAL(20, 2)::VARCHAR AS balance FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""")
def snowflake_join(spark: SparkSession, t: Tables) -> DataFrame:
    dims = F.broadcast(t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")))  # 25 rows
    per = t.customer.join(dims, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name", "r_name")
    return per.agg(F.count("*").alias("customers"), F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("decimal(20,2)").cast("string").alias("balance"))


@query("""SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 100""")
def api_page(spark: SparkSession, t: Tables) -> DataFrame:
    from corvane.plans.api import page

    return page(t.orders.select("o_orderkey", "o_custkey", "o_totalprice").withColumn("k", -F.col("o_totalprice")), "k", "o_orderkey", limit=50, offset=100).drop("k")


@query("""SELECT n // 50 + 1 AS page, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS n FROM orders) WHERE n < 150""")
def api_pages(spark: SparkSession, t: Tables) -> DataFrame:
    """Three consecutive pages, each from the last key of the one before."""
    from corvane.plans.api import KeyedPages

    rows = t.orders.select((-F.col("o_totalprice")).alias("k"), "o_orderkey", "o_totalprice")
    pages, after, out = KeyedPages.build(rows, ("k", "o_orderkey"), fresh_path(spark, "pages"), part_rows=1000), None, None
    for n in (1, 2, 3):
        found = pages.after(after, 50)
        last = found.orderBy(F.desc("k"), F.desc("o_orderkey")).first()
        after = (last.k, last.o_orderkey)
        found = found.select(F.lit(n).alias("page"), "o_orderkey", "o_totalprice")
        out = found if out is None else out.unionByName(found)
    return out.withColumn("page", F.col("page").cast("long"))


@query("""SELECT c_custkey, c_name FROM customer WHERE lower(c_name) LIKE '%#00000001%' AND c_mktsegment = 'BUILDING' AND c_nationkey >= 3""")
def api_search(spark: SparkSession, t: Tables) -> DataFrame:
    from corvane.plans.api import conditions, given, matches_text

    found = conditions(
        name=matches_text("c_name", "#00000001", substring=True), segment=given("BUILDING", lambda v: F.col("c_mktsegment") == v),
        low=given(3, lambda v: F.col("c_nationkey") >= v), high=given("", lambda v: F.col("c_nationkey") <= v),
    )
    return t.customer.filter(found).select("c_custkey", "c_name")


@query("""WITH i AS (SELECT DISTINCT o_custkey AS cw_id, year(o_orderdate) AS year FROM orders) SELECT cw_id, year FROM i WHERE cw_id = 7""")
def api_history(spark: SparkSession, t: Tables) -> DataFrame:
    from corvane.plans.api import Directory

    info, edges = _forest(t)
    return Directory(relational.with_year_range(info, "cw_id", "year"), edges).history(7).select("cw_id", "year")


@query(f"""WITH {_FOREST_SQL}, y AS (SELECT max(year) AS y FROM info WHERE cw_id = 4) SELECT target AS cw_id, edges.year FROM edges JOIN y ON edges.year = y.y JOIN info i ON i.cw_id = target AND i.year = edges.year WHERE source = 4""")
def api_children(spark: SparkSession, t: Tables) -> DataFrame:
    from corvane.plans.api import Directory

    info, edges = _forest(t)
    return Directory(relational.with_year_range(info, "cw_id", "year"), edges).children(4).select("cw_id", "year")


# (text, number of the first pattern that matches, company, place, patterns that match); {p} is a part's name, {w} its second word.
_SENTENCES = (
    ("{p} Holdings, a NATION corporation", 1, "{p} Holdings", "NATION", 1), ("{p} Ltd, is incorporated in NATION and more", 0, "{p} Ltd, ", "NATION", 2),
    ("{p} Trust organized under the laws of the NATION", 3, "{p} Trust", " the NATION", 1), ("{p} was formed in NATION", 3, "{p} was", "NATION", 1),
    ("{p} Services (NATION)", 4, "{p} Services", "NATION", 1), ("{p} Services (NATION) Two", 4, "{p} Services (NATION) Two", "NATION", 1),
    ("{p} jurisdiction of organization: NATION", 5, "{p} ", "NATION", 1), ("{p} - NATION", 6, "{p}", "NATION", 1), ("{p}    NATION", 7, "{p}", "NATION", 2),
    ("{p} NATION Ltd", 9, "{p} NATION Ltd", "{w} NATION", 1), ("NOTHING", None, None, None, 0), ("{p} NATION S.A.S?", 9, "{p} NATION S.A.S?", "{w} NATION", 1),
    ("{p}, organized and existing under the laws of NATION", 2, "{p}", "NATION", 1), ("{p}  x  NATION", 8, "{p}", "NATION", 1),
)


def _sentence(t: Tables) -> DataFrame:
    text = F.replace(_pick([x[0] for x in _SENTENCES], "p_partkey"), F.lit("{p}"), F.col("p_name"))
    return t.part.select("p_partkey", text.alias("text"))


def _single_sql() -> str:
    rows = ", ".join(f"({k}, {x[1]}, '{x[2]}', '{x[3]}', {x[4]})" for k, x in enumerate(_SENTENCES) if x[1] is not None)
    full = lambda c: f"replace(replace({c}, '{{p}}', p_name), '{{w}}', split_part(p_name, ' ', 2))"
    return (
        f"WITH x(k, sub, company, place, n) AS (VALUES {rows}) SELECT p_partkey, sub::INT AS sub, {full('company')} AS company, {full('place')} AS place, "
        f"n::BIGINT AS candidates FROM part JOIN x ON p_partkey % {len(_SENTENCES)} = k"
    )


@query(_single_sql())
def single_string_cascade(spark: SparkSession, t: Tables) -> DataFrame:
    # exploded from an array of one, or the filter would run all patterns a second time
    c = spread(_sentence(t), "p_partkey").select("p_partkey", F.explode(F.array(exhibits.single_candidates(F.col("text")))).alias("c")).filter(F.size("c") > 0)
    return c.select("p_partkey", F.col("c")[0]["sub"].alias("sub"), F.col("c")[0]["company"].alias("company"), F.col("c")[0]["place"].alias("place"), F.size("c").cast("long").alias("candidates"))


@query(r"""SELECT page_id, CASE WHEN html IS NULL OR trim(html) = '' OR regexp_matches(html, '(?i)<title>[^<]*(?:error|not found)') THEN 1 WHEN NOT contains(html, page_id::VARCHAR) THEN 2 ELSE 0 END::INT AS code FROM pages""")
def doc_validity_code(spark: SparkSession, t: Tables) -> DataFrame:
    return t.pages.select("page_id", filings.document_code(F.col("html"), F.col("page_id")).cast("int").alias("code"))


@query(r"""WITH l AS (SELECT doc_id, unnest(string_split(regexp_replace(text, ' \| ', '   ', 'g'), chr(10))) AS line FROM documents),
p AS (SELECT doc_id, list_filter(string_split_regex(trim(line), '\s\s\s+'), lambda x: x <> '') AS parts, line FROM l)
SELECT doc_id, count(*) AS lines, count(*) FILTER (len(parts) >= 2) AS pairs, count(*) FILTER (len(parts) >= 3) AS triples,
  max(CASE WHEN len(parts) >= 2 THEN parts[1] || '|' || parts[2] END) AS last_pair FROM p GROUP BY 1""")
def text_mode_split(spark: SparkSession, t: Tables) -> DataFrame:
    wide = F.replace("text", F.lit(" | "), F.lit("   "))
    lines = t.documents.select("doc_id", F.explode(F.split(wide, "\n")).alias("line"))
    units = exhibits.text_units(lines, "line").select("doc_id", F.filter("units", lambda u: u["rank"] == 0).alias("p"), F.filter("units", lambda u: u["rank"] == 1).alias("q"))
    pair = F.when(F.size("p") > 0, F.concat_ws("|", F.col("p")[0]["a"], F.col("p")[0]["b"]))
    return units.groupBy("doc_id").agg(F.count("*").alias("lines"), F.count_if(F.size("p") > 0).alias("pairs"), F.count_if(F.size("q") > 0).alias("triples"), F.max(pair).alias("last_pair"))


@query(r"""SELECT page_id, length(regexp_replace(html, '<[^>]+>', ' ', 'g')) AS n_text, len(regexp_extract_all(html, '(?i)<br ?/?>')) AS n_breaks, len(regexp_extract_all(html, '(?i)<a [^>]*href="([^"]*)"', 1)) AS n_links,
  md5(replace(replace(replace(replace(replace(replace(replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&')) AS text_md5 FROM pages""")
def html_text(spark: SparkSession, t: Tables) -> DataFrame:
    plain = T.strip_tags(F.col("html"))
    return t.pages.select(
        "page_id", F.length(plain).cast("long").alias("n_text"), F.regexp_count("html", F.lit("(?i)<br ?/?>")).cast("long").alias("n_breaks"),
        F.size(F.regexp_extract_all("html", F.lit('(?i)<a [^>]*href="([^"]*)"'), F.lit(1))).cast("long").alias("n_links"), F.md5(T.decode_entities(plain)).alias("text_md5"),
    )


@query(r"""WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, '(?i)<a [^>]*href="([^"]*)"', 1)) AS href FROM pages) SELECT href, count(*) AS n, count(DISTINCT page_id) AS pages FROM l GROUP BY 1""")
def html_links(spark: SparkSession, t: Tables) -> DataFrame:
    links = t.pages.select("page_id", F.explode(F.regexp_extract_all("html", F.lit('(?i)<a [^>]*href="([^"]*)"'), F.lit(1))).alias("href"))
    return links.groupBy("href").agg(F.count("*").alias("n"), F.count_distinct("page_id").alias("pages"))


@query()
def html_tree_units(spark: SparkSession, t: Tables) -> DataFrame:
    """Units of text that the tree strategies find in pages; trees aren't expressible in SQL."""
    units = exhibits.exhibit_units(t.pages.select(F.col("page_id").alias("filing_id"), F.col("html").alias("content")))
    return units.groupBy("filing_id", "method").agg(F.count("*").alias("units"), F.sum(F.length("a")).alias("characters"))


@query(r"""WITH s AS (SELECT page_id, '<SEC>' || chr(10) || '<DOCUMENT>' || chr(10) || '<TYPE>10-K' || chr(10) || '</DOCUMENT><DOCUMENT>' || chr(10) || '<TYPE>EX-21.' || (page_id % 3) || chr(10) || '<FILENAME>ex' || page_id || '.htm' || chr(10) || url || '</DOCUMENT>' AS c FROM pages WHERE page_id % 4 <> 0)
SELECT page_id, page_id % 4 <> 0 AS has_sec21, CASE WHEN page_id % 4 <> 0 THEN 'https://example.org/000' || page_id || '/ex' || page_id || '.htm' END AS sec_21_url FROM pages""")
def exhibit_urls(spark: SparkSession, t: Tables) -> DataFrame:
    nl = F.lit("\n")
    kind = F.when(F.col("page_id") % 4 == 0, F.lit("EX-10")).otherwise(F.concat(F.lit("EX-21."), (F.col("page_id") % 3).cast("string")))
    body = F.concat(F.lit("<SEC>\n<DOCUMENT>\n<TYPE>10-K\n</DOCUMENT><DOCUMENT>\n<TYPE>"), kind, nl, F.lit("<FILENAME>ex"), "page_id", F.lit(".htm"), nl, "url", F.lit("</DOCUMENT>"))
    rows = t.pages.select("page_id", F.concat(F.lit("0-00-"), "page_id", F.lit(".txt")).alias("filename"), body.alias("content"))
    return filings.with_exhibits(rows, "https://example.org/").select("page_id", "has_sec21", "sec_21_url")


@query("""SELECT o_orderkey AS cik, o_orderpriority AS company_name, CASE WHEN o_orderkey % 5 = 0 THEN '10-K/A' ELSE '8-K' END AS type, o_orderdate::DATE AS filing_date, 'data/' || o_orderkey || '.txt' AS filename
FROM orders WHERE o_orderkey % 7 <> 0 AND o_orderkey % 5 = 0""")
def index_scan(spark: SparkSession, t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    form = F.when(k % 5 == 0, "10-K/A").otherwise("8-K")
    line = F.when(k % 7 == 0, F.lit("CIK|Company Name|Form Type|Date Filed|Filename")).otherwise(
        F.concat_ws("|", k.cast("string"), "o_orderpriority", form, F.date_format("o_orderdate", "yyyy-MM-dd"), F.concat(F.lit("data/"), k, F.lit(".txt")))
    )
    return filings.index_rows(t.orders.select(line.alias("value"))).filter(filings.is_annual(F.col("type")))


@query("""SELECT max(o_orderdate)::DATE AS update_date FROM orders WHERE o_orderkey % 11 = 0""")
def index_freshness(spark: SparkSession, t: Tables) -> DataFrame:
    said = F.when(F.col("o_orderkey") % 11 == 0, F.concat(F.lit("Last Data Received:    "), F.date_format("o_orderdate", "MMMM d, yyyy"))).otherwise("other")
    return filings.freshness(t.orders.select(said.alias("value")))


@query("""SELECT c_name AS name, c_custkey AS cik FROM customer WHERE c_custkey % 3 <> 0""")
def name_list_scan(spark: SparkSession, t: Tables) -> DataFrame:
    line = F.when(F.col("c_custkey") % 3 == 0, F.col("c_name")).otherwise(F.concat("c_name", F.lit(":"), "c_custkey", F.lit(":")))
    return filings.name_rows(t.customer.select(line.alias("value"))).select("name", "cik")


@query("""SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users, max(day) AS last_day
FROM (SELECT DISTINCT user_id, event_type, date_trunc('day', ts)::TIMESTAMP AS day FROM events) GROUP BY 1""")
def incremental_ingest(spark: SparkSession, t: Tables) -> DataFrame:
    """Distinct (user, type, day) keys of the events, ingested as a stream in two runs of which the second finds nothing new."""
    from corvane.streaming.ingest import append_distinct, read_stream

    base = fresh_path(spark, "ingest")
    for _ in range(2):
        stream = read_stream(spark, f"{t._folder}/events.parquet", ["user_id", "event_type", "ts"])
        rows = stream.withColumn("day", F.date_trunc("day", "ts")).drop("ts")
        append_distinct(rows, f"{base}/table", f"{base}/checkpoint", ["user_id", "event_type", "day"])
    got = spark.read.parquet(f"{base}/table")
    return got.groupBy("event_type").agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"), F.max("day").alias("last_day"))


@query("""SELECT c_mktsegment, c_custkey FROM (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS n FROM customer) WHERE n <= 3""")
def top_n_per_group(spark: SparkSession, t: Tables) -> DataFrame:
    w = Window.partitionBy("c_mktsegment").orderBy(F.desc("c_acctbal"), "c_custkey")
    return t.customer.withColumn("n", F.row_number().over(w)).filter("n <= 3").select("c_mktsegment", "c_custkey")
