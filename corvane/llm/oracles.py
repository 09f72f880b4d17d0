"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from corvane.llm import imatch, licenses, secrets

EXACT_DEDUP = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""

MIXING = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         (('0x' || substr(md5('7:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
  FROM documents
), per AS (
  SELECT *, source_size * 2.0::DOUBLE AS cap,
         [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::INT] AS w
  FROM (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source)
), lines AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER c, 0.0::DOUBLE))
          / (sum(w) OVER () - coalesce(sum(w) OVER c, 0.0::DOUBLE)) AS line
  FROM per WINDOW c AS (ORDER BY cap / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, source_size, least(cap, greatest(0.0::DOUBLE, max(line) OVER () * w)) AS target FROM lines
), drawn AS (
  SELECT *, target - whole * source_size AS rest,
         (ratio - whole) * CASE WHEN size > target - whole * source_size THEN (target - whole * source_size) / size ELSE 1.0::DOUBLE END AS p
  FROM (
    SELECT s.doc_id, s.source, s.size, s.u, t.source_size, t.target,
           CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS ratio, floor(ratio) AS whole
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
), ranked AS (
  SELECT *, CASE WHEN p > 0 AND size > 0 THEN u * (1 - p) / ((1 - u) * p) END AS q FROM drawn
), summed AS (
  SELECT *, CASE WHEN q IS NOT NULL THEN
           sum(CASE WHEN q IS NOT NULL THEN size END) OVER (PARTITION BY source ORDER BY q NULLS LAST, doc_id ROWS UNBOUNDED PRECEDING) END AS upto
  FROM ranked
), gaps AS (
  SELECT *, coalesce(upto <= rest, false) AS first_pass,
         rest - coalesce(max(CASE WHEN upto <= rest THEN upto END) OVER (PARTITION BY source), 0) AS gap FROM summed
), again AS (
  SELECT *, q IS NOT NULL AND NOT first_pass AND size <= gap AS small,
         sum(CASE WHEN q IS NOT NULL AND NOT first_pass AND size <= gap THEN size END)
           OVER (PARTITION BY source ORDER BY q NULLS LAST, doc_id ROWS UNBOUNDED PRECEDING) AS upto2 FROM gaps
), chosen AS (
  SELECT *, first_pass OR (small AND upto2 <= gap) AS inside,
         gap - coalesce(max(CASE WHEN small AND upto2 <= gap THEN upto2 END) OVER (PARTITION BY source), 0) AS gap2 FROM again
), fills AS (
  SELECT source, min({'d': abs(size - gap2), 'q': q, 'doc_id': doc_id}) AS more
  FROM chosen WHERE q IS NOT NULL AND NOT inside AND size < 2 * gap2 GROUP BY source
)
SELECT g.doc_id, g.size, g.source_size, g.target,
       CAST(g.size * (whole + CASE WHEN q IS NOT NULL AND (inside OR (f.more.q = g.q AND f.more.doc_id = g.doc_id)) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM chosen g LEFT JOIN fills f ON g.source IS NOT DISTINCT FROM f.source
"""

EMBEDDING_DEDUP = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
), least AS (SELECT a, min(b) AS c FROM reach GROUP BY a), n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n.n, 0) AS n_links, coalesce(c, vec_id) AS component_id, vec_id = coalesce(c, vec_id) AS kept
FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN least ON least.a = vec_id
"""


def _listed(items) -> str:
    return "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in items) + "]"


def license_sql() -> str:
    """Phrases by comparing slices of words; templates by intersecting the words of every window with those of every template."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    cut = lambda x: f"list_filter(string_split_regex({x}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')"
    phrases = ", ".join(f"('{label}', {_listed(p.split())})" for label, p in licenses.PHRASES.items())
    words = lambda t: [w.decode() for w in licenses.words_of(t.lower().encode())]
    every = [(label, words(t)) for label, ts in licenses.TEMPLATES.items() for t in ts]
    needed = lambda label, ws: [p for p in licenses.DISTINGUISHING.get(label, ()) if f" {p} " in f" {' '.join(ws)} "]
    templates = ", ".join(f"('{label}', {_listed(sorted(set(ws)))}, {_listed(needed(label, ws))}::VARCHAR[])" for label, ws in every if len(ws) >= licenses.SHORT_WORDS)
    short = ", ".join(f"('{label}', {_listed(ws)})" for label, ws in every if len(ws) < licenses.SHORT_WORDS)
    size = licenses.BLOCK_WORDS
    return f"""
WITH d AS (SELECT doc_id, {lower} AS t FROM documents), w AS MATERIALIZED (SELECT *, ' ' || array_to_string(ws, ' ') || ' ' AS line FROM (SELECT doc_id, {cut("t")} AS ws, t FROM d)),
p(label, ps) AS (VALUES {phrases}), q(label, ts, ns) AS (VALUES {templates}), z(label, ps) AS (VALUES {short}),
base AS (SELECT doc_id, label, unnest(list_filter(range(0, len(ws)), lambda i: ws[i + 1:i + len(ps)] = ps)) AS place FROM w, p),
blocks AS (SELECT doc_id, list_distinct(ws[lo + 1:lo + {size}]) AS b, ' ' || array_to_string(ws[lo + 1:lo + {size}], ' ') || ' ' AS line FROM (SELECT doc_id, ws, unnest(range(0, greatest(1, len(ws) - {size // 2}), {size // 2})) AS lo FROM w)),
found AS (SELECT doc_id, label, max(len(list_intersect(b, ts)) / len(ts)) AS c FROM blocks, q WHERE len(list_intersect(b, ts)) >= ceil({licenses.THRESHOLD}::DOUBLE * len(ts))
  AND len(list_filter(ns, lambda n: NOT contains(line, ' ' || n || ' '))) = 0 GROUP BY 1, 2
  UNION ALL SELECT doc_id, label, 1.0 FROM w, z WHERE contains(line, ' ' || array_to_string(ps, ' ') || ' ')),
bl AS (SELECT doc_id, count(*) AS n, min(place) AS lo, max(place) AS hi, list_sort(list_distinct(list(label))) AS labels FROM base GROUP BY 1),
fl AS (SELECT doc_id, list(label) AS labels, max(c) AS c FROM found GROUP BY 1)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, lo AS first_word, hi AS last_word, coalesce(array_to_string(bl.labels, ','), '') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(bl.labels, []), coalesce(fl.labels, [])))), ',') AS labels, CASE WHEN n > 0 THEN 1.0 ELSE coalesce(c, 0.0) END::DOUBLE AS score
FROM w LEFT JOIN bl USING (doc_id) LEFT JOIN fl USING (doc_id)
"""


def secret_sql() -> str:
    """Places are running sums of the lengths of matches and of what lies between them; entropies are taken of every window anew."""
    quoted = lambda p: p.replace("'", "''")
    patterns = [secrets.ASSIGN, secrets.ACCESS, r"[0-9a-f]{24,}", r"[A-Za-z0-9+/_=-]{20,}"]
    same = "|".join(f"{c if c.isalnum() else chr(92) + c}{{8}}" for c in secrets.ALPHABET)
    allowed = " OR ".join(f"regexp_matches(x.s, '{quoted(p)}')" for p in secrets.ALLOWED if p.startswith("^"))
    spans = ", ".join(
        f"""list_transform(range(1, len(m{k}) + 1), lambda i: {{'a': (list_sum(list_transform(g{k}[:i], lambda y: length(y))) + coalesce(list_sum(list_transform(m{k}[:i - 1], lambda y: length(y))), 0))::BIGINT,
      'k': {k}, 's': m{k}[i], 'v': v{k}[i]}}) AS r{k}"""
        for k in range(4)
    )
    parts = ", ".join(
        f"regexp_extract_all(t, '{quoted(p)}') AS m{k}, string_split_regex(t, '{quoted(p)}') AS g{k}, regexp_extract_all(t, '{quoted(p)}', {2 if k == 0 else 0}) AS v{k}" for k, p in enumerate(patterns)
    )
    size = secrets.WINDOW
    # a match of length n touches a window if the window with n - 1 characters more on either side holds it
    literals = [w for p in secrets.ALLOWED if p.startswith("(?i)") for w in p.removeprefix("(?i)").split("|")]
    wider = lambda n: f"x.s[greatest(1, j - {n - 1}):j + {size + n - 2}]"
    clear = " AND ".join([f"NOT regexp_matches({wider(8)}, '{quoted(same)}')", *(f"NOT contains(lower({wider(len(w))}), '{w}')" for w in literals)])
    u = f"x.s[j:j + {size - 1}]"
    enough = f"list_entropy(string_split({u}, '')) >= CASE WHEN regexp_full_match({u}, '[0-9a-fA-F]+') THEN {secrets.HEX_BITS} ELSE {secrets.OTHER_BITS} END"
    high = f"list_bool_or(list_transform(range(1, length(x.s) - {size - 2}), lambda j: {enough} AND {clear}))"
    show = lambda xs: f"array_to_string(list_transform({xs}, lambda x: {_listed(secrets.KINDS)}[x.k + 1] || ':' || x.a || ':' || (x.a + length(x.s))), ',')"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), p AS (SELECT doc_id, {parts} FROM d), r AS (SELECT doc_id, {spans} FROM p),
s AS (SELECT doc_id, list_filter(r0, lambda x: length(x.v) >= 6) AS s0, r1 AS s1, r2 AS s2, r3 FROM r), b AS (SELECT *, list_sort(list_concat(s0, s1, s2)) AS base FROM s),
e AS (SELECT *, list_filter(r3, lambda x: regexp_matches(x.s, '[0-9]') AND regexp_matches(x.s, '[A-Za-z]') AND NOT ({allowed})
  AND len(list_filter(base, lambda y: x.a < y.a + length(y.s) AND y.a < x.a + length(x.s))) = 0 AND {high}) AS s3 FROM b)
SELECT doc_id, len(s0)::BIGINT AS n_assign, len(s1)::BIGINT AS n_access, len(s2)::BIGINT AS n_hex, sha256({show("base")}) AS base_sha256, {show("list_sort(list_concat(base, s3))")} AS spans FROM e
"""


def _crc32(text: str) -> str:
    """The unsigned crc32 of a string's UTF-8 bytes, a byte at a time by a table that is made a bit at a time."""
    table = "(SELECT list(list_reduce(range(0, 8), lambda c, j: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) ORDER BY b) FROM range(0, 256) t(b))"
    code = f"list_transform(range(0, octet_length(encode({text}))), lambda i: ('0x' || hex(encode({text}))[2 * i + 1:2 * i + 2])::BIGINT)"
    return f"(SELECT xor(list_reduce({code}, lambda a, y: xor(a >> 8, tab[xor(a & 255, y) + 1]), 4294967295), 4294967295) FROM (SELECT {table} AS tab))"


def fingerprint_sql(rarest: int = imatch.RAREST, commonest: int = imatch.COMMONEST) -> str:
    """Words, marks and hashes as rows; likenesses are counted from the hashes of the fingerprints."""
    lower = "translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    n, rates, wide, empty = imatch.SUBSETS, imatch.RATES, imatch.DIGITS, imatch.EMPTY
    cell = lambda f, r: f"substr({f}, 3 + (greatest(ra, rb) - {r}) * {n * wide} + i * {wide}, {wide})"
    like = lambda a, b: f"""(SELECT CASE WHEN x.{a} = x.{b} THEN 1.0 WHEN abs(ra - rb) >= {rates} THEN 0.0 WHEN filled = 0 THEN 0.0 ELSE same / filled END::DOUBLE FROM (
    SELECT any_value(ra) AS ra, any_value(rb) AS rb, count(*) FILTER (p = q AND p <> '{empty}') AS same, count(*) FILTER (p <> '{empty}' OR q <> '{empty}') AS filled FROM (
      SELECT ra, rb, {cell(f"x.{a}", "ra")} AS p, {cell(f"x.{b}", "rb")} AS q FROM (SELECT substr(x.{a}, 1, 2)::INT AS ra, substr(x.{b}, 1, 2)::INT AS rb, unnest(range(0, {n})) AS i))))"""  # noqa: E731
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
o AS (SELECT doc_id, t, coalesce(lead(t) OVER w, first_value(t) OVER w) AS nt, coalesce(lead(doc_id) OVER w, first_value(doc_id) OVER w) AS nid FROM d WINDOW w AS (ORDER BY doc_id DESC)),
e AS (SELECT doc_id, nid, length(t) AS n_chars, t, substr(t, 1, length(t) - length(t) // 2) || substr(nt, 1, length(t) // 2) AS et FROM o),
texts AS (SELECT doc_id, 0 AS kind, t FROM e UNION ALL SELECT doc_id, 1, et FROM e),
words AS MATERIALIZED (SELECT doc_id, kind, unnest(list_distinct(list_filter(string_split_regex({lower}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> ''))) AS w FROM texts),
lexicon AS (SELECT w FROM words WHERE kind = 0 GROUP BY w HAVING count(*) * {rarest} >= (SELECT count(*) FROM d) AND count(*) * {commonest} <= (SELECT count(*) FROM d)),
known AS (SELECT words.*, w IN (SELECT w FROM lexicon) AS inside FROM words),
chosen AS (SELECT doc_id, kind, w FROM (SELECT *, bool_or(inside) OVER (PARTITION BY doc_id, kind) AS found FROM known) WHERE inside OR NOT found),
marks AS (SELECT w, {_crc32("w")}::HUGEINT * {imatch.FACTOR} % {1 << imatch.BITS} AS v FROM (SELECT DISTINCT w FROM chosen)),
terms AS (SELECT doc_id, kind, w, v::BIGINT AS v, (v % {n})::INT AS k FROM chosen JOIN marks USING (w)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id, kind ORDER BY v, w) AS nth FROM terms),
rates AS (SELECT doc_id, kind, coalesce({imatch.BITS + 1} - length(bin(max(CASE WHEN nth = {n + 1} THEN v END))), 0) AS r FROM ranked GROUP BY doc_id, kind),
hashes AS (SELECT doc_id, kind, i, k, left(md5(string_agg(w, ' ' ORDER BY w)), {wide}) AS h FROM ranked JOIN rates USING (doc_id, kind), (SELECT unnest(range(0, {rates})) AS i)
  WHERE v < (1::BIGINT << greatest(0, {imatch.BITS} - r - i)) GROUP BY doc_id, kind, i, k),
prints AS (SELECT doc_id, kind, lpad(coalesce(any_value(r), 0)::VARCHAR, 2, '0') || string_agg(coalesce(h, '{empty}'), '' ORDER BY i, k) AS f
  FROM (SELECT doc_id, kind, i, k FROM texts, (SELECT unnest(range(0, {rates})) AS i), (SELECT unnest(range(0, {n})) AS k)) LEFT JOIN rates USING (doc_id, kind) LEFT JOIN hashes USING (doc_id, kind, i, k) GROUP BY doc_id, kind),
x AS (SELECT e.doc_id, n_chars, sha256(et) AS edited_sha256, a.f AS fingerprint, b.f AS edited_fingerprint, c.f AS next_fingerprint
  FROM e JOIN prints a ON a.doc_id = e.doc_id AND a.kind = 0 JOIN prints b ON b.doc_id = e.doc_id AND b.kind = 1 JOIN prints c ON c.doc_id = nid AND c.kind = 0)
SELECT doc_id, n_chars::BIGINT AS n_chars, edited_sha256, fingerprint, edited_fingerprint, {like("fingerprint", "edited_fingerprint")} AS near_edited, {like("fingerprint", "next_fingerprint")} AS near_next FROM x
"""


def cluster_sql(k: int = 40, rounds: int = 5, salt: str = "2", dims: int = 64, scale: int = 256) -> str:
    """Each round as tables: distances as sums over all components of all pairs, centroids as floors of sums over counts."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""d{r} AS MATERIALIZED (SELECT i, c, list_sum(list_transform(range(1, {dims + 1}), lambda j: (v[j] - m[j]) * (v[j] - m[j])))::BIGINT AS d FROM x, c{r}),
a{r} AS MATERIALIZED (SELECT i, min({{'d': d, 'c': c}}) AS best FROM d{r} GROUP BY i)""")
        if r < rounds:
            steps.append(f"""s{r} AS (SELECT c, j, sum(v[j])::HUGEINT AS s, count(*) AS n FROM (SELECT best.c AS c, v FROM a{r} JOIN x USING (i)), (SELECT unnest(range(1, {dims + 1})) AS j) GROUP BY c, j),
n{r} AS (SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY j) AS m FROM s{r} GROUP BY c),
c{r + 1} AS MATERIALIZED (SELECT c{r}.c, coalesce(n{r}.m, c{r}.m) AS m FROM c{r} LEFT JOIN n{r} USING (c))""")
    whole = f"list_transform(embedding, lambda y: floor(y::DOUBLE * {scale})::BIGINT)"
    return f"""
WITH x AS MATERIALIZED (SELECT row_number() OVER () AS i, vec_id, {whole} AS v FROM embeddings WHERE len(embedding) = {dims} AND list_bool_and(list_transform(embedding, lambda y: y IS NOT NULL AND isfinite(y)))),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v AS m FROM (SELECT sha256('{salt}:' || vec_id) AS h, v FROM x ORDER BY h, v LIMIT {k})),
{", ".join(steps)}
SELECT vec_id, best.c::INT AS cluster, best.d AS distance, (sum(best.d) OVER (PARTITION BY best.c))::BIGINT AS cluster_inertia, (sum(best.d) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(m, ',')) AS centroid_sha256 FROM a{rounds} JOIN x USING (i) JOIN c{rounds} ON c{rounds}.c = best.c
"""


def spelling_sql(every: int = 97, least_length: int = 5, least_count: int = 3, factor: int = 2) -> str:
    """Near words by equality of what is left without one place."""
    return f"""
WITH runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS c FROM runs WHERE length(run) >= {least_length} GROUP BY doc_id, run),
hashed AS (SELECT run, c, {_crc32("s")} AS h FROM (SELECT *, doc_id || ':' || run AS s FROM counted)),
cut AS (SELECT CASE WHEN h % {every} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c FROM hashed),
v AS MATERIALIZED (SELECT word, sum(c)::BIGINT AS n FROM cut WHERE length(word) >= {least_length} GROUP BY word HAVING sum(c) >= {least_count}),
less AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT *, unnest(range(0, length(word))) AS i FROM v)),
near AS MATERIALIZED (SELECT a.word, b.word AS other, b.n AS other_n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN v b ON b.word = a.rest UNION SELECT b.word, a.word, a.n FROM less a JOIN v b ON b.word = a.rest),
best AS (SELECT word, count(*) AS n_near, min({{'less': -other_n, 'form': other}}) AS b FROM near GROUP BY word),
forms AS MATERIALIZED (SELECT v.word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN -b.less >= {factor} * n THEN b.form END AS form, CASE WHEN -b.less >= {factor} * n THEN -b.less END AS form_n FROM v LEFT JOIN best USING (word)),
path AS (WITH RECURSIVE p AS (SELECT word, form AS stop FROM forms WHERE form IS NOT NULL UNION ALL SELECT p.word, f.form FROM p JOIN forms f ON f.word = p.stop WHERE f.form IS NOT NULL) SELECT word, stop FROM p)
SELECT f.word, f.form, coalesce((SELECT stop FROM path JOIN forms g ON g.word = stop WHERE path.word = f.word AND g.form IS NULL), f.word) AS root, f.n, f.n_near, f.form_n FROM forms f
"""
