import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import pytest

from corvane.llm import imatch as M
from corvane.llm import oracles

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return {w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(UPPER)) if w}


def plain_print(text, lexicon):
    terms = words(text) & lexicon or words(text)
    marks = [(zlib.crc32(w.encode()) * 1_640_531_527 % 2**32, w) for w in terms]
    rate = 0
    while sum(v < 2 ** (32 - rate) for v, _ in marks) > 32:
        rate += 1
    out = f"{rate:02d}"
    for i in range(3):
        for k in range(32):
            own = sorted((w for v, w in marks if v % 32 == k and v < 2 ** (32 - rate - i)), key=str.encode)
            out += hashlib.md5(" ".join(own).encode()).hexdigest()[:4] if own else "----"
    return out


def plain_likeness(a, b):
    ra, rb = int(a[:2]), int(b[:2])
    if a == b:
        return 1.0
    if abs(ra - rb) > 2:
        return 0.0
    cells = lambda x, r: [x[2 + (max(ra, rb) - r) * 128 :][4 * i : 4 * i + 4] for i in range(32)]
    pairs = [(p, q) for p, q in zip(cells(a, ra), cells(b, rb), strict=True) if (p, q) != ("----", "----")]
    return sum(p == q for p, q in pairs) / len(pairs) if pairs else 0.0


def plain(rows, rarest=M.RAREST, commonest=M.COMMONEST):
    rows = [(i, t or "") for i, t in rows]
    df = Counter(w for _, t in rows for w in words(t))
    lexicon = {w for w, n in df.items() if n * rarest >= len(rows) and n * commonest <= len(rows)}
    key = lambda i: (i is None, -(i or 0))
    order = sorted({i for i, _ in rows}, key=key)
    after = dict(zip(order, order[1:] + order[:1], strict=True))
    first = {i: min((t for j, t in rows if j == i), key=lambda t: hashlib.sha256(t.encode()).digest()) for i in order}
    out = []
    for i, t in rows:
        other = first[after[i]]
        half = len(t) // 2
        edited = t[: len(t) - half] + other[:half]
        a, b, c = plain_print(t, lexicon), plain_print(edited, lexicon), plain_print(other, lexicon)
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), a, b, plain_likeness(a, b), plain_likeness(a, c)))
    return sorted(out, key=repr)


def some_rows(seed=1, n=60):
    r = random.Random(seed)
    vocabulary = ["the", "of", *("".join(r.choice("abcdefghiéß") for _ in range(r.randint(2, 9))) for _ in range(700))]
    make = lambda k: r.choice([" ", ", ", "\n"]).join(r.choice(vocabulary[:2] if r.random() < 0.3 else vocabulary).capitalize() for _ in range(k))
    rows = [(r.randrange(10**6) - 500_000, make(r.choice([1, 5, 40, 150, 700, 2500]))) for _ in range(n)]
    return rows + [(rows[0][0] + 1, rows[0][1]), (2**63 - 1, ""), (-(2**63), "the of"), (12, "..."), (13, "\U0001f600 é É 7")]


ODD = [(None, "one two"), (None, None), (12, "again"), (12, "again"), (12, "another"), (14, None)]


def collected(df):
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return sorted(map(tuple, df.select(*names).collect()), key=repr)


@pytest.mark.parametrize("most_terms", [M.MOST_TERMS, 0])
def test_against_brute_force(spark, most_terms):
    rows = [*some_rows(), *ODD]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert collected(M.document_fingerprints(docs, rarest=40, most_terms=most_terms)) == plain(rows, rarest=40)


def test_sql_agrees(spark):
    docs = spark.createDataFrame(some_rows(2), "doc_id long, text string")
    con = duckdb.connect()
    documents = docs.toPandas()  # noqa: F841
    want = con.execute(f"SELECT doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next FROM ({oracles.fingerprint_sql(40)})").fetchall()
    assert collected(M.document_fingerprints(docs, rarest=40)) == sorted(want, key=repr)


def test_likeness_tells_edits_from_others(spark):
    got = M.document_fingerprints(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()
    long = [r for r in got if r.n_chars >= 200]
    assert sum(r.near_edited > r.near_next for r in long) > 0.9 * len(long)


def test_no_row_holds_the_lexicon(spark):
    docs = spark.createDataFrame(some_rows(), "doc_id long, text string")
    plan = M.document_fingerprints(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" in plan and "AS _table#" not in plan


def test_odd_tables(spark):
    schema = "doc_id long, text string, terms string, digest string, none int, least string"
    assert M.document_fingerprints(spark.createDataFrame([], schema)).collect() == []
    one = M.document_fingerprints(spark.createDataFrame([(3, "abcd", "", "", 1, "")], schema)).first()
    assert one.doc_id == 3 and one.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and one.near_next == 1.0
    rows = [(1, "word " * 400_000), (2, "z" * 3_000_000)]
    assert collected(M.document_fingerprints(spark.createDataFrame(rows, "doc_id long, text string"))) == plain(rows)
