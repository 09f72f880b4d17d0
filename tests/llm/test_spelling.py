import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from corvane.llm import oracles
from corvane.llm import spelling as S

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    """One inserted, deleted or replaced code point, by trying them all."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_words(rows, every=97, least_length=5, least_count=3):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= least_length:
                n[run] += 1
    return {w: c for w, c in n.items() if c >= least_count}


def plain_groups(n, factor=2):
    near_of = {w: [x for x in n if x != w and abs(len(x) - len(w)) < 2 and near(w, x)] for w in n}
    form = {}
    for w, others in near_of.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= factor * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near_of[w]), n[form[w]] if form[w] else None))
    return out


def some_words(seed, count, letters="abé", lengths=(5, 12)):
    r = random.Random(seed)
    base = ["".join(r.choice(letters) for _ in range(r.randint(*lengths))) for _ in range(count // 3 + 1)]
    out = set(base)
    while len(out) < count:
        w = list(r.choice(base))
        for _ in range(r.choice([1, 1, 2])):
            at, kind = r.randrange(len(w) + 1), r.choice("idr")
            if kind == "i":
                w.insert(at, r.choice(letters))
            elif at < len(w) and len(w) > 5:
                w[at : at + 1] = [] if kind == "d" else [r.choice(letters)]
        out.add("".join(w))
    return sorted(out)


@pytest.mark.parametrize("letters, lengths", [("a", (1, 40)), ("ab", (1, 9)), ("abé", (5, 12)), ("aé\U0001f600", (3, 6))])
def test_trie_finds_every_pair_once(letters, lengths):
    count = 39 if letters == "a" else 250
    words = some_words(1, count, letters, lengths) if letters != "a" else ["a" * i for i in range(1, 40)]
    for m in sorted({len(w) for w in words} | {len(w) + 1 for w in words}):
        rows = sorted((w, len(w) == m) for w in words if len(w) in (m - 1, m))
        if not rows:
            continue
        a, b = S.near_rows(np.zeros(len(rows), np.int64), np.full(len(rows), m), [w for w, _ in rows], np.array([x for _, x in rows]))
        got = [frozenset((rows[x][0], rows[y][0])) for x, y in zip(a.tolist(), b.tolist(), strict=True)]
        want = {frozenset((x, y)) for x, lx in rows for y, ly in rows if (lx or ly) and x != y and near(x, y)}
        assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize("most_group, task_rows", [(10**9, 10**9), (20, 400), (1, 400)])
def test_pairs_of_words_against_brute_force(spark, most_group, task_rows):
    words = sorted({*some_words(2, 400), "aaaaa", "aaaaaa", "aaaaaaa", "x" * 3000, "x" * 3001, "x" * 2999 + "y"})
    table = spark.createDataFrame([(w, i + 3) for i, w in enumerate(words)], "word string, n long")
    got = [(r.word, r.other, r.other_n) for r in S.near_words(table, most_group, task_rows).collect()]
    n = {w: i + 3 for i, w in enumerate(words)}
    want = {(a, b, n[b]) for a in words for b in words if a != b and abs(len(a) - len(b)) < 2 and near(a, b)}
    assert len(got) == len(set(got)) and set(got) == want


def some_texts(seed=3, n=120):
    r = random.Random(seed)
    words = some_words(seed, 60) + ["Größe", "ÄPFEL", "straße", "Zeit"]
    rows = [(i, r.choice([" ", "-", "1", "\n"]).join(r.choice(words) for _ in range(r.randrange(60)))) for i in range(n)]
    return [*rows, (n, None), (n + 1, ""), (None, "aabab aabab aabab"), (5, "abcde"), (5, "abcde"), (-7, "abcde" * 5000), (n + 2, "× ÷ aa×bb÷cc ÿÿÿÿÿ")]


def test_groups_against_brute_force(spark):
    rows = some_texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = S.spelling_groups(docs, every=7, task_rows=40, most_group=30).collect()
    assert {tuple(r) for r in got} == plain_groups(plain_words(rows, 7)) and len(got) == len({r.word for r in got})


def test_sql_agrees(spark):
    rows = [x for x in some_texts(4) if x[0] is not None]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    con = duckdb.connect()
    documents = docs.toPandas()  # noqa: F841
    got = {tuple(r) for r in S.spelling_groups(docs, every=5).select("word", "form", "root", "n", "n_near", "form_n").collect()}
    assert got == set(con.execute(oracles.spelling_sql(every=5)).fetchall())


def test_long_paths_of_forms(spark):
    names = ["a" * (5 + i) for i in range(40)]
    words = spark.createDataFrame([(w, 2**i) for i, w in enumerate(names)], "word string, n long")
    got = {r.word: r for r in S.spelling_variants(words).collect()}
    assert {r.root for r in got.values()} == {names[-1]} and all(got[a].form == b for a, b in zip(names, names[1:], strict=False))


def test_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert S.spelling_groups(empty).collect() == []
    clash = spark.createDataFrame([(1, "abcde abcde abcde abcdf", "w", 2, "f")], "doc_id long, text string, word string, n int, form string")
    assert [tuple(r) for r in S.spelling_groups(clash, every=10**12).collect()] == [("abcde", None, "abcde", 3, 0, None)]
    assert S.spelling_groups(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")).collect() == []
