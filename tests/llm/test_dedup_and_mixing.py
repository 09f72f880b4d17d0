import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest

from corvane.llm import exact_dedup, mixing


@pytest.mark.parametrize("digest_bytes,filter_bytes,keep", [(32, 8 << 20, "max"), (1, 8 << 20, "max"), (1, 0, "min"), (32, 0, "min")])
def test_exact_dedup(spark, digest_bytes, filter_bytes, keep):
    r = random.Random(3)
    texts = [None, "", "a" * 200_000, "á", "á"] + ["".join(r.choice("ab \n") for _ in range(r.randrange(6))) for _ in range(400)]
    rows = [(i, texts[i % 405] if i % 3 else "hot", "x") for i in range(1200)]
    rows += [(None, "hot", "x"), (None, "nowhere else", "x"), (7, rows[7][1], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, keep_id string").repartition(6)
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[t or ""].append(i)
    want = []
    for i, t, _ in rows:
        ids = [x for x in groups[t or ""] if x is not None]
        best = (max if keep == "max" else min)(ids) if ids else None
        want.append((str(i), str(best), len(groups[t or ""]), i == best, hashlib.sha256((t or "").encode()).hexdigest()))
    got = exact_dedup.exact_dedup(docs, keep=keep, digest_bytes=digest_bytes, filter_bytes=filter_bytes).collect()
    assert sorted(want) == sorted((str(x.doc_id), str(x.keep_id), x.group_size, x.kept, x.text_sha256) for x in got)


def test_index_merges_runs(spark):
    index = exact_dedup.DigestIndex(spark)
    for part in ([(b"a", 1), (b"b", 2)], [(b"a", 9), (b"a", 3)], []):
        index.append(spark.createDataFrame([(bytearray(d), i) for d, i in part], "digest binary, doc_id long"))
    assert len(index.runs) == 3
    assert sorted((bytes(r.digest), r.keep_id, r.n) for r in index.entries().collect()) == [(b"a", 9, 3), (b"b", 2, 1)]
    assert not index.runs and index.lookup(b"b").first().keep_id == 2 and index.lookup(b"c").count() == 0
    index.append(spark.createDataFrame([(bytearray(b"b"), 7), (bytearray(b"c"), 1)], "digest binary, doc_id long"))  # merges with the level
    assert sorted((bytes(r.digest), r.keep_id, r.n) for r in index.entries().collect()) == [(b"a", 9, 3), (b"b", 7, 2), (b"c", 1, 1)]
    digests = spark.createDataFrame([(bytearray(str(i).encode()),) for i in range(2000)] + [(bytearray(b"a"),), (bytearray(b"c"),)], "digest binary")
    passed = {bytes(r.digest) for r in index.probe(digests).collect()}
    assert b"a" in passed and b"c" not in passed and len(passed) < 20


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert exact_dedup.exact_dedup(docs).count() == mixing.mix(docs).count() == mixing.mixed_documents(docs).count() == 0


def targets(sizes, weights, share, most):
    """Reshares what is above the caps, over and over."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, out, full = share * sum(sizes.values()), {}, set()
    while True:
        rest, weight = total - sum(most * sizes[s] for s in full), sum(w[s] for s in order if s not in full)
        out = {s: most * sizes[s] if s in full else rest * w[s] / weight for s in order}
        above = {s for s in order if s not in full and out[s] > most * sizes[s] + 1e-9}
        if not above:
            return out
        full |= above


@pytest.mark.parametrize("bins,bin_rows", [(4096, 4096), (3, 20)])
def test_mixing(spark, bins, bin_rows):
    r = random.Random(8)
    rows = []
    for i in range(3000):
        source = "hot" if i % 3 == 0 else r.choice(["a", "b", "é", "z9", "", None])
        rows.append((i, None if i % 97 == 0 else " ".join(["w"] * int(r.paretovariate(1.1))), source, "c"))
    rows += [(10**6, "\t \n", "empty only", "c"), (None, "one two", "a", "c"), (10**6 + 1, "w " * 900, "b", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size string")
    got = mixing.mix(docs, bins=bins, bin_rows=bin_rows).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    per, taken, longest = Counter(), Counter(), Counter()
    of = {i: s for i, _, s, _ in rows}
    for _, t, s, _ in rows:
        per[s] += size(t)
    want = targets(dict(per), (5, 2, 1), 1.5, 2.0)
    for x in got:
        s = of[x.doc_id]
        assert x.source_size == per[s] and x.target == pytest.approx(want[s]) and x.taken == x.copies * x.size <= 2 * x.size
        taken[s] += x.taken
        longest[s] = max(longest[s], x.size)
    assert len(got) == len(rows) and sum(want.values()) == pytest.approx(1.5 * sum(per.values()))
    for s in per:
        assert abs(taken[s] - want[s]) <= max(0.01 * want[s], 2, longest[s] / 2), (s, taken[s], want[s])
    again = mixing.mix(docs.repartition(7), bins=4096).collect()
    key = lambda x: (str(x.doc_id), x.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))
    mixed = mixing.mixed_documents(docs, bins=bins, bin_rows=bin_rows)
    assert mixed.columns == docs.columns
    copies = Counter(str(x.doc_id) for x in mixed.collect())
    assert copies == Counter({str(x.doc_id): x.copies for x in got if x.copies})


def test_odds_order_the_sample(spark):
    """Within a source, documents longer than what is open have lower odds; the sample's share of equal ones is near the ratio."""
    docs = spark.createDataFrame([(i, "w " * 10, "a" if i < 4000 else "b") for i in range(8000)], "doc_id long, text string, source string")
    got = mixing.mix(docs, weights=(1, 3), share=0.5).collect()
    share = sum(x.copies for x in got if x.doc_id < 4000) / 4000
    assert share == pytest.approx(0.25, abs=0.002)


def test_many_sources(spark):
    """Targets of thousands of sources, dealt to ranges, equal the plain resharing."""
    r = random.Random(5)
    rows = [(i, "w " * r.randrange(1, 9), None if i % 1999 == 0 else f"s{r.randrange(1500)}") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    per = Counter()
    for _, t, s in rows:
        per[s] += len(t.split())
    sizes = docs.selectExpr("source", "size(split(trim(text), ' ')) as size")
    want = targets(dict(per), (5, 2, 1), 1.5, 2.0)
    for most in (100, 10**6):
        got = {x.source: x.target for x in mixing.source_targets(sizes, (5, 2, 1), 1.5, 2.0, most).collect()}
        assert got.keys() == want.keys() and all(got[s] == pytest.approx(want[s]) for s in want)


def test_very_long_texts(spark):
    docs = spark.createDataFrame([(1, "w " * 400_000, "a", 1), (2, "w " * 400_000, "a", 1), (3, "x" * 2_000_000, "b", 1)], "doc_id long, text string, source string, bin int")
    got = {x.doc_id: x for x in mixing.mix(docs).collect()}
    assert (got[1].size, got[3].size) == (400_000, 1) and got[1].taken + got[2].taken in (800_000, 1_200_000, 1_600_000)
    kept = {x.doc_id: x.keep_id for x in exact_dedup.exact_dedup(docs).collect()}
    assert kept == {1: 2, 2: 2, 3: 3}
