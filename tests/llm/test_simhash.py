import random
import re

import numpy as np
import pytest
import xxhash

from corvane.llm import simhash_dedup as S
from corvane.llm.common import connected_components


def plain_print(text, k=3):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    words = [w.lower() for w in words]
    if not words:
        return 0
    hs = [xxhash.xxh64_intdigest(b" ".join(words[i : i + k]), 42) for i in range(max(1, len(words) - k + 1))]
    return sum((2 * sum(h >> b & 1 for h in hs) > len(hs)) << b for b in range(64))


def classes(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def some_texts(n=400, seed=0):
    r = random.Random(seed)
    base = [" ".join(r.choice("abcdefghij") * r.randrange(1, 4) for _ in range(r.randrange(1, 400))) for _ in range(n // 4)]
    out = [None, "", " \t\n", "One", "one", "ONE two", "É é", "a b c"]
    while len(out) < n:
        words = r.choice(base).split()
        for _ in range(r.choice([0, 0, 1, 1, 2, 5])):
            words[r.randrange(len(words))] = "X"
        out.append(" ".join(words))
    return out


def test_fingerprints():
    texts = [t or "" for t in some_texts()]
    assert [int(x) for x in S.fingerprints(texts, 3, 42)] == [plain_print(t) for t in texts]


@pytest.mark.parametrize("most", [10**9, 2500, 300, 1])
def test_trees_find_every_pair(most):
    r = np.random.default_rng(most)
    centres = r.integers(0, 1 << 63, 300, dtype=np.uint64)
    flips = np.zeros(3000, np.uint64)
    for _ in range(4):
        flips ^= np.where(r.random(3000) < 0.5, np.uint64(1) << r.integers(0, 64, 3000).astype(np.uint64), np.uint64(0))
    prints = np.unique(r.choice(centres, 3000) ^ flips)
    want = [(i, j) for i in range(len(prints)) for j in np.flatnonzero(np.bitwise_count(prints[i] ^ prints[i + 1 :]) <= 3) + i + 1]
    found = []
    seen = 0
    tree = S.upper_tree(prints[::7], len(prints) / len(prints[::7]), most, 3)
    assert isinstance(tree, S.Node) == (most < len(prints))
    for _, own, guests in S.route(tree, prints, 3):
        seen += len(own)
        at = np.r_[own, guests]
        root = S.linked(prints[own], prints[guests], 3, leaf=16)
        found += [(int(at[i]), int(at[x])) for i, x in enumerate(root)]
    assert seen == len(prints)
    assert classes(range(len(prints)), want) == classes(range(len(prints)), found)


@pytest.mark.parametrize("rows,repeats", [(16384, 1), (20, 2)])
def test_simhash_dedup(spark, rows, repeats):
    texts = some_texts()
    docs = spark.createDataFrame([(1000 - i, t, "x") for i, t in enumerate(texts)] * repeats, "doc_id long, text string, fp string").repartition(5)
    prints = {1000 - i: plain_print(t) for i, t in enumerate(texts)}
    ids = sorted(prints)
    want = classes(ids, [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if (prints[a] ^ prints[b]).bit_count() <= 3])
    got = S.simhash_dedup(docs, shard_rows=rows, sample=100).collect()
    assert len(got) == len(texts) * repeats
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(int(r.fingerprint, 16) == prints[r.doc_id] and r.kept == (r.doc_id == r.component_id) for r in got)
    assert len(set(want.values())) < 300


def test_shards_stay_near_their_size_and_guests_few():
    """Clustered fingerprints: the largest shard is near what was asked for, and copies of rows don't run away."""
    r = np.random.default_rng(3)
    centres = r.integers(0, 1 << 63, 2000, dtype=np.uint64)
    prints = np.unique(r.choice(centres, 60_000) ^ (np.uint64(1) << r.integers(0, 64, 60_000).astype(np.uint64)) ^ (np.uint64(1) << r.integers(0, 64, 60_000).astype(np.uint64)))
    tree = S.upper_tree(prints[:: max(1, len(prints) // 4096)], len(prints) / len(prints[:: max(1, len(prints) // 4096)]), 8192, 3)
    dealt = [(len(own), len(own) + len(guests)) for _, own, guests in S.route(tree, prints, 3)]
    assert len(dealt) > 7 and max(n for n, _ in dealt) < 1.5 * 8192 and sum(n for _, n in dealt) < 4 * len(prints)


def test_very_long_texts(spark):
    r = random.Random(6)
    words = [r.choice("abcdefghijklmnop") + str(r.randrange(50)) for _ in range(200_000)]
    texts = [" ".join(words), " ".join([*words[:-1], "X"]), " ".join(words[::-1])]
    got = {x.doc_id: x for x in S.simhash_dedup(spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, component_id string")).collect()}
    assert [int(got[i].fingerprint, 16) for i in range(3)] == [plain_print(t) for t in texts] and [got[i].component_id for i in range(3)] == [0, 0, 2]


def test_null_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "q w e r"), (None, None), (5, "q w e r"), (5, "q w e r")], "doc_id long, text string")
    got = S.simhash_dedup(docs)
    assert sorted((str(r.doc_id), str(r.component_id), r.kept) for r in got.collect()) == [
        ("5", "5", True), ("5", "5", True), ("None", "5", False), ("None", "None", True)
    ]
    assert S.simhash_dedup(docs.limit(0)).count() == 0


def test_a_shared_identifier_drops_only_the_row_that_has_a_representative(spark):
    r = random.Random(8)
    x, y = (" ".join(r.choices("abcdefghijklmnop", k=60)) for _ in range(2))
    rows = [(5, x, "kept"), (5, y, "goes"), (3, y.upper(), "kept"), (7, x, "goes"), (7, y, "goes"), (5, x, "kept"), (9, None, "kept"), (9, x, "goes"), (None, x, "goes"), (None, "", "goes"), (None, x[::-1], "kept")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string").repartition(3)
    got = S.representative_documents(docs)
    assert got.columns == docs.columns
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(str(r) for r in rows if r[2] == "kept")


def test_components_of_a_long_path(spark):
    r = random.Random(4)
    name = list(range(300))
    r.shuffle(name)
    edges = [(name[i], name[i + 1]) for i in range(199)] + [(name[200], x) for x in name[201:]] + [(7, 7)]
    got = {x.node: x.component for x in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: c for n, c in classes(range(300), edges).items() if any(n in e and e[0] != e[1] for e in edges)}
