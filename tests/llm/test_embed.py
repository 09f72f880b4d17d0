import numpy as np
import pytest

from corvane.llm import embed_dedup as E
from tests.llm.test_simhash import classes


def plain(rows, threshold):
    ok = {}
    for k, (i, v, label) in enumerate(rows):
        sound = i is not None and v is not None and label is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        if sound:
            ok[k] = (label, np.array(v, np.float32).astype(float))
    n, links = dict.fromkeys(range(len(rows)), 0), []
    keys = list(ok)
    for a, i in enumerate(keys):
        for j in keys[a + 1 :]:
            (l1, x), (l2, y) = ok[i], ok[j]
            if l1 == l2 and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                n[i] += 1
                n[j] += 1
                links.append((i, j))
    comp = classes(range(len(rows)), links)
    least = {}
    for k, r in enumerate(rows):
        if r[0] is not None:
            least[comp[k]] = min(least.get(comp[k], r[0]), r[0])
    return sorted((str(r[0]), n[k], str(least.get(comp[k]))) for k, r in enumerate(rows))


def sample_rows(n=600, dim=8, seed=0):
    r = np.random.default_rng(seed)
    base = r.normal(size=(n // 6, dim))
    v = base[r.integers(0, len(base), n)] + r.normal(size=(n, dim)) * r.choice([0, 0.03, 0.1, 0.3], (n, 1))
    v[: n // 3] = base[0] + 0.1 * r.normal(size=(n // 3, dim))  # a third of all rows is one group of near copies
    rows = [(int(i), [float(np.float32(x)) for x in v[i]], int(r.integers(0, 3)) if i >= n // 3 else 1) for i in range(n)]
    rows += [(n + 1, None, 1), (n + 2, [0.0] * dim, 1), (n + 3, [float("nan")] * dim, 1), (n + 4, rows[0][1], None), (None, rows[0][1], 1)]
    rows += [(n + 5, [None] + [1.0] * (dim - 1), 1), (n + 6, rows[0][1][:3], 1), (n + 7, rows[0][1], 1), (n + 8, [2 * x for x in rows[0][1]], 1)]
    return rows + [(n + 9, [float("inf")] * dim, 1), (n + 10, [], 1)]


@pytest.mark.parametrize("block,sample", [(4096, 8), (40, 8), (10, 1)])
def test_embedding_dedup(spark, block, sample):
    rows = sample_rows()
    clash = "node long, weight string, component_id int, grp string, n_links int"
    vectors = spark.createDataFrame([(*r, 1, "x", 2, "y", 3) for r in rows], f"vec_id long, embedding array<float>, label int, {clash}")
    got = E.embedding_dedup(vectors, 0.98, block_rows=block, sample=sample).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in got) == plain(rows, 0.98)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_empty_and_repeated(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.0, 1.0], 1)], "vec_id long, embedding array<double>, label int")
    assert sorted(map(tuple, E.embedding_dedup(v).collect())) == [(1, 1, 1, True), (1, 1, 1, True), (2, 0, 2, True)]
    assert E.embedding_dedup(v.limit(0)).count() == 0


def test_one_identifier_with_several_vectors_and_labels(spark):
    two = [(1, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [1.0, 0.01], 1), (3, [0.01, 1.0], 1), (4, [1.0, 0.02], 1)]
    labels = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 2), (2, [1.0, 0.01], 1), (3, [0.01, 1.0], 2)]
    for rows in (two, labels):
        got = E.embedding_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
        assert sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in got) == plain(rows, 0.98)
    assert sorted((r.vec_id, r.n_links) for r in got) == [(1, 0), (1, 1), (2, 1), (3, 0)]


def test_tight_groups_need_no_comparisons(spark):
    """A group whose radius proves all links is cut into blocks that are linked by their sums."""
    r = np.random.default_rng(2)
    rows = [(i, [1.0, *(0.01 * r.normal(size=5)).tolist()], 1) for i in range(500)] + [(1000 + i, [-1.0, *(0.01 * r.normal(size=5)).tolist()], 1) for i in range(90)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = E.embedding_dedup(vectors, block_rows=30).collect()
    assert sorted((str(x.vec_id), x.n_links, str(x.component_id)) for x in got) == plain(rows, 0.98)
    assert {x.n_links for x in got} == {499, 89}


@pytest.mark.parametrize("seed", range(4))
def test_dual_traversal(seed):
    r = np.random.default_rng(seed)
    x = E.unit(list(r.normal(size=(40, 6))[r.integers(0, 40, 900)] + r.normal(size=(900, 6)) * r.choice([0, 1e-9, 0.02, 0.1, 1], (900, 1))))
    w = r.integers(1, 4, 900)
    hit = x @ x.T >= 0.98
    np.fill_diagonal(hit, False)
    links, root = E.threshold_links(x, w, None, 0.98)
    assert (links == hit @ w).all()
    pairs = [(int(a), int(b)) for a, b in zip(*np.nonzero(hit), strict=True)]
    assert classes(range(900), pairs) == classes(range(900), list(enumerate(root.tolist())))
    links, root = E.threshold_links(x, w, 300, 0.98)
    hit[:300, :300] = hit[300:, 300:] = False
    assert (links == hit @ w).all()
