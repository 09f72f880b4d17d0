import math
import random
from zlib import crc32

import numpy as np
import pytest

from corvane.llm import quality, toxicity
from corvane.llm.labelled import training_rows

COMMON = "the of and to in is was for on that with as by at from are be this".split()


def corpus(n=1500, seed=2):
    """Texts, whose quality falls with junk and whose toxicity is a rude stem, and their labels."""
    r = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = [r.choice(COMMON) if r.random() < 0.5 else "".join(r.choice("aeioubdlmnrst") for _ in range(r.randrange(3, 9))) for _ in range(r.randrange(3, 150))]
        junk, rude = r.random() < 0.3, r.random() < 0.2
        if junk:
            words = [w + r.choice("#$%&") if r.random() < 0.6 else w for w in words]
        if rude:
            for _ in range(r.randrange(1, 4)):
                words.insert(r.randrange(len(words) + 1), "grum" + r.choice(["pel", "paz", "pix", "pu", "pol"]) + r.choice("aeiou"))
        rows.append((i, " ".join(words), r.choice(["en", "de", None]), f"s{i % 3}"))
        labels.append((i, int(not junk), int(rude)))
    odd = [(n, None, None, None), (n + 1, "", "en", "x"), (None, "the of", "en", "x"), (0, rows[0][1], "en", "x"), (n + 2, "wörd " * 70_000, "de", "x"), (n + 3, "!!! 123", "de", "x")]
    return rows + odd, labels


@pytest.fixture(scope="module")
def tables(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, lang string, source string, score double").repartition(4)
    return docs, spark.createDataFrame([*labels, (None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int"), labels


def judged(got, labels, column):
    truth = {x[0]: x[column] for x in labels}
    assert all(r.held_out == (r.doc_id is not None and crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [(r.predicted, truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    assert all(0 <= r.score <= 1 for r in got)
    return np.mean([p == t for p, t in held])


def test_quality(tables):
    docs, labels, truth = tables
    got = quality.quality_scores(docs, labels).collect()
    assert len(got) == docs.count() and judged(got, truth, 1) > 0.95
    assert all(r.predicted == (r.score >= 0.3) for r in got)
    assert len({r.score for r in got if r.doc_id == 0}) == 1


def test_toxicity(tables):
    docs, labels, truth = tables
    got = toxicity.toxicity_scores(docs, labels).collect()
    assert len(got) == docs.count() and judged(got, truth, 2) > 0.95
    assert all(r.predicted == (r.score >= 0.5) and r.flagged == (r.score >= r.lang_threshold) for r in got)


@pytest.mark.parametrize("f", [quality.quality_scores, toxicity.toxicity_scores])
def test_without_labels_and_rows(tables, f):
    docs, labels, _ = tables
    few = docs.limit(20)
    assert {round(r.score, 3) for r in f(few, labels.limit(0)).collect()} == {0.5}
    assert f(docs.limit(0), labels).count() == 0
    one = labels.filter("quality = 1 and toxic = 1")
    assert {round(r.score, 3) for r in f(few, one).collect()} <= {0.5, 0.999}


def test_training_rows_are_outside_the_held_out_fifth(tables):
    docs, labels, _ = tables
    got = training_rows(docs.select("doc_id", "text"), labels, "toxic", 100).collect()
    assert 100 <= len(got) <= 101 and all(crc32(str(r.doc_id).encode()) % 5 for r in got)


def test_long_texts_pool_like_short_ones(monkeypatch):
    r = random.Random(1)
    texts = [" ".join(r.choice(COMMON) for _ in range(r.choice([0, 1, 2, 50, 400]))) for _ in range(60)]
    model = toxicity.train(texts, np.array([i % 2 for i in range(60)], float), epochs=1)
    whole = model.scores(texts)
    monkeypatch.setattr(toxicity, "SEGMENT", 7)
    assert np.allclose(whole, model.scores(texts), atol=1e-6)


def test_pairs_learn_what_single_features_cannot():
    r = np.random.default_rng(0)
    x = r.uniform(-1, 1, (4000, 3))
    y = ((x[:, 0] > 0.2) != (x[:, 2] > 0.1)).astype(float)
    model = quality.fit(x[:3000], y[:3000])
    assert (0, 2) in model.pairs and ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.9


def plain_pool(model, words):
    """The forward pass of one text, window by window: embeddings averaged over a word's buckets, then every filter at every place."""
    vectors = [np.mean([model.embed[b] for b in toxicity.word_hashes(w)], axis=0) for w in words] or [np.zeros(toxicity.DIM)]
    hidden = []
    for j, width in enumerate(toxicity.WIDTHS):
        for k in range(toxicity.FILTERS):
            best = max(
                sum(float(vectors[i + d] @ model.filters[j][d][:, k]) for d in range(width) if i + d < len(vectors)) for i in range(len(vectors))
            )
            hidden.append(max(0.0, best + float(model.bias[j * toxicity.FILTERS + k])))
    z = float(np.dot(hidden, model.out)) + model.out_bias
    return 1 / (1 + math.exp(-z))


def test_scores_equal_a_plain_forward_pass():
    rows, labels = corpus(300, seed=4)
    toxic = {i: t for i, _, t in labels}
    texts = [t for i, t, *_ in rows[:300]]
    model = toxicity.train(texts, np.array([toxic[i] for i in range(300)], float), epochs=1)
    some = [*texts[:25], "", "one", "two words", "wörd É 12 grumpela"]
    assert np.allclose(model.scores(some), [plain_pool(model, toxicity.WORD(t.lower())) for t in some], atol=1e-5)


def test_quality_scores_equal_sums_of_table_entries():
    r = np.random.default_rng(1)
    x = r.uniform(-1, 1, (800, 4))
    model = quality.fit(x, ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float), rounds=10, pair_rounds=10, most_pairs=3)
    some = np.vstack([x[:40], [[9, 9, 9, 9], [-9, -9, -9, -9]]])
    for row, score in zip(some, model.score(some), strict=True):
        z = model.base
        for f, (edges, table) in enumerate(zip(model.edges, model.tables, strict=True)):
            z += table[sum(row[f] >= e for e in edges)]
        for (a, b), table in zip(model.pairs, model.pair_tables, strict=True):
            z += table[sum(row[a] >= e for e in model.pair_edges[a]), sum(row[b] >= e for e in model.pair_edges[b])]
        assert score == pytest.approx(1 / (1 + math.exp(-z)))


def test_features_by_hand():
    got = dict(zip(quality.FEATURES, quality.features("Aa bb# bb#, 12|\n\nAa bb# bb#, 12|"), strict=True))
    assert got["log_words"] == pytest.approx(math.log(9)) and got["distinct_words"] == 0.5 and got["top_word"] == 0.25 and got["longest_word"] == 4
    assert got["symbol_ends"] == 0.5 and got["top_symbol"] == 0.5 and got["stops_commas"] == 0.25 and got["digits"] == pytest.approx(4 / 32) and got["capitals"] == pytest.approx(2 / 32)
    assert got["repeated_lines"] == pytest.approx(15 / 32) and got["short_words"] == 0.25


def test_the_bytes_that_a_model_learns_from_are_bounded(spark):
    docs = spark.createDataFrame([(i, f"word{i} " * (100_000 if i == 3 else 5), "en") for i in range(40)] + [(4, "another row", "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    a, b = (sorted((r.doc_id, r.score) for r in toxicity.toxicity_scores(docs.repartition(n), labels, fit_bytes=1000).collect()) for n in (1, 5))
    assert a == b and len(a) == 41
