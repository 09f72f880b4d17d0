from collections import Counter

import corpus_pipeline
from corvane.llm import mixing, quality
from tests.llm.test_simhash import classes, plain_print

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scores = {r.doc_id: r.score for r in quality.quality_scores(docs, labels).collect()}
    steps = {}
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, now, SF).write.parquet(f"{tmp_path}/{name}")
        now = spark.read.parquet(f"{tmp_path}/{name}")
        steps[name] = now.collect()
        if name != "packing":
            assert now.columns == docs.columns
    texts = {r.doc_id: r.text for r in docs.collect()}
    good = {i for i, s in scores.items() if s >= 0.3}
    assert {r.doc_id for r in steps["quality"]} == good
    best = {}
    for i in good:
        best[texts[i]] = max(best.get(texts[i], -1), i)
    assert sorted(r.doc_id for r in steps["exact_dedup"]) == sorted(best.values())
    ids = sorted(best.values())
    prints = {i: plain_print(texts[i]) for i in ids}
    group = classes(ids, [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if (prints[a] ^ prints[b]).bit_count() <= 3])
    assert sorted(r.doc_id for r in steps["near_dedup"]) == sorted(set(group.values()))
    kept = spark.read.parquet(f"{tmp_path}/near_dedup")
    copies = {r.doc_id: r.copies for r in mixing.mix(kept).collect()}
    assert Counter(r.doc_id for r in steps["mixing"]) == Counter({i: n for i, n in copies.items() if n})
    total = sum(len(texts[i].split()) for i in set(group.values()))
    assert abs(sum(len(r.text.split()) for r in steps["mixing"]) - 1.5 * total) < 0.05 * total  # there are few documents a source
    by_sequence = {}
    for r in sorted(steps["packing"], key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == by_sequence.get(r.sequence_id, 0)
        by_sequence[r.sequence_id] = r.offset + r.length
    assert max(by_sequence.values()) <= 4096
    assert Counter(r.doc_id for r in steps["packing"] if r.piece == 0) == Counter(r.doc_id for r in steps["mixing"])


CLASH = "text_sha256 string, kept string, size int, fp long, _may int, _row int, score double, y int, piece string, `a b` int"


def test_odd_rows_pass_through(spark):
    rows = [(1, "a b c d", "s"), (1, "a b c d", "s"), (None, "a b c d", None), (None, None, "s"), (3, "", "s"), (4, "tok " * 9, "s")]
    more = ("h", "x", 7, 8, 9, 10, 0.5, 1, "p", 2)
    docs = spark.createDataFrame([(*r, *more) for r in rows], f"doc_id long, text string, source string, {CLASH}")
    got = corpus_pipeline.exact(spark, docs, SF)
    assert got.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in got.collect()) == [("1", "a b c d"), ("3", ""), ("4", "tok " * 9)]
    near = corpus_pipeline.near(spark, docs, SF)
    assert near.columns == docs.columns and sorted(str(r.doc_id) for r in near.collect()) == ["1", "1", "3", "4"]
    for stage in (corpus_pipeline.quality, corpus_pipeline.mixing):
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and {tuple(r)[3:] for r in out.collect()} <= {more}
    packed = corpus_pipeline.packing(spark, docs, SF).collect()
    assert sorted((str(r.doc_id), r.length) for r in packed if r.length == 1) == [("3", 1), ("None", 1)] and len(packed) == 6
    for stage in (corpus_pipeline.quality, corpus_pipeline.exact, corpus_pipeline.near, corpus_pipeline.mixing, corpus_pipeline.packing):
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_very_long_texts_go_through_every_stage(spark):
    long = "word " * 150_000
    docs = spark.createDataFrame([(1, long, "a"), (2, long, "b"), (3, "short text here", "a")], "doc_id long, text string, source string")
    assert [r.doc_id for r in corpus_pipeline.exact(spark, docs, SF).filter("doc_id < 3").collect()] == [2]
    assert sorted(r.doc_id for r in corpus_pipeline.near(spark, docs, SF).collect()) == [1, 3]
    for stage in (corpus_pipeline.quality, corpus_pipeline.mixing):
        assert all(len(r.text) in (len(long), 15) for r in stage(spark, docs, SF).collect())
    assert sum(r.length for r in corpus_pipeline.packing(spark, docs.filter("doc_id = 1"), SF).collect()) == 150_001
