import math
import random
import re

from corvane.llm import licenses as L

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text or "")


def plain(text, block_words):
    text = lowered(text)
    words = WORD.findall(text)
    base = []
    for label, phrase in L.PHRASES.items():
        p = phrase.split()
        base += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    found = {}
    for lo in range(0, max(1, len(words) - block_words // 2), block_words // 2):
        block = set(words[lo : lo + block_words])
        line = " ".join(["", *words[lo : lo + block_words], ""])
        for label, ts in L.TEMPLATES.items():
            for t in ts:
                own = WORD.findall(lowered(t))
                s = set(own)
                said = " ".join(["", *own, ""])
                if len(own) < 12:
                    if said in " ".join(["", *words, ""]):
                        found[label] = 1.0
                elif len(s & block) >= math.ceil(0.8 * len(s)) and all(f" {p} " in line for p in L.DISTINGUISHING.get(label, ()) if f" {p} " in said):
                    found[label] = max(found.get(label, 0), len(s & block) / len(s))
    own = {x for _, x in base}
    return (
        len(words), len(base), min((i for i, _ in base), default=None), max((i for i, _ in base), default=None), ",".join(sorted(own)),
        ",".join(sorted(own | set(found))), 1.0 if base else max(found.values(), default=0.0),
    )


def texts(seed=0, n=300):
    r = random.Random(seed)
    every = [t for ts in L.TEMPLATES.values() for t in ts] + ["under the MIT license under the mit License", "CC-BY-NC cc by", "Apache License; Version 2 "]
    out = [None, "", "\n\n", "cc by nc by nc cc by nc", "Éx cc by nc", "under the mit\nlicense", "K license mit the under", " ".join(["free"] * 500)]
    while len(out) < n:
        parts = []
        for _ in range(r.randrange(6)):
            words = r.choice(every).split() if r.random() < 0.6 else ["the", "of", "é", "x9"] * r.randrange(40)
            if r.random() < 0.5:
                words = [w for w in words if r.random() < 0.88]
            if r.random() < 0.2:
                r.shuffle(words)
            parts.append(r.choice([" ", "*** "]).join(words))
        out.append(r.choice(["\n", " ", ". "]).join(parts))
    return out


def test_against_brute_force(spark):
    rows = [(i, t, "x") for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, labels string").repartition(4)
    got = L.license_scan(docs).collect()
    assert {r.doc_id: tuple(r)[1:8] for r in got} == {i: plain(t, L.BLOCK_WORDS) for i, t, _ in rows}
    assert all({m.label for m in r.matches} <= set(r.labels.split(",")) for r in got)
    assert len({r.labels for r in got}) > 10


def test_filters_lose_nothing_whatever_the_order():
    r = random.Random(5)
    vocabulary = [f"w{i}" for i in range(30)]
    for _ in range(300):
        templates = {f"t{k}": [" ".join(r.sample(vocabulary, r.randrange(1, 12)))] for k in range(5)}
        threshold = r.choice([0.3, 0.5, 0.8, 1.0])
        index = L.TemplateIndex.build(templates, threshold, {w.encode(): r.randrange(9) for w in vocabulary})
        block = [w.encode() for w in r.choices([*vocabulary, "other"], k=r.randrange(25))]
        want = {}
        for label, (t,) in templates.items():
            s = {w.encode() for w in t.split()}
            if len(s & set(block)) >= math.ceil(threshold * len(s) - 1e-12):
                want[label] = len(s & set(block)) / len(s)
        assert {index.labels[t]: c for t, c in index.search(block)} == want


def test_null_ids_and_empty(spark):
    docs = spark.createDataFrame([(None, "cc by nc"), (1, "cc by nc"), (1, "cc by nc")], "doc_id long, text string")
    assert [r.base_labels for r in L.license_scan(docs).collect()] == ["cc-by-nc"] * 3
    assert L.license_scan(docs.limit(0)).count() == 0


NOTICES = {
    "mit": "Copyright (c) 2020 X\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal",
    "gpl-3": "# This program is free software: you can redistribute it\n# and/or modify it under the terms of the GNU General\n# Public License as published by the Free Software\n# Foundation, either version 3",
    "bsd": " * Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided that the following conditions\n * are met:",
}


def test_wrapped_notices(spark):
    rows = [(k, t) for n in (0, 17, 31, 32, 50) for k, t in ((k, "word " * n + "\n" + t + "\n" + "more words\n" * n) for k, t in NOTICES.items())]
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: r for r in L.license_scan(docs).collect()}
    for i, (label, text) in enumerate(rows):
        assert got[i].labels.split(",") == [label] and got[i].score >= 0.8 and {m.label for m in got[i].matches} == {label}


OTHERS = {
    "released under the GPL license": "", "released under the BSD License": "", "The license was released in May. The students under the age of ten": "",
    "licensed under a Creative Commons Attribution 4.0 International License": "", "Licensed under CC BY 4.0": "", "Licensed under CC BY-SA 4.0": "", "All of the reserved seats and rights": "",
    "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License": "cc-by-nc", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License": "cc-by-sa",
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.": "gpl-2",
    "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 3 of the License": "lgpl",
    "The contents of this file are subject to the Mozilla Public License Version 1.1 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.mozilla.org/MPL/": "",
    "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license": "",
    "released under the MIT License": "mit", "All rights\nreserved.": "all-rights-reserved", "licensed under the GNU General Public License, version 3": "gpl-3",
}


def test_other_licenses_get_no_false_label(spark):
    docs = spark.createDataFrame([(i, "word " * (7 * i) + t) for i, t in enumerate(OTHERS)], "doc_id long, text string")
    got = {r.doc_id: r.labels for r in L.license_scan(docs).collect()}
    assert {t: got[i] for i, t in enumerate(OTHERS)} == OTHERS


def test_every_template_is_found_wherever_it_stands():
    index = L.TemplateIndex.build(L.TEMPLATES, L.THRESHOLD, {})
    for label, ts in L.TEMPLATES.items():
        for t in ts:
            words = L.words_of(t.encode().lower())
            assert len(words) <= L.BLOCK_WORDS // 2 + 1
            for before in range(0, 70, 3):
                text = [b"x"] * before + words + [b"y"] * 80
                assert label in {index.labels[k] for _, block in L.blocks_of(text, L.BLOCK_WORDS) for k, _ in index.search(block)}


def test_many_hits_cost_in_proportion(spark):
    import time

    took = []
    for n in (40_000, 160_000):
        words = L.words_of(b"cc by nc " * n)
        began = time.process_time()
        found = L._phrases(words, {"cc-by-nc": b" cc by nc "})
        took.append(time.process_time() - began)
        assert len(found) == n and found[-1][0] == 3 * (n - 1)
    assert took[1] < 12 * max(took[0], 0.005)
    long = "cc by nc " * 50_000 + "released under the\nMIT License " + "é" * 300_000
    got = L.license_scan(spark.createDataFrame([(1, long)], "doc_id long, text string")).first()
    assert (got.n_base, got.labels, got.last_word) == (50_001, "cc-by-nc,mit", 150_001)
