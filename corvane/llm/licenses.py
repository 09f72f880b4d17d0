"""License scan: fixed phrases, and an exact set-similarity join of text blocks with license templates."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import id_and_text, ship
from corvane.shared import written

# The phrases that make base labels.
PHRASES = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}
# Well-known notices of public licenses, the templates of the join.
TEMPLATES = {
    "mit": (
        "released under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    ),
    "apache-2": (
        "Licensed under the Apache License, Version 2.0",
        "You may obtain a copy of the License at apache.org/licenses/LICENSE-2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    "gpl-2": (
        "licensed under the GNU General Public License, version 2",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License",
    ),
    "gpl-3": (
        "licensed under the GNU General Public License, version 3",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
    ),
    "gpl": ("You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>",),
    "lgpl": ("you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",),
    "cc-by-nc": ("Licensed under CC BY-NC 4.0", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    "cc-by-sa": ("licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software",
    ),
    "mpl-2": ("subject to the terms of the Mozilla Public License, v. 2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    "all-rights-reserved": ("All rights reserved",),
}
# What tells a label's templates from notices of other licenses; a block needs those that a template has, word by word.
DISTINGUISHING = {
    "mit": ("associated documentation files", "substantial portions"), "apache-2": ("apache org", "license 2 0"), "gpl-2": ("gnu general public license", "version 2"),
    "gpl-3": ("gnu general public license", "version 3"), "gpl": ("gnu general public license",), "lgpl": ("gnu lesser general public license",),
    "bsd": ("source and binary forms", "endorse or promote products"), "mpl-2": ("mozilla public license v 2 0",),
}
#: Templates of fewer words count only where their words stand one after the other: a share of so few words says little.
SHORT_WORDS = 12
THRESHOLD = 0.8
#: A text block is a window of so many words of the whole text, line ends or not; each half is covered by the next, so that every
#: run of 33 words lies in one block. No template is longer.
BLOCK_WORDS = 64
_WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(raw: bytes) -> list[bytes]:
    """Words of lower-cased UTF-8 bytes: runs of digits, letters and bytes of other characters."""
    return _WORDS.findall(raw)


def blocks_of(words: list[bytes], block_words: int) -> Iterator[tuple[int, list[bytes]]]:
    """(place of the first word, words) of each text block."""
    for lo in range(0, max(1, len(words) - block_words // 2), block_words // 2):
        yield lo, words[lo : lo + block_words]


@dataclass
class TemplateIndex:
    """Templates as token sets in one global order, rarest first, and an inverted index of their prefixes.

    A block holding at least need = ceil(threshold * size) of a template's tokens has one of its first size - need + 1 tokens;
    that's the prefix filter. Blocks with fewer than need known tokens are dropped (length filter), and so are pairs whose first
    common token lies too late in either order for need tokens to remain (positional filter). What passes is counted exactly.
    """

    labels: list[str]
    sets: list[list[bytes]]
    need: list[int]
    rank: dict[bytes, int]
    prefix: dict[bytes, list[tuple[int, int]]]

    @classmethod
    def build(cls, templates: Mapping[str, Sequence[str]], threshold: float, frequency: Mapping[bytes, int]) -> TemplateIndex:
        pairs = [(label, set(words_of(t.encode().lower()))) for label, ts in templates.items() for t in ts]
        pairs = [(label, s) for label, s in pairs if s]
        order = sorted(set().union(*(s for _, s in pairs)), key=lambda w: (frequency.get(w, 0), w))
        rank = {w: k for k, w in enumerate(order)}
        sets = [sorted(s, key=rank.__getitem__) for _, s in pairs]
        need = [max(1, -int(-threshold * len(s) // 1)) for s in sets]
        prefix: dict[bytes, list[tuple[int, int]]] = {}
        for t, (s, n) in enumerate(zip(sets, need, strict=True)):
            for i in range(len(s) - n + 1):
                prefix.setdefault(s[i], []).append((t, i))
        return cls([label for label, _ in pairs], sets, need, rank, prefix)

    def search(self, words: list[bytes]) -> list[tuple[int, float]]:
        """(template, containment) of every template that the block meets."""
        if self.prefix.keys().isdisjoint(words):
            return []
        known = sorted(self.rank.keys() & set(words), key=self.rank.__getitem__)
        seen: set[int] = set()
        out = []
        for j, w in enumerate(known):
            for t, i in self.prefix.get(w, ()):
                if t in seen or len(known) < self.need[t]:
                    continue
                seen.add(t)  # w is the first common token: an earlier one would be in the prefix, too
                if 1 + min(len(self.sets[t]) - i - 1, len(known) - j - 1) < self.need[t]:
                    continue
                common = len(set(self.sets[t]).intersection(known))
                if common >= self.need[t]:
                    out.append((t, common / len(self.sets[t])))
        return out


def _phrases(words: list[bytes], phrases: Mapping[str, bytes]) -> list[tuple[int, str]]:
    line = b" " + b" ".join(words) + b" "
    found = []
    for label, phrase in phrases.items():
        at, seen, place = line.find(phrase), 0, 0
        while at >= 0:
            place += line.count(b" ", seen, at)  # from the hit before, so that many hits cost no more than the text's length
            seen = at
            found.append((place, label))
            at = line.find(phrase, at + 1)
    return found


def split_templates(templates: Mapping[str, Sequence[str]], short_words: int) -> tuple[dict[str, list[str]], list[tuple[str, bytes]]]:
    """(templates for the join, (label, phrase) of the short ones)."""
    long: dict[str, list[str]] = {}
    short = []
    for label, ts in templates.items():
        for t in ts:
            words = words_of(t.encode().lower())
            if len(words) < short_words:
                short.append((label, b" " + b" ".join(words) + b" "))
            else:
                long.setdefault(label, []).append(t)
    return long, short


def required_phrases(templates: Mapping[str, Sequence[str]], distinguishing: Mapping[str, Sequence[str]]) -> list[list[bytes]]:
    """For each template, in order, the distinguishing phrases of its label that it has itself."""
    out = []
    for label, ts in templates.items():
        for t in ts:
            line = b" " + b" ".join(words_of(t.encode().lower())) + b" "
            if line.strip():
                out.append([p for x in distinguishing.get(label, ()) if (p := b" " + b" ".join(words_of(x.encode().lower())) + b" ") in line])
    return out


def license_scan(
    docs: DataFrame, phrases: Mapping[str, str] = PHRASES, templates: Mapping[str, Sequence[str]] = TEMPLATES,
    threshold: float = THRESHOLD, block_words: int = BLOCK_WORDS, id_col: str = "doc_id", text_col: str = "text",
    distinguishing: Mapping[str, Sequence[str]] = DISTINGUISHING, short_words: int = SHORT_WORDS,
) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, matches of every row.

    Base labels come from phrases whose words stand one after the other. The method adds the labels of all templates that some
    text block holds to the threshold (share of the template's distinct words) together with the distinguishing phrases that the
    template has; templates of under short_words words are found as phrases only, with a containment of 1. Tokens are ordered by the number of rows of docs
    that hold them, counted over all rows first. Blocks are windows over the words of the whole text, so a notice wrapped over lines
    is found. score is 1 with a base label, else the best containment found, else 0. matches lists (label, first_word, containment)
    of the blocks.

    Null and empty texts have no words, no labels (empty strings), null places and a score of 0. Rows are judged one by one, so null
    or repeated identifiers don't matter. Other columns aren't read, whatever their names. The time for a text is in proportion to
    its length, however often a phrase stands in it. An empty table gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = id_and_text(docs, id_col, text_col)
    templates, short = split_templates(templates, short_words)
    vocabulary = {w for ts in templates.values() for t in ts for w in words_of(t.encode().lower())}

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = dict.fromkeys(vocabulary, 0)
        for batch in batches:
            for text in batch["text"].array:
                for w in vocabulary.intersection(words_of(text.encode().lower())):
                    total[w] += 1
        yield pd.DataFrame({"word": [w.decode() for w in total], "n": list(total.values())})

    counted = rows.select("text").mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    frequency = {r.word.encode(): r.n for r in written(counted, "license-words").collect()}  # as many rows as the templates have words
    index = TemplateIndex.build(templates, threshold, frequency)
    required = required_phrases(templates, distinguishing)
    wanted = {label: b" " + b" ".join(words_of(p.encode().lower())) + b" " for label, p in phrases.items()}
    rare = [max(p.split(), key=len) for p in wanted.values()]
    rare_short = [max(p.split(), key=len) for _, p in short]

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch["text"].array:
                raw = text.encode().lower()
                words = words_of(raw)
                base = _phrases(words, wanted) if any(w in raw for w in rare) else []
                matches = []
                for w, (label, phrase) in zip(rare_short, short, strict=True):
                    if w in raw:
                        matches += [(label, at, 1.0) for at, _ in _phrases(words, {label: phrase})]
                if not index.prefix.keys().isdisjoint(words):
                    for at, block in blocks_of(words, block_words):
                        hits = index.search(block)
                        line = b" " + b" ".join(block) + b" " if hits else b""
                        matches += [(index.labels[t], at, c) for t, c in hits if all(p in line for p in required[t])]
                own = {label for _, label in base}
                out.append((
                    len(words), len(base), min((k for k, _ in base), default=None), max((k for k, _ in base), default=None),
                    ",".join(sorted(own)), ",".join(sorted(own | {m[0] for m in matches})),
                    1.0 if base else max((m[2] for m in matches), default=0.0),
                    [{"label": a, "first_word": b, "containment": c} for a, b, c in matches],
                ))
            got = pd.DataFrame(out, columns=["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches"])
            got.insert(0, "doc_id", batch["doc_id"].astype("Int64").array)
            yield got.astype({"first_word": "Int64", "last_word": "Int64"})

    return rows.mapInPandas(
        scan,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
        "matches array<struct<label: string, first_word: long, containment: double>>",
    )
