"""Token counts of byte-level pair encoding, by merging all sequences of a batch at once in numpy arrays."""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import id_and_text, resident, ship

#: Entries that a worker's cache of counted pre-tokens holds (some 60 MB at most).
CACHE_ENTRIES = 400_000
#: Texts whose pre-tokens are merged together.
TOGETHER = 64
NEVER = np.int64(1 << 40)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes for themselves, others from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(others)}


class PairCounter:
    """Counts the tokens of texts under the pair ranks of a tokenizer.

    Texts of characters below U+0180 are cut into pre-tokens by a pattern here, all others by the tokenizer's own pre-tokenizer, since
    Unicode tables of different versions disagree on what a letter is.
    """

    def __init__(self, prepared: dict, most: int = CACHE_ENTRIES):
        from tokenizers import Tokenizer

        self.size, self.keys, self.ranks, self.made, self.first = (prepared[k] for k in ("size", "keys", "ranks", "made", "first"))
        special = sorted(prepared["special"], key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.cutter = Tokenizer.from_str(prepared["cutter"]).pre_tokenizer
        of = {k: "".join(re.escape(chr(c)) for c in range(0x180) if unicodedata.category(chr(c))[0] == k) for k in "LN"}
        white = r"\t-\r \x85\xa0"
        self.split_latin = re.compile(
            rf" ?[{of['L']}]+|'(?:s|t|re|ve|m|ll|d)| ?[{of['N']}]+| ?[^{white}{of['L']}{of['N']}]+|[{white}]+(?![^{white}])|[{white}]+"
        ).findall
        self.other = re.compile("[^\0-\u017f]").search
        self.cache: dict[str, int] = {}
        self.most = most

    def split(self, text: str) -> list[str]:
        """The pre-tokens of any text, by the tokenizer's own rules."""
        return [text[a:b] for _, (a, b) in self.cutter.pre_tokenize_str(text)]

    @staticmethod
    def prepare(definition: str) -> dict:
        """Arrays of a definition (JSON text): keys of pairs in order with their ranks, the symbol that each rank makes, and each byte's symbol."""
        spec = json.loads(definition)
        vocabulary, merges = spec["model"]["vocab"], spec["model"]["merges"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        size = max(vocabulary.values()) + 1
        keys = np.array([vocabulary[a] * size + vocabulary[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        first = np.zeros(256, np.int64)
        for letter, byte in byte_letters().items():
            first[byte] = vocabulary[letter]
        made = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
        special = [t["content"] for t in spec.get("added_tokens", []) if t.get("special")]
        cutter = json.dumps(spec | {"added_tokens": [], "model": spec["model"] | {"vocab": {}, "merges": []}})
        return {"size": size, "keys": keys[order], "ranks": order.astype(np.int64), "made": made, "first": first, "special": special, "cutter": cutter}

    def _ranks(self, symbols: np.ndarray, owner: np.ndarray, at: np.ndarray) -> np.ndarray:
        after = np.minimum(at + 1, len(symbols) - 1)
        key = symbols[at] * self.size + symbols[after]
        where = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((owner[after] == owner[at]) & (after > at) & (self.keys[where] == key), self.ranks[where], NEVER)

    def merged(self, tokens: list[bytes]) -> np.ndarray:
        """The number of symbols that each token ends as.

        All tokens lie in one array of symbols. Each round finds each token's pair of lowest rank
        and merges its occurrences from the left, in all tokens at once; tokens without a pair left drop out.
        """
        counts = np.array([len(t) for t in tokens], np.int64)
        if not len(tokens):
            return counts
        symbols = self.first[np.frombuffer(b"".join(tokens), np.uint8)]
        owner = np.repeat(np.arange(len(tokens)), counts)
        rank = self._ranks(symbols, owner, np.arange(len(symbols)))  # of each symbol with the next
        while len(symbols) > 1:
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lowest = np.minimum.reduceat(rank, starts)
            low = np.repeat(lowest, np.diff(np.r_[starts, len(symbols)]))
            hit = (rank == low) & (rank < NEVER)
            # of pairs that overlap (one symbol repeated) every other one merges, from the left
            place = np.arange(len(hit))
            run = np.maximum.accumulate(np.where(hit & ~np.r_[False, hit[:-1]], place, 0))
            hit &= (place - run) % 2 == 0
            symbols = np.where(hit, self.made[np.where(hit, low, 0)], symbols)
            keep = ~np.r_[False, hit[:-1]] & (low < NEVER)
            np.subtract.at(counts, owner[hit], 1)
            symbols, owner, rank, new = symbols[keep], owner[keep], rank[keep], hit[keep]
            if len(symbols):
                again = np.flatnonzero(new | np.r_[new[1:], False])
                rank[again] = self._ranks(symbols, owner, again)
        return counts

    def count(self, texts: list[str]) -> list[int]:
        """The number of tokens of each text; a special string is one token."""
        split, extra = [], []
        for t in texts:
            parts = self.special.split(t) if self.special is not None and self.special.search(t) else [t]
            cut = self.split_latin if t.isascii() or not self.other(t) else self.split
            split.append(cut(t) if len(parts) == 1 else [w for p in parts for w in cut(p)])
            extra.append(len(parts) - 1)
        every = set().union(*split)
        new = every.difference(self.cache)
        if len(self.cache) + len(new) > self.most:
            self.cache.clear()
            new = every
        order = sorted(new)
        self.cache.update(zip(order, self.merged([w.encode() for w in order]).tolist(), strict=True))
        return [n + sum(map(self.cache.__getitem__, words)) for n, words in zip(extra, split, strict=True)]


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than limit tokens) of every row, over whole texts.

    Null and empty texts have 0 tokens. Rows are counted one by one, so null or repeated identifiers don't matter. Other columns
    aren't read, whatever their names. Very long texts are counted whole; a single pre-token costs its length times the number of
    its different pair ranks. An empty table gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    definition = Path(tokenizer_path).read_text(encoding="utf-8")  # what is broadcast of it is 1 MB, whatever the input
    key, shared = hashlib.sha256(definition.encode()).hexdigest(), spark.sparkContext.broadcast(PairCounter.prepare(definition))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = resident(("pairs", key), lambda: PairCounter(shared.value))
        for batch in batches:
            texts = batch["text"].tolist()
            counts = [n for at in range(0, len(texts), TOGETHER) for n in counter.count(texts[at : at + TOGETHER])]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].astype("Int64"), "n_bytes": batch["n_bytes"].astype("int64"), "n_tokens": np.array(counts, np.int64),
            })

    rows = id_and_text(docs, id_col, text_col).withColumn("n_bytes", F.octet_length("text").cast("long"))
    counted = rows.mapInPandas(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
