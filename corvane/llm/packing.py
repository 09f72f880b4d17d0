"""Best-two-fit packing of tokenised documents into sequences of fixed length."""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import id_and_text, resident, ship
from corvane.shared import written

#: Pieces that one task packs, about; with sequences several pieces long, a task's last sequences cost well under 0.1 %.
SHARD_PIECES = 16384
#: Entries that a worker's cache of encoded words holds (some 80 MB at most).
CACHE_ENTRIES = 400_000
#: Texts whose words are looked up together.
TOGETHER = 64


class WordEncoder:
    """Encodes texts with a tokenizer that lower-cases, drops white space and marks word ends, encoding repeated words once.

    Texts of Latin characters alone (below U+0180, where normal forms don't matter) are lower-cased and cut into the tokenizer's
    own words here; unknown words go to the tokenizer joined by spaces, and the tokens that end words show which ids are whose.
    Other texts, and those with a special string, are cut at spaces and newlines only and their parts encoded one by one: words
    never cross white space, and special strings have none.
    """

    def __init__(self, prepared: tuple[str, np.ndarray, list[str]], most: int = CACHE_ENTRIES):
        from tokenizers import Tokenizer

        definition, self.ends, self.special = prepared
        self.tokenizer, self.most = Tokenizer.from_str(definition), most
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.other = re.compile("[^\0-\u017f]").search
        kinds = {k: "".join(re.escape(chr(c)) for c in range(0x180) if unicodedata.category(chr(c))[0] == k) for k in "LN"}
        others = rf"[^\t-\r \x85\xa0{kinds['L']}{kinds['N']}]+"
        self.cut = re.compile(rf"[{kinds['L']}]+|'(?:s|t|re|ve|m|ll|d)|[{kinds['N']}]|{others}").findall

    @staticmethod
    def prepare(definition: str) -> tuple[str, np.ndarray, list[str]]:
        """What workers need of a definition (JSON text): itself, which ids end words, and the special strings."""
        spec = json.loads(definition)
        suffix = spec["model"].get("end_of_word_suffix") or "\0"
        vocabulary = spec["model"]["vocab"]
        ends = np.zeros(max(vocabulary.values()) + 1, bool)
        ends[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
        return definition, ends, [t["content"] for t in spec.get("added_tokens", [])]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        split: list[tuple[dict, list[str]]] = []
        for t in texts:
            if any(s in t for s in self.special) or not t.isascii() and self.other(t):
                split.append((self.parts, t.replace("\n", " ").split(" ")))
            else:
                split.append((self.words, self.cut(t.lower())))
        for cache, learn in ((self.words, self._learn_words), (self.parts, self._learn_parts)):
            all_ = set().union(*(w for c, w in split if c is cache))
            new = all_.difference(cache)
            if len(cache) + len(new) > self.most:
                cache.clear()
                new = all_
            learn(sorted(new))
        return [b"".join(map(cache.__getitem__, words)) for cache, words in split]

    def _learn_words(self, new: list[str]) -> None:
        lines = [" ".join(new[i : i + 1000]) for i in range(0, len(new), 1000)]
        got = self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)
        ids = np.concatenate([np.empty(0, "<u4"), *(np.array(x.ids, "<u4") for x in got)])
        stops = (4 * np.r_[0, np.flatnonzero(self.ends[ids]) + 1]).tolist()
        if len(stops) != len(new) + 1:  # the tokenizer doesn't mark the end of each of these words
            for word, got in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False), strict=True):
                self.words[word] = np.asarray(got.ids, "<u4").tobytes()
            return
        flat = ids.astype("<u4").tobytes()
        for word, i, j in zip(new, stops[:-1], stops[1:], strict=True):
            self.words[word] = flat[i:j]

    def _learn_parts(self, new: list[str]) -> None:
        for part, got in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False), strict=True):
            self.parts[part] = np.asarray(got.ids, "<u4").tobytes()


def tokenized_pieces(
    docs: DataFrame, tokenizer_path: str, length: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids, binary) of the pieces of every document's ids and its end id."""
    spark = docs.sparkSession
    ship(spark)
    definition = Path(tokenizer_path).read_text(encoding="utf-8")  # a few MB, whatever the input
    key, shared = hashlib.sha256(definition.encode()).hexdigest(), spark.sparkContext.broadcast(WordEncoder.prepare(definition))
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = resident(("words", key), lambda: WordEncoder(shared.value))
        for batch in batches:
            rows = []
            texts = batch["text"].tolist()
            every = (ids for at in range(0, len(texts), TOGETHER) for ids in encoder.encode(texts[at : at + TOGETHER]))
            for doc_id, ids in zip(batch["doc_id"].array, every, strict=True):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * length)):
                    part = ids[at : at + 4 * length]
                    rows.append((doc_id, k, k * length, len(part) // 4, zlib.crc32(part), part))
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out if with_ids else out.drop(columns="ids")

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return id_and_text(docs, id_col, text_col).mapInPandas(cut, schema)


def best_two_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each item; lengths are 1 to capacity.

    Each bin takes the longest items that fit until none does. Then its smallest item gives way to two unpacked ones if they fill
    the gap that it leaves better than it did, the two that fill it best, and the bin is filled again.
    """
    order = np.argsort(lengths, kind="stable")
    sizes, firsts, counts = np.unique(lengths[order], return_index=True, return_counts=True)
    stacks = {int(s): order[f : f + c].tolist() for s, f, c in zip(sizes, firsts, counts, strict=True)}
    left = sizes.tolist()  # the sizes that have unpacked items, ascending
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)

    def take(size: int) -> int:
        item = stacks[size].pop()
        if not stacks[size]:
            del left[bisect_left(left, size)]
        return item

    def give(size: int, item: int) -> None:
        if not stacks[size]:
            left.insert(bisect_left(left, size), size)
        stacks[size].append(item)

    n = 0
    while left:
        held: list[tuple[int, int]] = []
        gap = capacity
        while True:
            while left and left[0] <= gap:
                size = left[bisect_right(left, gap) - 1]
                held.append((size, take(size)))
                gap -= size
            if not gap or not left or len(held) < 2:
                break
            at = min(range(len(held)), key=lambda i: held[i][0])
            small, item = held[at]
            room = gap + small
            d = np.asarray(left)
            d = d[: np.searchsorted(d, room, "right")]
            mate = np.searchsorted(d, room - d, "right") - 1
            alone = (mate >= 0) & (d[mate] == d) & (np.fromiter((len(stacks[x]) < 2 for x in d.tolist()), bool, len(d)))
            mate = mate - alone
            total = np.where(mate >= 0, d + d[mate], 0)
            best = int(total.argmax()) if len(total) else -1
            if best < 0 or total[best] <= small:
                break
            held.pop(at)
            for size in (int(d[best]), int(d[mate[best]])):
                held.append((size, take(size)))
            give(small, item)
            gap = room - int(total[best])
        at = 0
        for size, item in held:
            bins[item], offsets[item] = n, at
            at += size
        n += 1
    return bins, offsets


def pack(pieces: DataFrame, length: int = 4096, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """pieces, which have a column length, with sequence_id and offset: their place in sequences of at most `length` tokens.

    The rows are dealt evenly, by a hash of their place in the written table, to as many shards as hold shard_pieces each, and each
    shard is packed by itself; a shard's memory doesn't grow with the input, nor does any key's share of the rows matter.
    """
    ship(pieces.sparkSession)
    numbered = written(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    shards = max(1, -(-numbered.count() // shard_pieces))
    dealt = numbered.withColumn("_shard", F.pmod(F.xxhash64("_row"), F.lit(shards)))

    def fill(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values("_row", ignore_index=True)
        bins, offsets = best_two_fit(shard["length"].to_numpy(), length)
        shard["sequence_id"] = shard["_shard"].to_numpy() * (1 << 32) + bins
        shard["offset"] = offsets
        return shard.drop(columns=["_row", "_shard"])

    names = [f.name for f in pieces.schema.fields]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    packed = dealt.groupBy("_shard").applyInPandas(fill, f"{schema}, sequence_id long, offset long")
    return packed.select(*[F.col(f"`{n}`") for n in names], "sequence_id", "offset")


def pack_documents(docs: DataFrame, tokenizer_path: str, length: int = 4096, end_id: int = 1, **how) -> DataFrame:
    """Tokenises docs, cuts what is longer than a sequence into pieces and packs them: one row a piece.

    A document's ids end with end_id. Null and empty texts are that id alone. Repeated rows are packed each; null identifiers stay
    null. An empty table gives no rows. With with_ids=True each row has its ids too.
    """
    return pack(tokenized_pieces(docs, tokenizer_path, length, end_id, **how), length)
