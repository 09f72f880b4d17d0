"""Near duplicates by SimHash fingerprints, joined through vantage-point trees."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import connected_components, id_and_text, may_match, ship, whole_row
from corvane.llm.forest import Forest
from corvane.shared import written

#: The upper tree is fitted on a sample of so many fingerprints, or of so many for each shard if that's more; all are indexed.
SAMPLE, SAMPLE_OF_SHARD = 16384, 64
#: A shard has about so many fingerprints of its own, or this factor times the square root of all if that's more: each level of the
#: tree adds guests, so shards grow along with their number.
SHARD_ROWS, SHARD_ROOT = 16384, 64
#: Vantage points that are tried for a split, the quantiles that they split at, and the part of the points that neither side may have.
TRIES, CUTS, HEADWAY = 6, (0.3, 0.5, 0.7), 0.9
LEAF_ROWS = 512
_SPREAD = np.array([sum(((b >> k) & 1) << (8 * k) for k in range(8)) for b in range(256)], np.uint64)


def fingerprints(texts: list[str], words: int, seed: int) -> np.ndarray:
    """The 64-bit fingerprints of texts, unsigned."""
    from xxhash import xxh64_intdigest

    hashes, counts = [], []
    for text in texts:
        parts = text.encode().lower().split()
        if not parts:
            counts.append(0)
            continue
        line = b" ".join(parts)
        ends = np.cumsum([len(p) + 1 for p in parts]) - 1
        starts = np.r_[0, ends[:-1] + 1]
        k = min(words, len(parts)) - 1
        got = [xxh64_intdigest(line[a:b], seed) for a, b in zip(starts[: len(starts) - k].tolist(), ends[k:].tolist(), strict=True)]
        counts.append(len(got))
        hashes.append(np.array(got, np.uint64))
    n = np.array(counts, np.int64)
    out = np.zeros(len(n), np.uint64)
    some = np.flatnonzero(n)
    if not len(some):
        return out
    flat = np.concatenate(hashes).view(np.uint8).reshape(-1, 8)  # byte 0 is the lowest
    # up to 255 hashes are added in 8-bit lanes, then the lanes
    sizes = n[some]
    blocks = -(-sizes // 255)
    first = np.r_[0, np.cumsum(sizes)[:-1]]
    at_doc = np.repeat(np.arange(len(some)), blocks)
    nth = np.arange(len(at_doc)) - np.r_[0, np.cumsum(blocks)[:-1]][at_doc]
    cuts, docs = first[at_doc] + 255 * nth, np.r_[0, np.cumsum(blocks)[:-1]]
    for k in range(8):
        lanes = np.add.reduceat(_SPREAD[flat[:, k]], cuts).view(np.uint8).reshape(-1, 8).astype(np.int64)
        ones = np.add.reduceat(lanes, docs, axis=0)
        for j in range(8):
            out[some] |= (2 * ones[:, j] > sizes).astype(np.uint64) << np.uint64(8 * k + j)
    return out


@dataclass
class Node:
    vantage: int
    middle: int
    near: Node | int  # a number is a shard
    far: Node | int


def upper_tree(sample: np.ndarray, scale: float, most: int, radius: int) -> Node | int:
    """A vantage-point tree whose shards are numbered from 0; each point of the sample stands for `scale` fingerprints.

    A node is split until it holds `most` fingerprints or fewer, guests aside. Of some vantage points and distances the split with
    the fewest guests for its balance is taken. A node that no split makes much smaller on both sides stays a shard.
    """
    taken = iter(range(1 << 62))

    def grow(own: np.ndarray, guests: np.ndarray) -> Node | int:
        best = None
        if len(own) * scale > most and len(own) > 1:
            for vantage in own[np.linspace(0, len(own) - 1, min(TRIES, len(own))).astype(int)]:
                d = np.bitwise_count(own ^ vantage).astype(np.int64)
                g = np.bitwise_count(guests ^ vantage).astype(np.int64)
                for middle in sorted({int(np.quantile(d, q)) for q in CUTS} | {int(d.max()) - 1}):
                    near = int((d <= middle).sum())
                    left = near + int((g - radius <= middle).sum())
                    right = len(own) - near + int((g + radius > middle).sum()) + int(((d <= middle) & (d + radius > middle)).sum())
                    if 0 < near < len(own) and max(near, len(own) - near) <= max(HEADWAY * len(own), len(own) - 1 if len(own) < 20 else 0):
                        cost = left * left + right * right
                        if best is None or cost < best[0]:
                            best = cost, vantage, middle, d, g
        if best is None:
            return next(taken)
        _, vantage, middle, d, g = best
        near = d <= middle
        first = grow(own[near], guests[g - radius <= middle])
        return Node(int(vantage), middle, first, grow(own[~near], np.r_[guests[g + radius > middle], own[near & (d + radius > middle)]]))

    return grow(sample, np.empty(0, np.uint64))


def route(tree: Node | int, prints: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, residents, guests) as places in prints.

    Each fingerprint is a resident of one shard. One on the near side of a split whose ball of the radius crosses the boundary is
    also a guest on the far side, and guests follow every side that their ball reaches; so of any two within the radius that live
    in different shards, exactly one is a guest where the other lives, by the triangle inequality.
    """
    stack = [(tree, np.arange(len(prints)), np.empty(0, np.int64))]
    while stack:
        node, own, guests = stack.pop()
        if not len(own) and not len(guests):
            continue
        if not isinstance(node, Node):
            yield node, own, guests
            continue
        d = np.bitwise_count(prints[own] ^ np.uint64(node.vantage)).astype(np.int64)
        g = np.bitwise_count(prints[guests] ^ np.uint64(node.vantage)).astype(np.int64)
        near = d <= node.middle
        stack.append((node.near, own[near], guests[g - radius <= node.middle]))
        stack.append((node.far, own[~near], np.r_[guests[g + radius > node.middle], own[near & (d + radius > node.middle)]]))


def linked(own: np.ndarray, guests: np.ndarray, radius: int, leaf: int = LEAF_ROWS) -> np.ndarray:
    """The root (a place in own, then guests) of each place, where pairs of own and own, or own and guests, within the radius are joined.

    A vantage-point tree is grown over own and searched for all at once: a split sends every query to the sides its ball reaches.
    """
    prints = np.r_[own, guests]
    forest = Forest(len(prints))
    stack = [(np.arange(len(own)), np.arange(len(own), len(prints)))]
    while stack:
        here, asked = stack.pop()
        if not len(here):
            continue
        if len(here) > leaf:
            vantage = prints[here[len(here) // 2]]
            d = np.bitwise_count(prints[here] ^ vantage).astype(np.int64)
            middle = int(np.median(d))
            if middle == d.max():
                middle -= 1
            near = d <= middle
            if near.any():
                g = np.bitwise_count(prints[asked] ^ vantage).astype(np.int64)
                stack.append((here[near], asked[g - radius <= middle]))
                stack.append((here[~near], np.r_[asked[g + radius > middle], here[near & (d + radius > middle)]]))
                continue
        both = np.r_[here, asked]
        for i in range(0, len(here), leaf):
            rows = here[i : i + leaf]
            for j in range(i, len(both), 4096):
                cols = both[j : j + 4096]
                x, y = np.nonzero(np.bitwise_count(prints[rows][:, None] ^ prints[cols][None, :]) <= radius)
                x, y = rows[x], cols[y]
                forest.add(x[x != y], y[x != y])
    return forest.roots(np.arange(len(prints)))


def near_duplicate_prints(distinct: DataFrame, radius: int = 3, shard_rows: int = SHARD_ROWS, sample: int = SAMPLE) -> DataFrame:
    """(node, component) of the fingerprints in distinct (column fp, long) that are within the radius of another."""
    n = distinct.count()
    most = max(shard_rows, int(SHARD_ROOT * np.sqrt(n)) if shard_rows >= SHARD_ROWS else 0)
    want = max(sample, SAMPLE_OF_SHARD * n // most)
    chosen = F.pmod(F.xxhash64("fp"), F.lit(1 << 30)) < F.lit(float(1 << 30)) * min(1.0, want / max(1, n))
    points = np.sort(distinct.filter(chosen).toPandas()["fp"].to_numpy(np.int64)) if n > most else np.empty(0, np.int64)
    points = np.random.default_rng(0).permutation(points).view(np.uint64)
    tree = upper_tree(points, n / max(1, len(points)), most, radius)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            prints = batch["fp"].to_numpy(np.int64)
            for shard, own, guests in route(tree, prints.view(np.uint64), radius):
                at = np.r_[own, guests]
                yield pd.DataFrame({"shard": shard, "fp": prints[at], "guest": np.repeat([False, True], [len(own), len(guests)])})

    def search(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values("fp")
        guest = shard["guest"].to_numpy(bool)
        prints = shard["fp"].to_numpy(np.int64)
        prints = np.r_[prints[~guest], prints[guest]]
        k = int((~guest).sum())
        root = linked(prints[:k].view(np.uint64), prints[k:].view(np.uint64), radius)
        hang = np.flatnonzero(root != np.arange(len(root)))
        return pd.DataFrame({"a": prints[hang], "b": prints[root[hang]]})

    dealt = distinct.mapInPandas(deal, "shard int, fp long, guest boolean")
    return connected_components(dealt.groupBy("shard").applyInPandas(search, "a long, b long"))


def simhash_dedup(
    docs: DataFrame, words: int = 3, radius: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text",
    shard_rows: int = SHARD_ROWS, sample: int = SAMPLE,
) -> DataFrame:
    """doc_id, fingerprint, component_id, kept of every row.

    Texts whose fingerprints differ in at most radius bits link; a component is all that links reach, named by its smallest
    doc_id, the one that's kept. Equal fingerprints are collapsed first. The distinct ones are dealt to shards by an upper
    vantage-point tree, with guests where a ball crosses a boundary, and each shard's tree finds the exact pairs; only a spanning
    forest of a shard's links leaves its task. Texts of any length are read whole.

    Null texts count as empty; texts without words have fingerprint zero and link like any other. Null identifiers belong to a
    component but never name one unless it has no other (component_id is null then, and they're kept). Rows that repeat the kept
    identifier are kept. An empty table gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)

    def prints(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 256):  # keeps the hashes of few texts at a time
                part = batch.iloc[at : at + 256]
                fp = fingerprints(part["text"].tolist(), words, seed).view(np.int64)
                yield pd.DataFrame({"doc_id": part["doc_id"].astype("Int64").array, "fp": fp})

    rows = written(id_and_text(docs, id_col, text_col).mapInPandas(prints, "doc_id long, fp long"), "prints")
    groups = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "print-groups")
    parts = near_duplicate_prints(groups.select("fp"), radius, shard_rows, sample)
    joined = groups.join(parts, F.col("fp") == F.col("node"), "left").filter("n > 1 or component is not null")
    joined = joined.withColumn("component", F.coalesce("component", "fp"))
    named = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    named = joined.join(named, "component").select(F.col("fp").alias("_fp"), "component_id", F.lit(True).alias("grouped"))
    out = rows.join(named, F.col("fp") == F.col("_fp"), "left")
    out = out.withColumn("component_id", F.when(F.col("grouped"), F.col("component_id")).otherwise(F.col("doc_id")))
    return out.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def representative_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, seed: int = 42, **how
) -> DataFrame:
    """The rows of docs that simhash_dedup() keeps: one document of each component.

    Rows that share an identifier (null included) are told apart by their fingerprints: one may stay for its own component where
    another goes. Rows without an identifier go where their component has one that names it, else all of them stay. Rows that repeat
    the kept identifier and fingerprint stay. Null texts count as empty; an empty table gives no rows. Rows that a filter of the
    dropped identifiers clears pass without being dealt out; only the others' fingerprints are made again.
    """
    judged = simhash_dedup(docs, words=words, seed=seed, id_col=id_col, text_col=text_col, **how)
    dropped = written(judged.filter("not kept").select("doc_id", "fingerprint").distinct(), "dropped")

    @F.pandas_udf("long")
    def prints(texts: pd.Series) -> pd.Series:
        parts = [fingerprints(texts.iloc[at : at + 256].tolist(), words, seed) for at in range(0, len(texts), 256)]
        return pd.Series(np.concatenate([np.zeros(0, np.uint64), *parts]).view(np.int64))

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_row(docs))
    rows = may_match(rows, dropped, ["doc_id"], dropped.count())
    text = F.coalesce(F.col("_row").getField(text_col), F.lit(""))
    maybe = rows.filter("_may").withColumn("fingerprint", F.lower(F.lpad(F.hex(prints(text)), 16, "0")))
    gone = dropped.select(F.col("doc_id").alias("_id"), F.col("fingerprint").alias("_fp"))
    # an outer join, since the optimizer moves an anti join below the filter, where all rows would be dealt out
    left = maybe.join(gone, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("fingerprint") == F.col("_fp")), "left").filter("_fp is null")
    return rows.filter("not _may").select("_row.*").unionByName(left.select("_row.*"))
