"""What the operators share: code shipping, filters of keys, components of a graph."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.shared import removed, ship, written  # noqa: F401  operators take ship from here


_RESIDENT: dict[tuple, Any] = {}


def resident(key: tuple, make: Callable[[], Any]) -> Any:
    """What make() gives, kept in this Python worker for later tasks with the same key.

    A worker keeps one such thing: workers outlive the operator that they were started for, and a tokenizer's cache would sit there
    while the next operator runs.
    """
    if key not in _RESIDENT:
        _RESIDENT.clear()
        _RESIDENT[key] = make()
    return _RESIDENT[key]


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns that matter, as doc_id and text; whatever other columns are called can't clash. Null text: empty."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def lower_ascii(text: Column) -> Column:
    """text with A-Z in lower case and nothing else changed; plain ASCII takes the faster built-in way."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


#: A bitmap filter of keys is broadcast and holds so many bytes at most. With 16 bits a key 6 % of other rows pass it, too; from
#: 17 million keys on there are fewer bits a key, and more of the others pass. What passes is joined, so results are the same.
FILTER_BYTES = 32 << 20
BITS_PER_KEY = 16
BITMAP_BITS = 32768  # of one row that bitmap_construct_agg makes


def may_match(rows: DataFrame, wanted: DataFrame, keys: list[str], n_wanted: int, limit: int = FILTER_BYTES) -> DataFrame:
    """rows with a column _may: false only where the keys are surely not among those of wanted, which has n_wanted rows.

    The filter is a bitmap of 16 bits a key, fewer where the limit asks for it, made by aggregation and broadcast.
    """
    buckets = max(1, min(-(-n_wanted * BITS_PER_KEY // BITMAP_BITS), limit * 8 // BITMAP_BITS))
    slot = F.pmod(F.xxhash64(*keys), F.lit(buckets * BITMAP_BITS))
    maps = (
        wanted.select(slot.alias("s")).groupBy(F.expr("s div 32768").alias("_bucket"))
        .agg(F.bitmap_construct_agg(F.expr("s % 32768")).alias("_bits"))
    )
    at = rows.withColumn("_slot", slot).withColumn("_bucket", F.expr("_slot div 32768"))
    byte = "cast(conv(hex(substring(_bits, cast((_slot % 32768) div 8 + 1 as int), 1)), 16, 10) as int)"
    marked = at.join(F.broadcast(maps), "_bucket", "left")
    marked = marked.withColumn("_may", F.expr(f"_bits is not null and (shiftright({byte}, cast(_slot % 8 as int)) & 1) = 1"))
    return marked.drop("_slot", "_bucket", "_bits")


def whole_row(df: DataFrame):
    """All columns as one struct, _row, so that no name can clash; select("_row.*") gives them back."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) of every node of edges (a, b); the component is its smallest node.

    Alternates two steps until no edge changes (Kiveris et al., "Connected Components in MapReduce and Beyond", 2014): each node
    links its larger neighbours to its smallest neighbour, then its smaller neighbours to the smallest one. The rounds grow
    with the logarithm of the longest path. Every round's edges are written to the shared folder, to as many files as they need,
    and the round's before are removed. Minima are aggregated before the shuffle, and the joins may be split by the adaptive
    planner where a node has very many edges.
    """
    now = written(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc-edges"
    )
    n, before = now.count(), None
    for _ in range(most_rounds):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = (
            both.filter("b > a").join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
            .filter("a <> b").distinct()
        )
        low = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
        small = large.join(low, F.col("a") == F.col("u"))
        moved = small.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        last, now = now, written(moved.unionByName(small.select("a", F.col("m").alias("b"))).distinct(), "cc-edges", most_rows=n)
        removed(last)
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        n = mark[0]
        if tuple(mark) == before:
            break
        before = tuple(mark)
    else:
        raise RuntimeError("the components didn't settle")
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
