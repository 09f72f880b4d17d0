"""Fuzzy matching of names: candidates by the rare tokens that a score needs, weighted overlap scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.functions.text import bigrams, words
from corvane.operators.relational import small
from corvane.shared import written

UNKNOWN_WEIGHT = 0.2
LEAST_SCORE = 75.0


def _onward(tokens: DataFrame, name: str) -> DataFrame:
    """tokens (name, t, w, n) with left_over, the weight of a name's tokens from this one on, in the order of (n, t)."""
    onward = Window.partitionBy(name).orderBy("n", "t").rowsBetween(Window.currentRow, Window.unboundedFollowing)  # over a name's tokens
    return tokens.withColumn("left_over", F.sum("w").over(onward))


def scoring_pairs(a: DataFrame, b: DataFrame, least: float) -> DataFrame:
    """(a_id, b_id) of all names that can score above least, and of others that share a rare token.

    a and b have weighted tokens (a_id, a_tw), (b_id, b_tw); weights are 0 or more. A score over least takes shared tokens of more
    than least / 200 of both names' weight. So names are joined by their tokens from the one that the fewest right names have
    on, until those left over weigh no more than that part of the name: the first token that a pair shares is among them on either
    side, and frequent tokens, which would pair very many names, are hardly ever reached. A left name's repeats count each time, a
    right name's tokens once, so left names with repeats meet all tokens of right names. Right names too heavy for the score
    are left out. No pair is lost.
    """
    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda s, x: s + x["w"])
    theirs = b.select("b_id", total("b_tw").alias("b_w"), F.explode("b_tw").alias("x")).groupBy("b_id", "b_w", F.col("x.t").alias("t")).agg(F.max("x.w").alias("w"))
    counts = theirs.groupBy("t").agg(F.count("*").alias("n"))
    theirs = _onward(theirs.join(counts, "t"), "b_id").withColumn("rare", 200 * F.col("left_over") > least * F.col("b_w") * (1 - 1e-9)).select("b_id", "b_w", "t", "rare")
    mine = a.select("a_id", total("a_tw").alias("a_w"), F.explode("a_tw").alias("x"))
    mine = mine.groupBy("a_id", "a_w", F.col("x.t").alias("t")).agg(F.sum("x.w").alias("w"), F.count("*").alias("times"))
    mine = mine.withColumn("repeats", F.max("times").over(Window.partitionBy("a_id")) > 1).join(counts, "t")
    mine = _onward(mine, "a_id").filter(200 * F.col("left_over") > least * F.col("a_w") * (1 - 1e-9)).select("a_id", "a_w", "t", "repeats")
    heavy = least * (F.col("a_w") + F.col("b_w")) > 200 * F.col("a_w") * (1 + 1e-9)
    pairs = mine.filter("not repeats").join(theirs.filter("rare"), "t").unionByName(mine.filter("repeats").join(theirs, "t"))
    return pairs.filter(~heavy).select("a_id", "b_id")


def weighted_tokens(names: DataFrame, weights: DataFrame, tokens: Column, token_col: str) -> DataFrame:
    """(id, tw): each name's token occurrences with their weights; tokens without one weigh 0.2."""
    exploded = names.select("id", F.posexplode_outer(tokens).alias("pos", token_col))
    joined = exploded.join(weights.select(token_col, "weight"), token_col, "left")
    item = F.struct("pos", F.col(token_col).alias("t"), F.coalesce("weight", F.lit(UNKNOWN_WEIGHT)).alias("w"))
    return joined.groupBy("id").agg(F.array_sort(F.collect_list(F.when(F.col(token_col).isNotNull(), item))).alias("tw"))


def overlap(a: Column, b: Column) -> Column:
    """Twice the weight of a's occurrences whose token is in b, over the weight of all occurrences of both; 0 without any.

    Occurrences count, not distinct tokens: with repeats the score depends on the side and can pass 1.
    """
    zero = F.lit(0.0)
    total = lambda xs: F.aggregate(xs, zero, lambda s, x: s + x["w"])
    tokens = F.transform(b, lambda x: x["t"])
    shared = F.aggregate(F.filter(a, lambda x: F.array_contains(tokens, x["t"])), zero, lambda s, x: s + x["w"])
    whole = total(a) + total(b)
    return F.when(whole > 0, 2 * shared / whole).otherwise(zero)


def location_score(cc_a: Column, sc_a: Column, cc_b: Column, sc_b: Column, w_country: Column, w_subdivision: Column) -> Column:
    """25 where a country is unknown, 0 where countries differ, else 100 times the country's weight and, if equal, the subdivision's."""
    both = F.when(sc_a == sc_b, w_subdivision).otherwise(F.lit(0.0))
    return F.when(cc_a.isNull() | cc_b.isNull(), F.lit(25.0)).when(cc_a == cc_b, 100 * (w_country + both)).otherwise(F.lit(0.0))


def fuzzy_matches(
    left: DataFrame, right: DataFrame, word_weights: DataFrame, bigram_weights: DataFrame, stop: DataFrame,
    least: float = LEAST_SCORE, substring: bool = False, kinds: Sequence[str] = ("term", "bigram"),
) -> DataFrame:
    """(a_id, b_id, match_type, score) of pairs scoring above least; equal names score 100.

    left and right have (id, name), compared in lower case; stop has (word). Each pair is scored by words and by bigrams (kinds) and
    may give two rows. A right name is a candidate if it has a word of the left name outside the stop list, or, with substring, if such a word
    stands anywhere in it; for a left name made of stop terms only all right names are. Candidates are found by the rare tokens that
    a score over least needs, in either mode, so there's no loop over pairs of names.
    """
    low = lambda d: d.select("id", F.lower("name").alias("name"))
    left, right = low(left), low(right)
    rare = left.select("id", F.explode(F.array_distinct(words(F.col("name")))).alias("word")).join(small(stop), "word", "left_anti")
    a_names = left.join(rare.groupBy("id").agg(F.collect_list("word").alias("a_rare")), "id", "left").withColumnsRenamed({"id": "a_id", "name": "a_name"})
    b_names = right.select(F.col("id").alias("b_id"), F.col("name").alias("b_name"), words(F.col("name")).alias("b_words"))
    equal = a_names.select("a_id", "a_name").join(b_names, F.col("a_name") == F.col("b_name")).select("a_id", "b_id")
    shared = F.exists("a_rare", lambda w: F.contains(F.col("b_name"), w)) if substring else F.arrays_overlap("a_rare", "b_words")
    out = None
    for kind, weights, token, of in (("term", word_weights, "word", words), ("bigram", bigram_weights, "bigram", bigrams)):
        if kind not in kinds:
            continue
        # written, since each is read three times
        a = written(weighted_tokens(left, weights, of(F.col("name")), token).select(F.col("id").alias("a_id"), F.col("tw").alias("a_tw")), "left-tokens")
        b = written(weighted_tokens(right, weights, of(F.col("name")), token).select(F.col("id").alias("b_id"), F.col("tw").alias("b_tw")), "right-tokens")
        pairs = scoring_pairs(a, b, least).unionByName(equal).distinct()
        named = pairs.join(a_names, "a_id").join(b_names, "b_id").filter(F.col("a_rare").isNull() | shared)
        score = F.when(F.col("a_name") == F.col("b_name"), F.lit(100.0)).otherwise(100 * overlap(F.col("a_tw"), F.col("b_tw")))
        scored = named.join(a, "a_id").join(b, "b_id").select("a_id", "b_id", F.lit(kind).alias("match_type"), score.alias("score"))
        scored = scored.filter(F.col("score") > least)
        out = scored if out is None else out.unionByName(scored)
    return out
