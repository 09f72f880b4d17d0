"""Mixing sources to target weights by Pareto order sampling. DataFrame operations only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.llm.common import whole_row
from corvane.shared import written

WORDS = r"[^\x20\x09-\x0D]+"
#: Rows of each source are counted in so many bins of their rank; the bin that the end falls in is counted in as many again, until it
#: has so few rows that they are sorted.
BINS, BIN_ROWS = 4096, 4096
_PLACES = 1 << 52  # whole numbers that stand for ranks
#: The table of sources is broadcast up to so many rows (under 100 bytes each); beyond, it's joined by a shuffle.
MOST_SOURCES = 200_000


def _uniform(seed: int, key: Column) -> Column:
    """A number strictly between 0 and 1 that depends on seed and key alone: 52 bits of an MD5 digest."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def _running(rows: DataFrame, order: Sequence[str], sums: dict[str, str]) -> DataFrame:
    """rows with, for each (name: column) of sums, the sum of the column over this row and those before it in the order.

    Rows are dealt to ranges of the order; a range adds up its own rows, and the totals of the ranges before are added. No task sees
    all rows, and the driver none.
    """
    dealt = written(rows.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()), "ranges")
    totals = dealt.groupBy("_p").agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    parts = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # over as many rows as there are ranges
    before = totals.select(F.col("_p").alias("_q"), *[F.coalesce(F.sum(n).over(parts), F.lit(0.0)).alias(f"_b{n}") for n in sums])
    within = Window.partitionBy("_p").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = dealt.join(F.broadcast(before), F.col("_p") == F.col("_q"))
    return out.withColumns({n: F.sum(c).over(within) + F.col(f"_b{n}") for n, c in sums.items()}).drop("_p", "_q", *[f"_b{n}" for n in sums])


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float, most_sources: int = MOST_SOURCES) -> DataFrame:
    """source, source_size, source_rows, target: share times all sizes, dealt by weight, but no more than most times a source's size.

    Weights repeat over the sources by code point, null last. With caps, targets are min(cap, level * weight); the level is the
    largest over all prefixes of the sources ordered by cap / weight of (total - caps in the prefix) / (weights after it),
    because the capped sum is the least of those straight lines. Up to most_sources sources are put in order by one task, more by
    ranges of them.
    """
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"), F.count("*").alias("source_rows"))
    per = written(per.withColumn("last", F.col("source").isNull()).withColumn("one", F.lit(1.0)), "sources")
    whole = per.agg(F.sum("source_size"), F.count("*")).first()

    def running(rows: DataFrame, order: Sequence[str], sums: dict[str, str]) -> DataFrame:
        if whole[1] > most_sources:
            return _running(rows, order, sums)
        upto = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return rows.withColumns({n: F.sum(c).over(upto) for n, c in sums.items()})

    per = running(per, ["last", "source"], {"nth": "one"})
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.col("nth").cast("long") - 1) % len(weights) + 1).cast("int"))
    per = per.withColumn("w", w).withColumn("cap", F.col("source_size") * float(most)).withColumn("turn", F.col("cap") / F.col("w"))
    per = running(per, ["turn", "last", "source"], {"caps": "cap", "ws": "w"})
    weight = sum(weights) * (whole[1] // len(weights)) + sum(weights[: whole[1] % len(weights)])
    left = F.lit(float(whole[0] or 0)) * float(share) - (F.col("caps") - F.col("cap"))
    per = written(per.withColumn("line", left / (F.lit(float(weight)) - (F.col("ws") - F.col("w")))), "lines")
    level = F.lit(per.agg(F.max("line")).first()[0] or 0.0)
    return per.select("source", "source_size", "source_rows", F.least("cap", F.greatest(F.lit(0.0), level * F.col("w"))).alias("target"))


def mix(
    docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 7,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", bins: int = BINS, bin_rows: int = BIN_ROWS,
    keep_columns: bool = False,
) -> DataFrame:
    """doc_id, size, source_size, target, copies, taken of every row: how often the mix takes it, whole.

    A source of size S and target t takes every document floor(t / S) times; what is left of t, r words, is filled by a sample
    without repeats. A document's inclusion probability p is t / S - floor(t / S), times r / size where it is longer than r. The
    documents are ranked by (u / (1 - u)) / (p / (1 - p)) with u from a hash of seed and identifier (Pareto order sampling,
    Rosen 1997), and taken in this order while the words fit r. The size that's fixed is the number of words, since targets are in
    words: a second pass in the same order fills what a long document at the end left open with those not longer than that, and
    then the document outside whose size is nearest to the words still open joins, if that comes nearer to r.

    No source is sorted as a whole: its rows are counted in bins of the rank, the bin that the end falls in is counted in finer bins,
    and only a last bin of about bin_rows rows is sorted. The same rows and seed give the same mix whatever the partitions are. keep_columns adds all columns of docs (as a struct, _row).

    Null or empty texts have size 0 and take no words (copies: the whole ones). Null sources are one source, the last. Null
    identifiers hash alike. Repeated rows rank side by side and count each. Copies are whole, so a source whose words lie mostly
    in one document can miss its target by up to half of that. An empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        F.regexp_count(text, F.lit(WORDS)).cast("long").alias("size"), F.xxhash64(text).alias("tie"),
        *([whole_row(docs)] if keep_columns else []),
    )
    sized = written(base.select("doc_id", "source", "size", "tie"), "sized")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    targets = source_targets(sized, weights, share, most).withColumn("ratio", ratio).withColumn("whole", F.floor("ratio"))
    targets = written(targets.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")), "targets")
    n_sources, largest = targets.agg(F.count("*"), F.max("source_rows")).first()

    def with_source(rows: DataFrame, per: DataFrame, how: str = "inner") -> DataFrame:
        per = per.withColumnRenamed("source", "_source")
        per = F.broadcast(per) if n_sources <= MOST_SOURCES else per
        return rows.join(per, F.col("source").eqNullSafe(F.col("_source")), how).drop("_source")

    def drawn(rows: DataFrame) -> DataFrame:
        out = with_source(rows, targets)
        long = F.when(F.col("size") > F.col("rest"), F.col("rest") / F.col("size")).otherwise(F.lit(1.0))
        out = out.withColumn("p", (F.col("ratio") - F.col("whole")) * long).withColumn("u", _uniform(seed, F.col("doc_id")))
        odds = F.col("u") * (1 - F.col("p")) / ((1 - F.col("u")) * F.col("p"))
        out = out.withColumn("q", F.when((F.col("p") > 0) & (F.col("size") > 0), odds))
        return out.withColumn("place", F.floor(F.col("q") / (1 + F.col("q")) * float(_PLACES)))

    key = F.struct("q", "doc_id", "size", "tie")

    def filled(rows: DataFrame, budgets: DataFrame, n: int) -> DataFrame:
        """budgets (source, rest{n}) with the last row in order that fits and the words taken up to it: lo{n}, hi{n}, last{n}, rest{n+1}.

        lo to hi is the range of places that the end falls in; both are null where all rows fit.
        """
        rest = f"rest{n}"
        able = rows.select("source", "place", "q", "doc_id", "size", "tie")
        cut = budgets.select("source", rest, F.lit(0).cast("long").alias("lo"), F.lit(0).cast("long").alias("before"))
        width, rows_in = _PLACES + 1, largest or 0  # the last place is that of odds too large for a double's quotient
        while True:
            step = -(-width // bins)
            here = with_source(able, cut).filter((F.col("place") >= F.col("lo")) & (F.col("place") < F.col("lo") + F.lit(width)))
            per_bin = here.groupBy("source", "lo", "before", rest, F.expr(f"(place - lo) div {step}").alias("bin")).agg(F.sum("size").alias("words"), F.count("*").alias("n"))
            up_to = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)  # over at most `bins` rows a source
            per_bin = per_bin.withColumn("upto", F.col("before") + F.sum("words").over(up_to))
            first = F.min(F.when(F.col("upto") > F.col(rest), F.struct("bin", (F.col("upto") - F.col("words")).alias("before"), "n")))
            now = per_bin.groupBy("source", "lo", rest).agg(first.alias("c"), F.max("upto").alias("all"))
            now = now.select("source", rest, (F.col("lo") + F.col("c.bin") * step).alias("lo"), F.coalesce("c.before", "all").alias("before"), F.col("c.n").alias("n"))
            now, width, rows_in = written(now, "cut"), step, rows_in / bins
            # sources whose rows all fit have no range to look into
            cut = now.unionByName(cut.filter("lo is null")) if "n" in cut.columns else now
            if width == 1 or rows_in <= bin_rows:  # places are spread by a hash, and so are the rows of a source over its bins
                break
        cut = cut.select("source", F.col("lo").alias(f"lo{n}"), (F.col("lo") + F.lit(width)).alias(f"hi{n}"), "before")
        at_cut = with_source(with_source(able, cut), budgets.select("source", rest))
        in_order = Window.partitionBy("source").orderBy("q", "doc_id", "size", "tie").rowsBetween(Window.unboundedPreceding, 0)
        at_cut = at_cut.filter((F.col("place") >= F.col(f"lo{n}")) & (F.col("place") < F.col(f"hi{n}"))).withColumn("upto", F.col("before") + F.sum("size").over(in_order))
        last = at_cut.filter(F.col("upto") <= F.col(rest)).groupBy("source").agg(F.max(F.struct("upto", "q", "doc_id", "size", "tie")).alias(f"last{n}"))
        out = with_source(with_source(budgets, cut, "left"), last, "left")
        used = F.coalesce(F.col(f"last{n}.upto"), F.col("before"), F.lit(0))
        # a source without candidates has no row in cut: nothing is before its end
        out = out.withColumn(f"rest{n + 1}", F.col(rest) - used).withColumn(f"none{n}", F.col("before").isNull()).drop("before")
        return written(out, "filled")

    def inside(n: int):
        lo, hi, last = F.col(f"lo{n}"), F.col(f"hi{n}"), f"last{n}"
        among = (F.col("place") >= lo) & (F.col("place") < hi) & F.col(last).isNotNull()
        upto = among & (key <= F.struct(*[f"{last}.{c}" for c in ("q", "doc_id", "size", "tie")]))
        return ~F.col(f"none{n}") & F.coalesce(lo.isNull() | (F.col("place") < lo) | upto, F.lit(False))

    able = drawn(sized).filter("q is not null")
    plan = filled(able, targets.select("source", F.col("rest").alias("rest1")), 1)
    second = with_source(able, plan).filter(~inside(1) & (F.col("size") <= F.col("rest2")))
    plan = filled(second.select(able.columns), plan, 2)
    chosen = inside(1) | ((F.col("size") <= F.col("rest2")) & inside(2))
    outside = with_source(able, plan).filter(~chosen & (F.col("size") < 2 * F.col("rest3")))
    distance = F.abs(F.col("size") - F.col("rest3")).alias("d")
    nearest = outside.groupBy("source").agg(F.min(F.struct(distance, "q", "doc_id", "size", "tie")).alias("more"))
    plan = written(with_source(plan, nearest, "left"), "plan")
    extra = F.col("more").isNotNull() & key.eqNullSafe(F.struct("more.q", "more.doc_id", "more.size", "more.tie"))
    sampled = F.when(F.col("q").isNotNull() & (chosen | extra), 1).otherwise(0)
    picked = with_source(drawn(base if keep_columns else sized), plan)
    picked = picked.withColumn("copies", (F.col("whole") + sampled).cast("long"))
    return picked.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies",
        *(["_row"] if keep_columns else []),
    )


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The rows of docs, each as often as mix() takes it."""
    picked = mix(docs, keep_columns=True, **how)
    return picked.withColumn("_k", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).filter("copies > 0").select("_row.*")
