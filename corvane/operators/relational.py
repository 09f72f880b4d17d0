"""Set-based replacements for keyed tables: keep-first inserts, updates by join, stable identifiers, latest rows."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvane.shared import written

#: Lookup tables are broadcast up to so many rows; larger ones are joined by a shuffle.
MOST_BROADCAST_ROWS = 200_000


def small(df: DataFrame, most: int = MOST_BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it has at most so many rows. Only rows up to the limit are counted."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


@contextmanager
def counted_broadcasts(spark: SparkSession) -> Iterator[None]:
    """What runs within broadcasts only what small() has counted.

    Spark's own choice goes by bytes of files and shuffles, which hold a hundred times as much where keys and names repeat; the driver
    has all such tables in memory at once.
    """
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def latest(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key with the largest order columns, by partial aggregation rather than a sort of each group."""
    others = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*others), F.struct(*order)).alias("_best"))
    return best.select(*keys, "_best.*")


def first_of_group(rows: DataFrame, keys: Sequence[str], source_id: str) -> DataFrame:
    """One row a key, the one with the smallest source_id: what stands for an arbitrary row of the group."""
    others = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.min_by(F.struct(*others), F.col(source_id)).alias("_best"))
    return best.select(*keys, "_best.*")


def insert_ignore(table: DataFrame, new: DataFrame, keys: Sequence[str], order: str | None = None) -> DataFrame:
    """table with those rows of new whose key it lacks; of several new rows with one key the first by order stays."""
    fresh = new.join(table.select(*keys).distinct(), list(keys), "left_anti")
    fresh = first_of_group(fresh, keys, order) if order else fresh.dropDuplicates(list(keys))
    return table.unionByName(fresh.select(table.columns))


def unseen(rows: DataFrame, *known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows whose key no known table has."""
    for table in known:
        rows = rows.join(table.select(*keys), list(keys), "left_anti")
    return rows


def update_from(target: DataFrame, source: DataFrame, keys: Sequence[str], order: str, fill: Mapping[str, str], only_null: bool = True) -> DataFrame:
    """target with columns set from the source row of the same key; of several the smallest order wins, before the join.

    fill maps columns of target to columns of source. only_null sets missing values only; otherwise found values overwrite.
    """
    picked = source.select(*keys, order, *dict.fromkeys(fill.values()))
    wanted = {v: f"_new_{v}" for v in fill.values()}
    best = picked.groupBy(*keys).agg(F.min_by(F.struct(*wanted), F.col(order)).alias("_src"))
    # rows without a key match nothing; they're dealt by their other columns, or all of them would be in one task. What other rows
    # get is 0, computed so that it stays a part of the join's key
    none = F.pmod(F.xxhash64(*keys), F.lit(1))
    lacks = F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False))
    dealt = target.withColumn("_deal", F.when(lacks, F.pmod(F.xxhash64(*[c for c, t in target.dtypes if "map<" not in t]), F.lit(1024)) + 1).otherwise(none))
    joined = dealt.join(best.withColumn("_deal", none), [*keys, "_deal"], "left")
    out = []
    for c in target.columns:
        if c in fill:
            new = F.col(f"_src.{fill[c]}")
            out.append((F.coalesce(F.col(c), new) if only_null else F.coalesce(new, F.col(c))).alias(c))
        else:
            out.append(F.col(c))
    return joined.select(*out)


def surrogate_ids(rows: DataFrame, order: Sequence[str], id_col: str, start: Column | int = 0) -> DataFrame:
    """rows numbered from start + 1 in the order of a natural key.

    Rows are dealt to ranges; each range is numbered by itself and shifted by the sizes of those before it, so that no single
    task sees all rows. The ranges are written first, since a later run of the plan could cut them elsewhere. The order must be
    total for the numbers to be reproducible.
    """
    spread = written(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranges")
    within = Window.partitionBy("_part").orderBy(*order)
    numbered = spread.withColumn("_nth", F.row_number().over(within))
    sizes = numbered.groupBy("_part").agg(F.max("_nth").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    shift = start if isinstance(start, Column) else F.lit(start)
    out = numbered.join(F.broadcast(offsets), "_part")  # one row a partition
    return out.withColumn(id_col, (F.col("_nth") + F.col("_before") + shift).cast("long")).drop("_part", "_nth", "_before")


def ratio(part: Column, whole: Column) -> Column:
    """Percentage; null where there is no whole."""
    return part / F.nullif(whole.cast("double"), F.lit(0.0)) * 100


def year_spine(*keys: DataFrame) -> DataFrame:
    """The distinct (entity, year) keys of all inputs."""
    out = keys[0]
    for k in keys[1:]:
        out = out.unionByName(k)
    return out.distinct()


def with_year_range(rows: DataFrame, entity: str, year: str) -> DataFrame:
    """min_year, max_year of the entity and most_recent on each of its rows."""
    w = Window.partitionBy(entity)
    out = rows.withColumn("min_year", F.min(year).over(w)).withColumn("max_year", F.max(year).over(w))
    return out.withColumn("most_recent", F.col(year) == F.col("max_year"))


def token_counts(texts: DataFrame, tokens: Column, name: str) -> DataFrame:
    """(name, count, weight): how often each token occurs, and its inverse-log weight."""
    from corvane.functions.text import inverse_log_weight

    counted = texts.select(F.explode(tokens).alias(name)).groupBy(name).agg(F.count("*").alias("count"))
    return counted.withColumn("weight", inverse_log_weight(F.col("count")))


def stop_terms(counts: DataFrame, name: str = "word", n: int = 75) -> DataFrame:
    """The n most frequent tokens; ties go by the token."""
    return counts.orderBy(F.desc("count"), name).limit(n).select(name)
