"""Exact duplicates by a log-structured merge index of text digests. DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm.common import FILTER_BYTES, id_and_text, may_match, whole_row
from corvane.shared import fresh_path, removed, written


class DigestIndex:
    """A log-structured merge index from a text digest to the identifier that stays and the number of rows.

    append() logs the entries of a batch: each task is a memtable, sorts its entries by digest and flushes them as one sorted run (a
    Parquet file whose footer has the key range and whose Bloom filter answers point lookups). compact() merges the runs that were
    appended since the last time with the level below into a new level of one entry a digest: the identifier that stays and the
    count. Only digests and identifiers are ever dealt out, and each task adds up its own entries of a digest first, so a digest
    that a third of all rows share costs one row a task. probe() asks a bitmap filter of the repeated digests before any text moves.
    """

    def __init__(self, spark: SparkSession, keep: str = "max", filter_bytes: int = FILTER_BYTES):
        if keep not in ("max", "min"):
            raise ValueError("keep is 'max' or 'min'")
        self.spark, self.keep, self.filter_bytes = spark, keep, filter_bytes
        self.runs: list[str] = []  # appended and not yet merged
        self.level: str | None = None

    def append(self, entries: DataFrame) -> DataFrame:
        """Logs entries (digest binary, doc_id long) and gives them back as logged, so that nobody makes them again."""
        path = fresh_path(self.spark, "run")
        self._sorted(entries.select("digest", "doc_id"), path)
        self.runs.append(path)
        return self.spark.read.schema("digest binary, doc_id long").parquet(path)

    def compact(self) -> None:
        """Merges what was appended into the level; the level before goes, the runs stay for those who read them."""
        if not self.runs:
            return
        best = F.max("keep_id") if self.keep == "max" else F.min("keep_id")
        parts = self.spark.read.schema("digest binary, doc_id long").parquet(*self.runs).select("digest", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("n"))
        before = self._level() if self.level is not None else None
        if before is not None:
            parts = parts.unionByName(before)
        path = fresh_path(self.spark, "level")
        self._sorted(parts.groupBy("digest").agg(best.alias("keep_id"), F.sum("n").alias("n")), path)
        self.runs, self.level = [], path
        if before is not None:
            removed(before)

    @staticmethod
    def _sorted(rows: DataFrame, path: str) -> None:
        rows.sortWithinPartitions("digest").write.option("parquet.bloom.filter.enabled#digest", "true").option(
            "parquet.bloom.filter.max.bytes", str(1 << 20)
        ).parquet(path)

    def _level(self) -> DataFrame:
        out = self.spark.read.schema("digest binary, keep_id long, n long").parquet(self.level)
        out._corvane_path = self.level
        return out

    def entries(self) -> DataFrame:
        """One row a digest (digest, keep_id, n); what was appended is merged first."""
        self.compact()
        return self._level() if self.level is not None else self.spark.createDataFrame([], "digest binary, keep_id long, n long")

    def probe(self, rows: DataFrame) -> DataFrame:
        """The rows (with digest) that a filter of the digests with more than one entry lets pass: all that have one, few others."""
        repeated = self.entries().filter("n > 1")
        return may_match(rows, repeated, ["digest"], repeated.count(), self.filter_bytes).filter("_may").drop("_may")

    def lookup(self, digest: bytes) -> DataFrame:
        """The entry of one digest: key ranges and Bloom filters let the scan skip almost every file."""
        return self.entries().filter(F.col("digest") == F.lit(bytearray(digest)))


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max", digest_bytes: int = 32,
    filter_bytes: int = FILTER_BYTES,
) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row; equal texts share the keep_id.

    One pass hashes the texts and logs (SHA-256, identifier) in a DigestIndex; verdicts are read from the log. A second pass hashes
    them again, and the rows whose digest the index's filter lets pass are hits: their texts are compared byte by byte, as keys of an
    aggregation, so that each task moves equal texts once; a digest under which texts differ is split by text. Other rows don't
    move their texts. digest_bytes shortens the index's keys (tests use it to make digests collide).

    Null text counts as empty, and all empty texts are one group. Rows that repeat an identifier and its text count in
    group_size and are all kept if it stays. Null identifiers count in group_size and never stay unless the group has no other;
    then keep_id is null and its rows are kept. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    texts = id_and_text(docs, id_col, text_col).withColumn("sha", F.sha2("text", 256))
    texts = texts.withColumn("digest", F.substring(F.unhex("sha"), 1, digest_bytes))
    index = DigestIndex(spark, keep, filter_bytes)
    logged = index.append(texts.select("digest", "doc_id"))
    repeated = index.entries().filter("n > 1")
    hits = index.probe(texts.select("digest", "text"))
    versions = hits.groupBy("digest", "text").agg(F.lit(1).alias("one")).groupBy("digest").agg(F.count("*").alias("versions"))
    differing = written(versions.filter("versions > 1").select("digest"), "differing")
    if differing.isEmpty():
        whole = logged.withColumn("sha", F.lower(F.hex("digest"))) if digest_bytes == 32 else texts.select("doc_id", "digest", "sha")
        return _judged(whole.join(repeated, "digest", "left"))
    best = F.max("doc_id") if keep == "max" else F.min("doc_id")
    plain = texts.select("doc_id", "digest", "sha").join(differing, "digest", "left_anti").join(repeated, "digest", "left")
    mixed = index.probe(texts).join(differing, "digest", "left_semi")
    exact = mixed.groupBy("digest", "text").agg(best.alias("keep_id"), F.count("*").alias("n"))
    mixed = mixed.join(exact, ["digest", "text"])
    return _judged(plain).unionByName(_judged(mixed))


def _judged(rows: DataFrame) -> DataFrame:
    size = F.coalesce("n", F.lit(1)).cast("long")
    rows = rows.withColumn("keep_id", F.when(size > 1, F.col("keep_id")).otherwise(F.col("doc_id")))
    return rows.select(
        "doc_id", "keep_id", size.alias("group_size"), F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def distinct_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max", filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """The rows of docs that exact_dedup() keeps; of rows that repeat an identifier and its text, one.

    Rows whose identifier (null included) a filter of the dropped and repeated ones clears pass without being dealt out or hashed
    again; only the others are joined with these keys.
    """
    verdicts = exact_dedup(docs, id_col, text_col, keep, filter_bytes=filter_bytes).filter("group_size > 1").groupBy("doc_id", "text_sha256")
    verdicts = written(verdicts.agg(F.max("kept").alias("kept"), F.count("*").alias("n")).filter("not kept or n > 1"), "verdicts")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_row(docs))
    rows = may_match(rows, verdicts, ["doc_id"], verdicts.count(), filter_bytes)
    maybe = rows.filter("_may").withColumn("text_sha256", F.sha2(F.coalesce(F.col("_row").getField(text_col), F.lit("")), 256))
    other = verdicts.select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"), "kept")
    match = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_sha256") == F.col("_sha"))
    # an outer join, since the optimizer moves an anti join below the filter, where all rows would be dealt out
    judged = maybe.join(other, match, "left").filter("kept is null")
    kept = rows.filter("not _may").select("_row").unionByName(judged.select("_row"))
    again = other.filter("kept")
    if not again.isEmpty():
        repeats = maybe.join(again, match, "left").filter("kept").dropDuplicates(["doc_id", "text_sha256"])
        kept = kept.unionByName(repeats.select("_row"))
    return kept.select("_row.*")
