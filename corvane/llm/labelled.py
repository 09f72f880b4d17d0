"""Rows that a model may learn from: labelled ones outside the held-out fifth, a bounded sample of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column | str) -> Column:
    """True for the fifth of identifiers that no model learns labels from; false for null."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_rows(rows: DataFrame, labels: DataFrame, label_col: str, most: int, id_col: str = "doc_id") -> DataFrame:
    """rows (with doc_id) that have a label 0 or 1, as column y: those of at most `most` identifiers, with the smallest hashes.

    An identifier with several labels counts with its largest; one with several rows has them all here, see one_of_each(). The labels
    are broadcast, since their number is bounded.
    """
    known = labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("int").alias("_y")).filter("_y in (0, 1)")
    known = known.filter(~held_out("_id")).groupBy("_id").agg(F.max("_y").alias("_y"))
    known = known.orderBy(F.xxhash64("_id"), "_id").limit(most)
    return rows.join(F.broadcast(known), F.col("doc_id") == F.col("_id")).withColumn("y", F.col("_y")).drop("_id", "_y")


def one_of_each(rows: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row an identifier, the smallest, so that what a model learns from is bounded and the same every time."""
    rest = [c for c in rows.columns if c != id_col]
    return rows.groupBy(id_col).agg(F.min(F.struct(*rest)).alias("_r")).select(id_col, "_r.*")
