"""Incremental ingest with Structured Streaming: everything new since the last run, each key once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from corvane.sources.filings import index_rows


def append_distinct(rows: DataFrame, target: str, checkpoint: str, keys: Sequence[str], event_time: str | None = None, delay: str | None = None) -> None:
    """Appends the rows of a stream whose key no earlier run has seen to a Parquet table, and ends when the source is exhausted.

    The checkpoint, on the shared store, takes the place of a stored high-water mark. With event_time and delay keys are forgotten
    once the watermark passes them, which bounds the state; without, all keys are kept.
    """
    if event_time:
        rows = rows.withWatermark(event_time, delay or "1 day").dropDuplicatesWithinWatermark(list(keys))
    else:
        rows = rows.dropDuplicates(list(keys))
    query = rows.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def ingest_index(spark: SparkSession, source: str, target: str, checkpoint: str) -> None:
    """New rows of the index files in a folder, keyed by (cik, filename, type): files that were read before are skipped."""
    lines = spark.readStream.option("recursiveFileLookup", "true").text(source)
    append_distinct(index_rows(lines), target, checkpoint, ["cik", "filename", "type"])


def read_stream(spark: SparkSession, path: str, columns: Sequence[str], files_per_batch: int | None = None) -> DataFrame:
    """A stream of a Parquet table's files, with the schema of what is there now. The table is a folder or a single file."""
    schema = spark.read.parquet(path).select(*columns).schema
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(target).isFile():
        return reader.option("pathGlobFilter", target.getName()).parquet(target.getParent().toString())
    return reader.parquet(path)
