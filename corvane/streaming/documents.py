"""Incremental load of index files, submissions and header pages: each micro-batch parses what is new and stores it once."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.plans import build
from corvane.shared import written
from corvane.sources import filings as sources


@dataclass
class BatchTable:
    """A Parquet table with a folder for each micro-batch that wrote to it.

    A batch that Spark repeats after a failure replaces its own folder and reads only those of earlier ones, so it stores the same
    rows again instead of doubling them.
    """

    spark: SparkSession
    path: str

    def _exists(self, path: str) -> bool:
        sc = self.spark.sparkContext
        target = sc._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(sc._jsc.hadoopConfiguration()).exists(target)

    def put(self, rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/batch={batch}")

    def rows(self, before: int | None = None) -> DataFrame | None:
        """What batches, or those before one, have stored; None if there is nothing."""
        if not self._exists(self.path):
            return None
        every = self.spark.read.parquet(self.path)
        kept = every if before is None else every.filter(F.col("batch") < before)
        return None if kept.isEmpty() else kept.drop("batch")

    def of(self, batch: int) -> DataFrame | None:
        return self.spark.read.parquet(f"{self.path}/batch={batch}") if self._exists(f"{self.path}/batch={batch}") else None


def unseen_rows(rows: DataFrame, known: DataFrame | None, key: str) -> DataFrame:
    """The rows of a batch whose key no earlier batch has stored, one a key."""
    fresh = rows.dropDuplicates([key])
    return fresh if known is None else fresh.join(known.select(key), key, "left_anti")


def each_batch(stream: DataFrame, store: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Calls store(rows, batch) with everything that the stream's source has and no run before has stored."""
    stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


class FilingStore:
    """What is known of downloaded files, in a folder: filing_ids, filings, documents, relationships, bad_locations and filers.

    load() reads the files that are new below a source (laid out as from_documents() says) in three streams: index lines, submissions
    and header pages. The latter two are joined with the filings stored so far, a static table; a document whose filing no index has
    named yet waits in the table "waiting" for a later batch. Of a document that comes again the first stays. Files may come in any
    number of loads: tables() has the rows that one load of all of them gives, under identifiers that never change.
    """

    def __init__(self, spark: SparkSession, folder: str, files_per_batch: int | None = None):
        self.spark, self.folder, self.files_per_batch = spark, folder, files_per_batch

    def table(self, name: str) -> BatchTable:
        return BatchTable(self.spark, f"{self.folder}/{name}")

    def _stream(self, path: str, pattern: str, whole: bool) -> DataFrame:
        reader = self.spark.readStream.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
        if self.files_per_batch is not None:
            reader = reader.option("maxFilesPerTrigger", str(self.files_per_batch))
        return reader.text(path, wholetext=whole)

    def load(self, source: str, lookups: dict[str, DataFrame], base_url: str = "https://example.org/") -> None:
        at = lambda kind: f"{self.folder}/checkpoints/{kind}"
        each_batch(sources.placed_index(self._stream(f"{source}/index", "*", False)), self.store_index, at("index"))
        submissions = sources.placed_documents(self._stream(f"{source}/submissions", "*.txt", True), ".txt")
        each_batch(submissions, lambda rows, n: self.store_submissions(rows, n, lookups, base_url), at("submissions"))
        pages = sources.placed_documents(self._stream(f"{source}/headers", "*.html", True), ".html")
        each_batch(pages, lambda rows, n: self.store_headers(rows, n, lookups["region_codes"]), at("headers"))

    def store_index(self, index: DataFrame, batch: int) -> None:
        known = self.table("filing_ids").rows(before=batch)
        numbers = written(build.numbered_files(index, known), "filing-ids")
        new = numbers if known is None else numbers.join(known.select("filing_id"), "filing_id", "left_anti")
        new = written(new, "new-files")
        self.table("filing_ids").put(new, batch)
        self.table("filings").put(build.file_rows(index, new), batch)

    def _ready(self, kind: str, rows: DataFrame, batch: int, stored: str) -> tuple[DataFrame, DataFrame]:
        """(filings, documents of them that no batch has stored); those of unknown filings are put aside."""
        filings = self.table("filings").rows()
        waiting = self.table(f"waiting_{kind}")
        before = waiting.of(batch - 1)
        rows = rows.select("filing_id", "content")
        rows = rows if before is None else rows.unionByName(before)
        fresh = written(unseen_rows(rows, self.table(stored).rows(before=batch), "filing_id"), "fresh")
        if filings is None:
            waiting.put(fresh, batch)
            return self.table("filings").of(0), fresh.limit(0)
        waiting.put(fresh.join(filings.select("filing_id"), "filing_id", "left_anti"), batch)
        return filings, fresh.join(filings.select("filing_id"), "filing_id", "left_semi")

    def store_submissions(self, rows: DataFrame, batch: int, lookups: dict[str, DataFrame], base_url: str) -> None:
        filings, fresh = self._ready("submissions", rows, batch, "documents")
        if fresh.isEmpty():
            return
        so_far = self.table("relationships").rows(before=batch)
        last = 0 if so_far is None else so_far.agg(F.coalesce(F.max("relationship_id"), F.lit(0))).first()[0]
        for name, made in build.parsed_submissions(filings, fresh, lookups, base_url, last).items():
            self.table(name).put(made, batch)

    def store_headers(self, rows: DataFrame, batch: int, region_codes: DataFrame) -> None:
        filings, fresh = self._ready("headers", rows, batch, "pages")
        if fresh.isEmpty():
            return
        self.table("filers").put(build.parsed_headers(filings, fresh, region_codes), batch)
        self.table("pages").put(fresh.select("filing_id"), batch)  # last: pages without a filer are done, too

    def tables(self) -> dict[str, DataFrame]:
        """filings, filers and relationships as company_graph() takes them, filing_ids and bad_locations; there must have been a load."""
        out = {name: self.table(name).rows() for name in ("filing_ids", "filings", "documents", "filers", "relationships", "bad_locations")}
        missing = [k for k, v in out.items() if v is None and k != "bad_locations"]
        if missing:
            raise ValueError(f"nothing is stored of {', '.join(missing)}")
        return out | {"filings": build.with_documents(out["filings"], out["documents"])}

    def publish(self, lookups: dict[str, DataFrame], names: DataFrame, years: list[int], base_url: str = "https://example.org/") -> dict[str, DataFrame]:
        """The tables of from_documents() from what is stored."""
        tables = self.tables()
        made = build.published({k: tables[k] for k in ("filings", "filers", "relationships")}, lookups, names, years, base_url)
        return made | {"bad_locations": tables["bad_locations"], "filing_ids": tables["filing_ids"]}
