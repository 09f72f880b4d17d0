"""The read side: a facade over the company tables whose methods return DataFrames."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.functions.text import name_key, to_plain, words
from corvane.shared import written

#: The most rows of one page.
PAGE = 5000
#: Rows that one task puts in order and writes, about, when pages are stored.
TASK_ROWS = 100_000


def conditions(**parameters: Column | None) -> Column:
    """All given conditions; those of empty parameters are None and ignored."""
    out = F.lit(True)
    for c in parameters.values():
        if c is not None:
            out = out & c
    return out


def given(value, condition) -> Column | None:
    return None if value is None or value == "" else condition(value)


def page(rows: DataFrame, *order: str, limit: int = PAGE, offset: int = 0) -> DataFrame:
    """One page of the rows in an order that ends with a unique column."""
    return rows.orderBy(*order).offset(offset).limit(min(limit, PAGE))


def matches_text(column: str, text: str, substring: bool = False) -> Column:
    """Every word of text occurs as a word, or, in substring mode, the text occurs anywhere; case and accents don't matter."""
    if substring:
        return F.contains(name_key(F.col(column)), name_key(F.lit(text)))
    wanted = [w for w in text.lower().replace("/", " ").split(" ") if w]
    have = words(name_key(F.col(column)))
    return F.forall(F.array(*[name_key(F.lit(w)) for w in wanted]), lambda w: F.array_contains(have, w)) if wanted else F.lit(True)


@dataclass
class KeyedPages:
    """Rows stored in the order of ascending columns that end with a unique one, in parts, some to a file, with each part's last key.

    A page is asked for by the last key seen. The parts that hold the rows after it are known from their keys, so that any page
    reads one or two files, however far back it stands.
    """

    spark: SparkSession
    order: tuple[str, ...]
    path: str

    @classmethod
    def build(cls, rows: DataFrame, order: tuple[str, ...], path: str, part_rows: int = 50_000) -> KeyedPages:
        # a file holds many parts: with a range and a file for each, the driver would get samples, results and listings in their number
        n = max(1, -(-rows.count() // max(part_rows, TASK_ROWS)))
        nth = F.monotonically_increasing_id()  # counts within a sorted range, ranges in their order, so no part is in two ranges
        dealt = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumns({"_part": F.call_function("div", nth, F.lit(part_rows)), "_file": F.spark_partition_id()})
        dealt = dealt.sortWithinPartitions("_file", "_part", *order)
        dealt.write.mode("overwrite").partitionBy("_file").parquet(f"{path}/rows")
        spark = rows.sparkSession
        rows.limit(0).coalesce(1).write.mode("overwrite").parquet(f"{path}/columns")  # an empty table has no parts that would tell them
        stored = spark.read.schema(dealt.schema).parquet(f"{path}/rows")
        stored.groupBy("_part").agg(F.max(F.struct(*order)).alias("last"), F.count("*").alias("n"), F.first("_file").alias("file")).coalesce(1).write.mode("overwrite").parquet(f"{path}/parts")
        return cls(spark, tuple(order), path)

    def after(self, key: tuple | None = None, limit: int = PAGE) -> DataFrame:
        """The first rows, in order, whose key is larger than key; from the beginning without one."""
        limit = min(limit, PAGE)
        parts = self.spark.read.parquet(f"{self.path}/parts")
        rows = self.spark.read.schema(self.spark.read.parquet(f"{self.path}/columns").schema.add("_part", "long").add("_file", "integer")).parquet(f"{self.path}/rows")
        if key is not None:
            types = dict(rows.dtypes)
            wanted = F.struct(*[F.lit(v).cast(types[c]).alias(c) for c, v in zip(self.order, key, strict=True)])
            parts, rows = parts.filter(F.col("last") > wanted), rows.filter(F.struct(*self.order) > wanted)
        chosen, files, held = [], set(), 0
        for r in parts.orderBy("_part").limit(limit + 1).collect():  # a part has a row at least
            chosen.append(r["_part"])
            files.add(r["file"])
            held += r["n"] if key is None or len(chosen) > 1 else 1  # how much of the first part lies after the key isn't known
            if held >= limit + (key is not None):
                break
        rows = rows.filter(F.col("_file").isin(sorted(files)) & F.col("_part").isin(chosen) if chosen else F.lit(False))
        return rows.orderBy(*self.order).limit(limit).drop("_part", "_file")


def _trigrams(key: Column) -> Column:
    return F.when(F.length(key) >= 3, F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(key) - 2), lambda i: F.substr(key, i, F.lit(3))))).otherwise(F.array().cast("array<string>"))


@dataclass
class TextIndex:
    """A stored index from words, and from three successive characters, to identifiers, and the texts compared with substrings.

    Rows (token, id) are sorted by token, so that a search reads the files of its tokens only. A later build adds its new rows.
    """

    spark: SparkSession
    path: str

    @classmethod
    def build(cls, rows: DataFrame, id_col: str, column: str, path: str) -> TextIndex:
        """Writes the index of a column; texts are compared without case and accents. Of rows with one identifier one text counts."""
        index = cls(rows.sparkSession, path)
        index._write(rows, id_col, column, "overwrite")
        return index

    def _write(self, rows: DataFrame, id_col: str, column: str, mode: str) -> None:
        key = name_key(F.col(column))
        texts = rows.groupBy(F.col(id_col).alias(id_col)).agg(F.min(key).alias("_key")).filter("_key is not null")
        for kind, tokens in (("words", F.array_distinct(words(F.col("_key")))), ("trigrams", _trigrams(F.col("_key")))):
            found = texts.select(F.explode(tokens).alias("_token"), id_col)
            # ranges of both columns, so that a token in a third of all rows is spread over several files
            found.repartitionByRange("_token", id_col).sortWithinPartitions("_token", id_col).write.mode(mode).parquet(f"{self.path}/{kind}")
        texts.repartitionByRange(id_col).sortWithinPartitions(id_col).write.mode(mode).parquet(f"{self.path}/texts")

    def extend(self, rows: DataFrame, id_col: str, column: str) -> None:
        """Adds the rows whose identifiers the index doesn't have."""
        known = self.spark.read.parquet(f"{self.path}/texts").select(id_col)
        self._write(written(rows.join(known, id_col, "left_anti"), "new-texts"), id_col, column, "append")

    def _having(self, kind: str, tokens: list[str]) -> DataFrame:
        table = self.spark.read.parquet(f"{self.path}/{kind}")
        (id_col,) = [c for c in table.columns if c != "_token"]
        hits = table.filter(F.col("_token").isin(tokens) if tokens else F.lit(False))
        return hits.groupBy(id_col).agg(F.count("*").alias("_n")).filter(F.col("_n") == len(tokens)).drop("_n")

    def search(self, text: str, substring: bool = False) -> DataFrame:
        """The identifiers of rows that have every word of text, none for a text without words; or that hold it anywhere."""
        if not substring:
            return self._having("words", sorted({w for w in to_plain(text).replace("/", " ").split(" ") if w}))
        (key,) = self.spark.range(1).select(name_key(F.lit(text))).first()
        texts = self.spark.read.parquet(f"{self.path}/texts")
        (id_col,) = [c for c in texts.columns if c != "_key"]
        if len(key) >= 3:  # shorter ones are looked for in all texts
            texts = texts.join(self._having("trigrams", sorted({key[i : i + 3] for i in range(len(key) - 2)})), id_col, "left_semi")
        return texts.filter(F.contains("_key", F.lit(key))).select(id_col)


def meta(rows: DataFrame, **parameters) -> dict:
    """What describes a result: its size, the parameters that counted, and a status; an empty result has one, too."""
    return {"total_results": rows.count(), "parameters": {k: v for k, v in parameters.items() if v not in (None, "")}, "status_string": "OK"}


@dataclass
class Directory:
    """info: (cw_id, year, company_name, sic_code, source_type, top_parent_id, min_year, max_year, most_recent, ...); edges: (source, target, year)."""

    info: DataFrame
    edges: DataFrame
    names: DataFrame | None = None
    locations: DataFrame | None = None
    filings: DataFrame | None = None
    filings_lookup: DataFrame | None = None
    #: For the columns company_name and raw_address: an index of the column's distinct texts, see with_indexes().
    indexes: dict[str, TextIndex] = field(default_factory=dict)

    def with_indexes(self, path: str) -> Directory:
        """This directory with indexes, stored below path, of the company names and addresses that its searches look for."""
        tables = {"company_name": [t for t in (self.info, self.names) if t is not None], "raw_address": [t for t in (self.locations,) if t is not None]}
        made = {}
        for column, found in tables.items():
            texts = [t.select(column) for t in found]
            if texts:
                every = texts[0] if len(texts) == 1 else texts[0].unionByName(texts[1])
                made[column] = TextIndex.build(every.distinct(), column, column, f"{path}/{column}")
        return replace(self, indexes=made)

    def _said(self, rows: DataFrame, column: str, text: str | None, substring: bool) -> DataFrame:
        """The rows whose column meets a search text, by the column's index if there is one."""
        if text is None or text == "":
            return rows
        index = self.indexes.get(column)
        if index is None or not (substring or any(to_plain(text).replace("/", " ").split(" "))):
            return rows.filter(matches_text(column, text, substring))
        return rows.join(index.search(text, substring), column, "left_semi").select(*rows.columns)

    def _at(self, year: int | None) -> Column:
        return F.col("most_recent") if year is None else F.col("year") == year

    def company(self, cw_id: int, year: int | None = None) -> DataFrame:
        """The company in a year, by default its most recent one."""
        return self.info.filter((F.col("cw_id") == cw_id) & self._at(year))

    def history(self, cw_id: int) -> DataFrame:
        return self.info.filter(F.col("cw_id") == cw_id).orderBy("year")

    def _relatives(self, cw_id: int, year: int | None, own: str, other: str) -> DataFrame:
        me = self.company(cw_id, year).select(F.col("year").alias("y"))
        ids = self.edges.filter(F.col(own) == cw_id).join(me, F.col("year") == F.col("y"), "left_semi").select(F.col(other).alias("cw_id"), "year").distinct()
        return self.info.join(ids, ["cw_id", "year"], "left_semi")

    def children(self, cw_id: int, year: int | None = None) -> DataFrame:
        return self._relatives(cw_id, year, "source", "target")

    def parents(self, cw_id: int, year: int | None = None) -> DataFrame:
        return self._relatives(cw_id, year, "target", "source")

    def _of(self, table: DataFrame, cw_id: int, year: int | None) -> DataFrame:
        """Rows of a table with min_year and max_year that hold in a year, by default the company's most recent one."""
        me = self.company(cw_id, year).select(F.col("cw_id").alias("_c"), F.col("year").alias("_y"))
        return table.join(me, (F.col("cw_id") == F.col("_c")) & F.col("_y").between(F.col("min_year"), F.col("max_year")), "left_semi")

    def names_of(self, cw_id: int, year: int | None = None) -> DataFrame:
        return self._of(self.names, cw_id, year)

    def locations_of(self, cw_id: int, year: int | None = None) -> DataFrame:
        return self._of(self.locations, cw_id, year)

    def filings_of(self, cw_id: int, year: int | None = None) -> DataFrame:
        ids = self.filings_lookup.filter(F.col("cw_id") == cw_id).select("filing_id")
        own = self.filings.join(ids, "filing_id", "left_semi")
        return own.join(self.company(cw_id, year).select("year"), "year", "left_semi")

    def years(self) -> DataFrame:
        return self.info.select("year").distinct().orderBy("year")

    def search(
        self, company_name: str | None = None, sic_code: int | None = None, min_year: int | None = None, max_year: int | None = None,
        source_type: str | None = None, top_parent_id: int | None = None, year: int | None = None, substring: bool = False,
    ) -> DataFrame:
        """Companies in a year (default: their most recent one) that meet all given parameters."""
        return self._said(self.info, "company_name", company_name, substring).filter(self._at(year) & conditions(
            sic=given(sic_code, lambda v: F.col("sic_code") == v),
            low=given(min_year, lambda v: F.col("max_year") >= v), high=given(max_year, lambda v: F.col("min_year") <= v),
            source=given(source_type, lambda v: F.col("source_type") == v), top=given(top_parent_id, lambda v: F.col("top_parent_id") == v),
        ))

    def search_names(self, company_name: str | None = None, source: str | None = None, min_year: int | None = None, max_year: int | None = None, substring: bool = False) -> DataFrame:
        return self._said(self.names, "company_name", company_name, substring).filter(conditions(
            source=given(source, lambda v: F.col("source") == v),
            low=given(min_year, lambda v: F.col("max_year") >= v), high=given(max_year, lambda v: F.col("min_year") <= v),
        ))

    def search_locations(self, address: str | None = None, type_: str | None = None, min_year: int | None = None, max_year: int | None = None, substring: bool = False) -> DataFrame:
        return self._said(self.locations, "raw_address", address, substring).filter(conditions(
            kind=given(type_, lambda v: F.col("type") == v),
            low=given(min_year, lambda v: F.col("max_year") >= v), high=given(max_year, lambda v: F.col("min_year") <= v),
        ))
