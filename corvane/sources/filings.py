"""Readers of index files, name lists and raw documents, and what is cut from them."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.functions.text import decode_entities, document_url, lenient_date, match_key
from corvane.operators.relational import latest, unseen
from corvane.shared import ship, spread

INDEX = "cik long, company_name string, type string, filing_date date, filename string"
#: Forms whose exhibits are parsed: annual reports, transition reports and their amendments.
ANNUAL_FORM = r"^10-KT?(?:/A)?$"


def index_rows(lines: DataFrame, value: str = "value") -> DataFrame:
    """INDEX rows of pipe-separated lines; headings and malformed lines are skipped."""
    p = F.split(F.col(value), r"\|")
    d = lines.withColumn("_p", p).filter((F.size("_p") == 5) & F.col("_p")[0].rlike(r"^\s*[0-9]+\s*$"))
    at = lambda i: F.trim(F.col("_p")[i])
    kept = [c for c in lines.columns if c != value]
    return d.select(*kept, at(0).cast("long").alias("cik"), at(1).alias("company_name"), at(2).alias("type"), F.try_to_timestamp(at(3), F.lit("yyyy-MM-dd")).cast("date").alias("filing_date"), at(4).alias("filename"))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The index files below a path (gzip or plain), with year and quarter of their folders where these are .../{year}/{quarter}/..."""
    return placed_index(spark.read.option("recursiveFileLookup", "true").text(path))


def placed_index(lines: DataFrame) -> DataFrame:
    """read_index() of lines that come from files, a stream's too."""
    rows = index_rows(lines.select("value", F.col("_metadata.file_path").alias("_path")))
    place = lambda k: F.try_to_number(F.regexp_extract("_path", r"/([0-9]{4})/(?:QTR)?([1-4])/", k), F.lit("9999")).cast("int")
    return rows.withColumn("year", place(1)).withColumn("quarter", place(2)).drop("_path")


def freshness(lines: DataFrame, value: str = "value") -> DataFrame:
    """(update_date): the latest date of the lines that say when data was last received."""
    said = F.regexp_extract(value, r"(?i)^Last Data Received:\s*(.+)$", 1)
    return lines.select(lenient_date(F.when(said != "", said)).alias("d")).agg(F.max("d").alias("update_date"))


def read_names(spark: SparkSession, path: str) -> DataFrame:
    """(name, cik, match_name) of lines "name:cik:"."""
    return name_rows(spark.read.text(path))


def name_rows(lines: DataFrame, value: str = "value") -> DataFrame:
    pattern = r"^(.+):([0-9]+):\s*$"
    d = lines.filter(F.col(value).rlike(pattern))
    name = F.regexp_extract(value, pattern, 1)
    return d.select(name.alias("name"), F.regexp_extract(value, pattern, 2).cast("long").alias("cik"), match_key(name).alias("match_name"))


def read_documents(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """(filing_id, year, quarter, content) of {year}/{quarter}/{filing_id}{suffix} below a path, a file a row."""
    return placed_documents(spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}").text(path, wholetext=True), suffix)


def placed_documents(files: DataFrame, suffix: str) -> DataFrame:
    """read_documents() of whole files, a stream's too."""
    d = files.select(F.col("value").alias("content"), F.col("_metadata.file_path").alias("_path"))
    name = r"/([0-9]{4})/([1-4])/([0-9]+)" + re.escape(suffix) + "$"
    d = d.filter(F.col("_path").rlike(name))
    at = lambda k, t: F.regexp_extract("_path", name, k).cast(t)
    return d.select(at(3, "long").alias("filing_id"), at(1, "int").alias("year"), at(2, "int").alias("quarter"), "content")


def exhibit(submission: Column) -> Column:
    """The first document of a submission whose type begins EX-21; null without one."""
    found = F.regexp_extract(submission, r"(?is)<DOCUMENT>\s*(<TYPE>EX-21.*?)</DOCUMENT>", 1)
    return F.when(found != "", found)


def exhibit_name(document: Column) -> Column:
    name = F.trim(F.regexp_extract(document, r"(?i)<FILENAME>([^\r\n<]+)", 1))
    return F.when(name != "", name)


def with_exhibits(submissions: DataFrame, base_url: str) -> DataFrame:
    """submissions (filename, content) with exhibit, has_sec21 and sec_21_url."""
    d = submissions.withColumn("exhibit", exhibit(F.col("content")))
    return d.withColumn("has_sec21", F.col("exhibit").isNotNull()).withColumn("sec_21_url", document_url(F.col("filename"), exhibit_name(F.col("exhibit")), base_url))


def new_index_rows(index: DataFrame, known: DataFrame) -> DataFrame:
    """Index rows whose (cik, filename, type, year) isn't known yet, each once."""
    keys = ["cik", "filename", "type", "year"]
    return unseen(index.dropDuplicates(keys), known, keys=keys)


def latest_loaded(rows: DataFrame) -> DataFrame:
    """(year, quarter): the last quarter that rows (year, quarter) are loaded of; one aggregate, nulls for an empty table."""
    return rows.agg(F.max(F.struct("year", "quarter")).alias("_m")).select("_m.year", "_m.quarter")


def is_annual(type_: Column) -> Column:
    return type_.rlike(ANNUAL_FORM)


def header_candidates(filings: DataFrame, filers: DataFrame) -> DataFrame:
    """The latest usable filing of each (cik, year) that no filer is known for, by cik and year or by filing."""
    usable = filings.filter("cik <> 0 and not bad_header and type not in ('4', 'REGDEX')")
    best = latest(usable, ["cik", "year"], ["filing_id"])
    return best.join(filers.select("cik", "year"), ["cik", "year"], "left_anti").join(filers.select("filing_id"), "filing_id", "left_anti")


def to_parse(filings: DataFrame, relationships: DataFrame) -> DataFrame:
    """Filings with an exhibit that isn't bad and of which nothing is parsed yet."""
    return filings.filter("has_sec21 and not coalesce(bad_sec21, false)").join(relationships.select("filing_id"), "filing_id", "left_anti")


def document_code(content: Column, cik: Column) -> Column:
    """0: fine; 1: empty or an error page; 2: the cik isn't in it."""
    blank = content.isNull() | (F.trim(content) == "")
    error = content.rlike(r"(?i)<title>[^<]*(?:error|not found)")
    return F.when(blank | error, 1).when(~F.contains(content, cik.cast("string")), 2).otherwise(0)


_ADDRESS = ("raw_address", "street_1", "street_2", "city", "state", "zip", "phone")
_PLAIN = ("conformed_name", "irs_number", "sic_code", "state_of_incorporation", "fiscal_year_end")
HEADER = ", ".join(["filing_id long", "cik long", *(f"{c} string" for c in _PLAIN), *(f"{k}_{c} string" for k in ("business", "mail") for c in _ADDRESS)])
_PHONE = re.compile(r"^[^a-df-su-wyz]+$", re.I)  # digits, signs and the letters of "ext"


def address_fields(lines: list[str], codes: set[str]) -> dict[str, str]:
    """The fields of an address block: its first line is the street, its last one the city, the state and the postal code.

    The state is the last two-character word that is a known region code.
    """
    lines = [x for x in lines if x and x != "NULL"]
    out = {}
    body = list(lines)
    if body and _PHONE.match(body[-1]):
        out["phone"] = body.pop()
    out["raw_address"] = ", ".join(body)
    if not body:
        return {k: v for k, v in out.items() if v}
    place = body.pop() if len(body) > 1 else body[0]
    if body[0] is not place:
        out["street_1"] = body.pop(0)
    state = next((m for m in reversed(list(re.finditer(r"\b[A-Za-z0-9]{2}\b", place))) if m[0].upper() in codes), None)
    if state:
        out |= {"state": state[0].upper(), "city": place[: state.start()].strip(), "zip": place[state.end() :].strip()}
    if body and body[0] is not place:
        out["street_2"] = body.pop(0)
    if out.get("street_2") and not out.get("city"):
        out["city"] = out.pop("street_2")
    return {k: v for k, v in out.items() if v}


def header_fields(content: str, cik: int, codes: set[str]) -> dict[str, str] | None:
    """The first filer block that mentions the cik; None where the document or every block lacks it."""
    from corvane.sources.tree import parse

    root = parse(content or "")
    blocks = [b for b in root.with_attr("id", "filerDiv") if str(cik) in b.text(" ")]
    if not blocks:
        return None
    block = blocks[0]
    out = {}
    for mailer in block.with_attr("class", "mailer"):
        kind = "business" if mailer.trimmed().startswith("Business") else "mail"
        out |= {f"{kind}_{k}": v for k, v in address_fields([s.trimmed() for s in mailer.find("span")], codes).items()}
    for name in block.with_attr("class", "companyName")[:1]:
        out["conformed_name"] = re.sub(r" \([^)]+\).*$", "", "".join(name.said).strip() or name.trimmed())
    said = " ".join(i.trimmed() for i in block.with_attr("class", "identInfo"))
    for field, pattern in (
        ("irs_number", r"IRS No\.:? ?([0-9]+)"), ("sic_code", r"SIC:? ?([0-9]+)"), ("fiscal_year_end", r"Fiscal Year End:? ?([0-9]+)"),
        ("state_of_incorporation", r"State of Incorp\.:? ?(.+?)(?= ?\||  | Fiscal| Type|$)"),
    ):
        m = re.search(pattern, said)
        if m:
            out[field] = m[1].strip()
    return out


def header_rows(headers: DataFrame, region_codes: list[str]) -> DataFrame:
    """HEADER rows of header pages (filing_id, cik, content). region_codes is the list of known state codes, a few hundred."""
    codes = {c.upper() for c in region_codes}
    names = [c.strip().split(" ")[0] for c in HEADER.split(",")]
    ship(headers.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for filing_id, cik, content in zip(batch["filing_id"], batch["cik"], batch["content"], strict=True):
                got = header_fields(content, int(cik), codes) if pd.notna(cik) else None
                if got is not None:
                    got |= {"filing_id": int(filing_id), "cik": int(cik)}
                    rows.append([got.get(n) for n in names])
            yield pd.DataFrame(rows, columns=names, dtype=object)

    return spread(headers.select("filing_id", "cik", "content"), "filing_id").mapInPandas(run, HEADER)


def typed_filers(rows: DataFrame) -> DataFrame:
    """header_rows with numbers as numbers and a match name."""
    number = lambda c: F.try_to_number(F.regexp_replace(c, "[^0-9]", ""), F.lit("9999999999")).cast("int")
    key = match_key(decode_entities(F.col("conformed_name")))
    out = rows.withColumns({c: number(c) for c in ("irs_number", "sic_code", "fiscal_year_end")})
    return out.withColumn("match_name", F.when(key != "", key))
