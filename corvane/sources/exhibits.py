"""Subsidiaries in exhibits: units of text from HTML trees or plain text, native candidates of each, validation by lookup tables.

Trees are walked in one Arrow-batched table function that emits text units with the rank of the strategy that found them. All that
follows is DataFrame work: units become candidates, candidates are validated in bulk, and the valid one of the best rank stays.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions.text import apply_steps, clean_contents, fold_signs, strip_junk
from corvane.operators.locate import Places, look_up
from corvane.operators.relational import small
from corvane.shared import ship, spread, written

# How one string names a company and its place, in order of trust: (pattern, group of the company, group of the place).
SINGLE_PATTERNS = (
    (r"(?is)(.+?)(,|is|was) (an? |our )?(wholly-owned |private |s.p.a. )?(subsidiary |foreign sales corporation |company )?(incorporated|located|chartered) in (the )?(.+?)( and|\s\s+| \(.+|$)", 1, 8),
    (r"(?is)(.+?)(, | \(|  )an? ([^\(]+?) (corporation|company|partnership|statutory trust|state[- ]chartered (commercial )?bank|business trust)\)?", 1, 3),
    (r"(?is)(.+?)(, | \(|is )(a (corporation|national banking (association|organization)) )?(organized|incorporated) (and existing )?under the laws of (the )?([^\(]+)", 1, 9),
    (r"(?is)(.+?)( is|, )? (formed|registered|incorporated|organized) (in|under) (the (laws of))?(.+?)($| and|\s\s+)", 1, 7),
    (r"(?is)(\w.+?) ?[\(\[](.[^\)\]]+)[\]\)](.+)?", 1, 2),
    (r"(?i)^\s*(\w.+) *jurisdiction of organization: ?(\w.+)$", 1, 2),
    (r"^\s*(\w.+?)\s*(–|–|&#15[01];|-)\s*(\w.+)$", 1, 3),
    (r"^\s*(\w.+?)\s\s\s+(\w.+)$", 1, 2),
    (r"^\s*(\w.+?)  .*  (\w.+)$", 1, 2),
    (r"(?i)(\w.+?) \(?(.+?)\)?(\.|,| )+(\.|,| |ltd|company|co|S\.?(A\.?)?(R\.?L\.?)?|limited|inc|incorporated|corp|pty|private|gmbh|L\.?P\.?|B\.?V\.?|SAE|S\.?A\.?S\?|AG|partnership)+$", 1, 2),
)
WHOLE_IF_MORE, WHOLE_ALWAYS = 4, 9  # of these the name is the whole text, if anything follows or always
MOST_RAW, MOST_CLEAN = 300, 120
#: What the last pattern's texts end with after a name: a sign, then signs and legal forms. The same strings as that pattern's own end,
#: each of which this one reads in one way only: a dot that a form may end with is a sign of its own.
_FORMS = r"[., ](?:[., ]|ltd|company|co|S(?:\.?A)?|S\.?(?:A\.?)?R\.?L|limited|inc|incorporated|corp|pty|private|gmbh|L\.?P|B\.?V|SAE|S\.?A\.?S\?|AG|partnership)+$"

# Cells that are captions rather than companies.
CAPTIONS = r"(?i)^\(?(Names? of (Subsidiar|Compan|Entit)(y|ies)|Name|Subsidiar(y|ies)|[\d\.]+|Corporation|Entity|Jurisdiction|Incorporated State|Partners|Shareholders?|Managers?|Members?|Country of Organization|Doing Business As|Names?|Organizedunderlaws of|[a-z]{2}|(Corporation|Company|Subsidiary|Entity|Legal) Names?|Company|.):?\.?%?\)?$"
# What is cut from a company's name, in order.
COMPANY_STEPS = (
    (r"\s\s+", " "),
    (r"^[\*\s\-•·•]+", ""),
    (r"[;,\s\*]+$", ""),
    (r"(?i)\([\d\.\%\*]+ ?(owned|interest)?\)$", ""),
    (r"\(\w\)$", ""),
    (r"[;,\s\*]+$", ""),
    (r"(?i)^Exhibit [\d\.]+(( list of)? Subsidiaries( of( the)? ((registrant|company) )?)?)?", ""),
    (r"(?i) is a (substantially )?wholly-owned.*$", ""),
    (r"(?i)[,\s]*(and its subsidiar(y|ies)|general partner of):?\s*$", ""),
)
# Numbering and stray marks around a cell's text, in order.
CELL_STEPS = ((r"^\(([^\)]+)\)", "$1"), (r"^\(?\d+\.[\)\d%]* ", ""), (r"^o ", ""), (r",$", ""), (r"^([^\.]+)\.$", "$1"))
# Captions of the company and the place column.
COMPANY_CAPTION = r"(?i)investment|subsidiar|entity|name|company|[^n]corporat"
PLACE_CAPTION = r"(?i)organiz|juris|incorporat|location|state|domicile|formatio|country|laws of"


def _groups(text: Column, pattern: str, groups: Sequence[int]) -> Column:
    """The groups of the first match, as the one array of an array, which is empty without a match; one pass over the text.

    The pattern is extended over the whole text, so that replacing it leaves the groups alone. Patterns that begin with any run, or
    with a run from a word character, match first where the first such run begins if they match at all; trying no other place keeps
    the time in proportion to the text.
    """
    flags, body = re.match(r"(\(\?\w+\))?(.*)", pattern, re.S).groups(default="")
    start = r"\A" if body.startswith("(.+?)") and "s" in flags else r"\A\W*" if body.startswith(r"(\w") and "s" in flags else "" if body.startswith("^") else r"\A[\s\S]*?"
    made = F.regexp_replace(text, f"{flags}{start}{body}[\\s\\S]*", "\x01".join(["", *(f"${g}" for g in groups), ""]))
    # bound to a variable by a transform, so that the pattern runs once
    return F.transform(F.filter(F.array(made), lambda m: m.startswith("\x01")), lambda m: F.slice(F.split(m, "\x01"), 2, len(groups)))


def _before_forms(text: Column) -> Column:
    """_groups() of the last pattern, as fast as a text allows: that pattern tries every beginning with every space and every end.

    A text that doesn't end with forms is left at once, and only the line that does is tried, since the pattern stays within a line.
    """
    return _groups(text, rf"(?i)^(?=[\s\S]*?{_FORMS})[\s\S]*?(?=.*+$)(\w.+?) \(?(.+?)\)?{_FORMS}", (1, 2))


def single_candidates(text: Column) -> Column:
    """The candidates (sub, company, place) of one string, the pattern's number as sub; empty for long or wordless texts."""
    text = F.translate(text, "\x01", " ")
    squeezed = F.regexp_replace(text, r"\s\s+", " ")

    def candidates(n: int, pattern: str, company: int, place: int) -> Column:
        of = squeezed if n == WHOLE_ALWAYS else text
        hit = _before_forms(of) if n == WHOLE_ALWAYS else _groups(of, pattern, (company, place, 3) if n == WHOLE_IF_MORE else (company, place))

        def made(g: Column) -> Column:
            name = of if n == WHOLE_ALWAYS else F.when(g[2] != "", of).otherwise(g[0]) if n == WHOLE_IF_MORE else g[0]
            return F.struct(F.lit(n).alias("sub"), name.alias("company"), g[1].alias("place"))

        return F.transform(hit, made)

    found = [candidates(n, *p) for n, p in enumerate(SINGLE_PATTERNS)]
    usable = (F.length(text) < MOST_RAW) & text.rlike(r"\w")
    return F.when(usable, F.concat(*found)).otherwise(F.array().cast("array<struct<sub:int,company:string,place:string>>"))


def judged_cells(cells: DataFrame, places: Places, stop_terms: DataFrame) -> DataFrame:
    """(cell, company, company_ok, company_at, place, place_ok, place_at) of the distinct strings of cells (cell).

    Every string is cleaned once as a company and once as a place, and all clean strings are looked up among the places once.
    """
    d = spread(cells.filter("cell is not null").distinct(), "cell").withColumn("_0", clean_contents(F.col("cell")))
    folded = fold_signs(F.col("_0"))
    fine = (F.length("_0") > 0) & (F.length("_0") < MOST_RAW) & ~folded.rlike(r"^\(?[0-9]+\.[)0-9%]*$")
    d = d.withColumn("_1", apply_steps(folded, CELL_STEPS)).withColumn("_fine", fine)
    d = d.withColumn("company", strip_junk(apply_steps(F.col("_1"), COMPANY_STEPS))).withColumn("place", strip_junk(F.col("_1")))
    terms = small(stop_terms.select(F.lower("term").alias("_term")).distinct())
    for c in ("company", "place"):
        x = F.col(c)
        d = d.join(terms.withColumnRenamed("_term", f"_stop_{c}"), F.lower(x) == F.col(f"_stop_{c}"), "left")
        ok = F.col("_fine") & x.rlike("[A-Za-z]") & ~x.rlike(r"^\(?[0-9.]+\)?$") & (F.length(x) > 1) & (F.length(x) <= MOST_CLEAN) & F.col(f"_stop_{c}").isNull()
        if c == "company":
            ok = ok & ~F.col("_1").rlike(CAPTIONS) & ~F.col("_1").rlike("(?i)^combined ownership of ")
        d = d.withColumn(f"{c}_ok", F.coalesce(ok, F.lit(False)))
    d = written(d.select("cell", "company", "company_ok", "place", "place_ok"), "cells")
    texts = spread(d.select(F.explode(F.array("company", "place")).alias("text")).filter("text is not null").distinct(), "text")
    found = look_up(texts, "text", places).select("text", F.struct(F.col("place_clean").alias("clean"), F.col("country_code").alias("cc"), F.col("subdiv_code").alias("sc")).alias("at"))
    found = written(found, "cell-places")
    for c in ("company", "place"):
        d = d.join(found.withColumnsRenamed({"text": f"_text_{c}", "at": f"{c}_at"}), F.col(c) == F.col(f"_text_{c}"), "left").drop(f"_text_{c}")
    return d


def validate(candidates: DataFrame, company: str, place: str, places: Places, stop_terms: DataFrame) -> DataFrame:
    """candidates with company_clean, place_clean, country_code, subdiv_code and status.

    status is ok, bad_location (a plausible company whose place isn't known) or rejected. A company that is itself a place changes
    sides with the place; if both are places the candidate is rejected. Strings are judged once each, in a dictionary of the
    distinct ones, which is joined back for either side.
    """
    cells = written(judged_cells(candidates.select(F.explode(F.array(company, place)).alias("cell")), places, stop_terms), "judged-cells")
    own = cells.select(F.col("cell").alias("_c"), F.struct(F.col("company").alias("text"), F.col("company_ok").alias("ok"), F.col("company_at").alias("at")).alias("v_c"))
    other = cells.select(F.col("cell").alias("_p"), F.struct(F.col("place").alias("text"), F.col("place_ok").alias("ok"), F.col("place_at").alias("at")).alias("v_p"))
    d = candidates.join(own, F.col(company) == F.col("_c"), "left").join(other, F.col(place) == F.col("_p"), "left")
    c, p = F.col("v_c"), F.col("v_p")
    fine, swap, known = F.coalesce(c["ok"] & p["ok"], F.lit(False)), c["at"]["cc"].isNotNull(), p["at"]["cc"].isNotNull()
    pick = lambda x, y: F.when(swap, x).otherwise(y)
    status = F.when(~fine | (swap & known), "rejected").when(~swap & ~known, "bad_location").otherwise("ok")
    return d.select(
        *candidates.columns, pick(p["text"], c["text"]).alias("company_clean"), pick(c["at"]["clean"], p["at"]["clean"]).alias("place_clean"),
        pick(c["at"]["cc"], p["at"]["cc"]).alias("country_code"), pick(c["at"]["sc"], p["at"]["sc"]).alias("subdiv_code"), status.alias("status"),
    )


#: Characters of the units that a Python worker holds before it sends them on; a unit counts so many beside its text.
OUT_CHARACTERS, _UNIT_CHARACTERS = 2 << 20, 200
UNIT = "filing_id long, table_num int, row_num int, stage int, rank int, seq int, kind string, a string, b string, indent int, method string"


def _number(text: str) -> float:
    m = re.match(r"-?[0-9.]+", re.sub(r"\s|px|em|pt|in|%", "", text or ""))
    try:
        return float(m[0]) if m else 0.0
    except ValueError:
        return 0.0


def style_indent(style: str) -> float:
    """margin-left (or the fourth margin) plus text-indent without units, if that's a real indent, else 0."""
    m = re.search(r"margin-left: ?([^;\"]+);?(?: ?text-indent:?([^;\"]+))?", style, re.I) or re.search(
        r"margin: ?\S+ \S+ \S+ ([^;\"]+);?(?: ?text-indent:?([^;\"]+))?", style, re.I
    )
    if not m:
        return 0.0
    margin, indent = _number(m[1]), _number(m[2])
    return margin + indent if margin > 0 and margin + indent and margin not in (indent, -indent) else 0.0


_SMALL, _SMALL_END = re.compile(r"<su[pb]\b[^>]*>", re.I), re.compile(r"</su[pb]>", re.I)


def repaired(html: str) -> str:
    """Without superscripts and subscripts, and with rows that hold nothing, or only open another, removed; one pass, whatever is open."""
    kept, at = [], 0
    while (opened := _SMALL.search(html, at)) and (closed := _SMALL_END.search(html, opened.end())):
        kept.append(html[at : opened.start()])
        at = closed.end()
    html = "".join([*kept, html[at:]])
    html = re.sub(r"(?is)<tr[^>]*>\s*(?=<tr\b)", "", html)
    return re.sub(r"(?is)<tr[^>]*>\s*</tr>", "", html)


def _elements(node, stage: int, base: int) -> Iterator[tuple]:
    """Units of innermost div, p, font and pre elements, one rank a kind, then of what lies between breaks."""
    seq = 0
    for k, tag in enumerate(("div", "p", "font", "pre")):
        for found in node.find(tag):
            if found.has(tag):
                continue
            indent = int(max([0.0, *(style_indent(x.attrs.get("style", "")) for x in found.walk())]))
            lines = found.text("\n").split("\n") if tag == "pre" or found.has("br") else []
            if len(lines) > 1:
                for line in lines:
                    seq += 1
                    yield stage, base + 2 * k, seq, "single", line, None, indent, f"{tag}, between breaks"
            if tag != "pre":
                seq += 1
                yield stage, base + 2 * k + (len(lines) > 1), seq, "single", found.text(" "), None, indent, tag
    parts = [x.strip() for x in node.text("\n").split("\n")]
    if len(parts) > 1:
        address = re.match(r"^([^,]+),\s+(\D+)\s+[\d\- ]+$", parts[-1])
        if address:
            yield stage, base + 8, 0, "pair", parts[0], f"{address[1]}, {address[2]}", 0, "full address"
        for n, part in enumerate(parts):
            yield stage, base + 9, n, "single", part, None, 0, "between breaks"


def table_rows(table) -> list[list]:
    """The cells of each row that belong to this table and not to one inside it."""
    return [[c for c in r.cells if c.table is table] for r in table.rows]


def units_of(content: str) -> Iterator[tuple]:
    """(table_num, row_num, stage, rank, seq, kind, a, b, indent, method) of one exhibit.

    Stages of a table: 0 row by row, 1 by its captions, 2 the first two worded cells of a row; later ones count only if the earlier
    ones of the table give nothing. Stage 3, the elements of the whole document, counts only if no table gives anything.
    """
    from corvane.sources.tree import parse

    root = parse(repaired(content))
    columns = (None, None)
    for t, table in enumerate(root.find("table")):
        rows = table_rows(table)
        columns, header = _caption_columns(rows, columns)
        said = [[re.sub(r"[\r\n]", " ", c.text(" ")) for c in cells] for cells in rows]
        for r, company, place in _by_captions(said, columns, header):
            yield t, r, 1, 0, 0, "pair", company, place, 0, "by captions"
        for r, (cells, texts) in enumerate(zip(rows, said, strict=True)):
            first = next((x for x in texts if x.strip()), "")
            single = not re.match(r"^\s*(?:\(.+\)|\(?\*+\)?)\s*$", first)
            indent = next((i for i in (style_indent(x.attrs.get("style", "")) for c, s in zip(cells, texts, strict=True) if s for x in c.walk()) if i), 0.0)
            lead = 0
            for x in texts:
                if re.search(r"[^\s−-]", x):
                    break
                lead += 1
            indent = int(indent + lead + (len(re.match(r"[\s−-]*", first)[0]) if not lead else 0))
            parts = [x for x in texts if re.search(r"\w", x)]
            if len(parts) == 1 and single:
                yield t, r, 0, 0, 0, "single", parts[0], None, indent, "row, one cell"
            for rank, (i, j) in enumerate(((0, 1), (0, 2), (2, 1))):
                if len(parts) > max(i, j):
                    yield t, r, 0, rank, 0, "pair", parts[i], parts[j], indent, f"row, cells {i} and {j}"
            for cell in cells:
                for unit in _elements(cell, 0, 10):
                    yield t, r, *unit
            if len(parts) > 1:
                yield t, r, 2, 0, 0, "first", parts[0], SEPARATOR.join(parts[1:]), indent, "first two cells"
    for n, unit in enumerate(_elements(root, 3, 0)):
        yield -1, n, *unit


def _caption_columns(rows: list[list], known: tuple) -> tuple[tuple, int]:
    """Columns of the company and, in a later cell, of the place, and the captions' row; those of an earlier table if there are none."""
    company = place = None
    for r, cells in enumerate(rows):
        for k, cell in enumerate(cells):
            text = cell.trimmed()
            if company is None and re.search(COMPANY_CAPTION, text):
                company = k
            elif company is not None and place is None and re.search(PLACE_CAPTION, text):
                place = k
        if company is not None and place is not None:
            return (company, place), r
    return (company if company is not None else known[0], place if place is not None else known[1]), -1


def _by_captions(rows: list[list[str]], columns: tuple, header: int) -> Iterator[tuple[int, str, str]]:
    """(row, company, place) of the rows below the captions, by their columns.

    Columns move to the right after a cell that says 1, and in the first row where one of the two is blank, and stay moved for the
    rows below. A row counts as the first until both cells of one say something.
    """
    company, place = columns
    if company is None or place is None or company == place:
        return
    first = True
    for r, texts in enumerate(rows):
        if r <= header:
            continue
        says = lambda k: re.search(r"\w", texts[k]) if k < len(texts) else None  # noqa: B023, E731
        if company < len(texts) and re.match(r"^\s*1\.?\s*$", texts[company]):
            company, place = company + 1, place + 1
            while company < len(texts) and not says(company):
                company, place = company + 1, place + 1
        if first and says(company) and not says(place):
            place = next((k for k in range(place, len(texts)) if says(k)), place)
        if first and says(place) and not says(company):
            company = next((k for k in range(company, len(texts)) if says(k)), company)
        if company == place:
            company, place = columns
        if max(company, place) < len(texts) and texts[company].strip() and texts[place].strip():
            first = False
            yield r, texts[company], texts[place]


#: What plain text lacks.
MARKUP = r"(?i)<(?:html|table|body|div|p|br|font|pre)\b"
SEPARATOR = "\x02"
_TEXT_METHODS = ("text, fields 0 and 1", "text, fields 2 and 1", "text, one field", "text, wide gap")


def text_units(lines: DataFrame, text: str) -> DataFrame:
    """The plain-text strategies natively: lines with the array units (rank, kind, a, b) of one line each."""
    parts = F.filter(F.split(F.trim(F.col(text)), r"\s\s\s+"), lambda x: x != "")
    kind = "struct<rank:int,kind:string,a:string,b:string>"

    def unit(rank: int, name: str, a: Column, b: Column, held: Column) -> Column:
        return F.when(held, F.struct(F.lit(rank).alias("rank"), F.lit(name).alias("kind"), a.alias("a"), b.alias("b")).cast(kind))

    def of(p: Column) -> Column:
        gap = r"^(.*?\S)\s\s\s+(\S.*?)(?:\s\s+|$)"
        wide = lambda k: F.regexp_extract(F.col(text), gap, k)
        return F.filter(F.array(
            unit(0, "pair", p[0], p[1], F.size(p) > 1), unit(1, "pair", p[2], p[1], F.size(p) > 2), unit(2, "single", F.col(text), F.lit(None).cast("string"), F.lit(True)),
            unit(3, "pair", wide(1), wide(2), F.col(text).rlike(gap)),
        ), lambda x: x.isNotNull())

    return lines.withColumn("units", F.transform(F.array(parts), of)[0])


def unit_frames(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """UNIT rows of batches (filing_id, content), cut by their size and not where a batch ends: a document has any number of units."""
    names, rows, held = [c.strip().split(" ")[0] for c in UNIT.split(",")], [], 0
    for batch in batches:
        for f, content in zip(batch["filing_id"], batch["content"], strict=True):
            for u in units_of(content or ""):
                rows.append((f, *u))
                held += _UNIT_CHARACTERS + sum(len(x) for x in u[6:8] if x)
                if held > OUT_CHARACTERS:
                    yield pd.DataFrame(rows, columns=names)
                    rows, held = [], 0
    if rows:
        yield pd.DataFrame(rows, columns=names)


def exhibit_units(exhibits: DataFrame) -> DataFrame:
    """UNIT rows of exhibits (filing_id, content): of marked-up ones by one Arrow-batched pass, of plain text by built-in functions."""
    ship(exhibits.sparkSession)
    rows = spread(exhibits.select(F.col("filing_id").cast("long").alias("filing_id"), F.coalesce("content", F.lit("")).alias("content")), "filing_id")
    marked = rows.filter(F.col("content").rlike(MARKUP)).mapInPandas(unit_frames, UNIT)
    lines = rows.filter(~F.col("content").rlike(MARKUP)).select("filing_id", F.posexplode(F.split("content", "\n")).alias("row_num", "line"))
    plain = text_units(lines, "line").select("filing_id", "row_num", F.explode("units").alias("u"))
    plain = plain.select(
        "filing_id", F.lit(0).alias("table_num"), "row_num", F.lit(0).alias("stage"), "u.rank", F.lit(0).alias("seq"), "u.kind", "u.a", "u.b", F.lit(0).alias("indent"),
        F.element_at(F.array(*[F.lit(m) for m in _TEXT_METHODS]), F.col("u.rank") + 1).alias("method"),
    )
    return marked.unionByName(plain)


def extract_subsidiaries(exhibits: DataFrame, places: Places, stop_terms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(relationships, bad_locations) of exhibits (filing_id, content).

    relationships: filing_id, table_num, row_num, seq, company_name, location, country_code, subdiv_code, hierarchy, parse_method.
    """
    units = exhibit_units(exhibits)
    # of a row's other cells the first that says something beside junk
    worded = F.get(F.filter(F.transform(F.split("b", SEPARATOR), strip_junk), lambda x: x.rlike(r"\w")), 0)
    junk = units.withColumn("a", strip_junk(F.col("a"))).withColumn("b", F.when(F.col("kind") == "first", worded).otherwise(strip_junk(F.col("b"))))
    one = F.array(F.struct(F.lit(0).alias("sub"), F.col("a").alias("company"), F.col("b").alias("place")))
    found = junk.withColumn("_c", F.explode(F.when(F.col("kind") == "single", single_candidates(F.col("a"))).otherwise(one))).select(*units.columns, "_c.*")
    # written, since what follows reads it several times, and each would parse the documents again
    found = written(found.drop("a", "b"), "candidates")
    judged = written(validate(found, "company", "place", places, stop_terms), "judged")
    ok = judged.filter("status = 'ok'")
    unit = ["filing_id", "table_num", "row_num", "stage", "rank", "seq"]
    rest = [c for c in ok.columns if c not in unit]
    first = written(ok.groupBy(*unit).agg(F.min_by(F.struct(*rest), "sub").alias("_b")).select(*unit, "_b.*"), "first-valid")
    # the pattern that won in a single string has to hold with the company and the place as they're rewritten, too
    singles = first.filter("kind = 'single'").drop("company", "place", "country_code", "subdiv_code", "status").withColumnsRenamed({"company_clean": "company", "place_clean": "place"})
    again = validate(singles, "company", "place", places, stop_terms).filter("status = 'ok'")
    best = written(first.filter("kind <> 'single'").unionByName(again), "valid")
    # the least stage of each table, then the least rank of each row; the whole document only where no table gave anything
    stages = best.groupBy("filing_id", "table_num").agg(F.min("stage").alias("_stage"))
    any_ = best.filter("stage < 3").select("filing_id").distinct()
    doc = best.filter("stage = 3").join(any_, "filing_id", "left_anti")
    doc_rank = doc.groupBy("filing_id").agg(F.min(F.floor(F.col("rank") / 2)).alias("_kind"))
    doc = doc.join(doc_rank, "filing_id").filter(F.floor(F.col("rank") / 2) == F.col("_kind")).drop("_kind")
    table = best.filter("stage < 3").join(stages, ["filing_id", "table_num"]).filter("stage = _stage").drop("_stage")
    ranks = table.groupBy("filing_id", "table_num", "row_num").agg(F.min("rank").alias("_rank"))
    table = table.join(ranks, ["filing_id", "table_num", "row_num"]).filter("rank = _rank").drop("_rank")
    relationships = table.unionByName(doc).select(
        "filing_id", "table_num", "row_num", "seq", F.col("company_clean").alias("company_name"), F.col("place_clean").alias("location"), "country_code",
        "subdiv_code", F.col("indent").alias("hierarchy"), F.col("method").alias("parse_method"),
    )
    bad = judged.filter("status = 'bad_location'").select("filing_id", F.col("company_clean").alias("company_name"), F.col("place").alias("location")).distinct()
    return relationships, bad


def parse_accounting(exhibits: DataFrame, relationships: DataFrame) -> DataFrame:
    """(filing_id, has_html, num_tables, tables_parsed, rows_parsed, bad_sec21) of each exhibit; plain text has no tables."""
    html = F.col("content").rlike(r"(?i)<(?:html|table|body|div|p|br|font|pre)\b")
    base = exhibits.select("filing_id", F.coalesce(html, F.lit(False)).alias("has_html"), F.coalesce(F.regexp_count("content", F.lit(r"(?i)<table\b")), F.lit(0)).alias("num_tables"))
    per = relationships.groupBy("filing_id").agg(
        F.count_distinct(F.when((F.col("table_num") >= 0) & ~F.startswith("parse_method", F.lit("text, ")), F.col("table_num"))).cast("int").alias("tables_parsed"),
        F.count("*").alias("rows_parsed"),
    )
    out = base.join(per, "filing_id", "left").fillna(0, ["tables_parsed", "rows_parsed"])
    return out.withColumn("bad_sec21", F.col("rows_parsed") == 0)
