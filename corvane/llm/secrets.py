"""Secrets in texts: fixed patterns, and sliding-window entropy of candidate strings. DataFrame operations only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import id_and_text

# The patterns of the base kinds, in the order that breaks ties. Letters of assign's names match in either case.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy")

CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
ALPHABET = "0123456789abcdefABCDEFghijklmnopqrstuvwxyzGHIJKLMNOPQRSTUVWXYZ+/_=-"
HEX_CHARS = 22  # the first of ALPHABET
#: Windows have so many characters; one of hexadecimal digits alone needs the first entropy in bits, any other the second.
WINDOW, HEX_BITS, OTHER_BITS = 20, 2.8, 3.8
#: A candidate that the anchored one finds isn't reported: UUIDs. Windows that touch what the others find don't count: documentation
#: samples, runs of one character or of the alphabet.
ALLOWED = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"(?i)example|sample|placeholder|dummy",
    r"(.)\1{7}",
    r"(?i)abcdefghij|0123456789",
)
# What is left of a candidate beside the allowed runs and words: literals of ALLOWED may overlap each other and a run, so a run is
# replaced by its first and last character around a mark, then every character of a literal goes, then what remains at the mark.
ALLOWED_RUN, MARK = r"(.)\1{7,}", r"[^\n]?\r[^\n]?"
_LITERALS = [w for p in ALLOWED if p.startswith("(?i)") for w in p.removeprefix("(?i)").split("|")]
ALLOWED_LITERAL = "(?i)" + "|".join(f"(?<={w[:i]}){w[i]}(?={w[i + 1 :]})" for w in _LITERALS for i in range(len(w)))
BLOCK = 256
COUNT_BASE = 65  # the character that says 0


def _matches(text: Column, pattern: str, found: Column) -> tuple[Column, Column]:
    none = F.array().cast("array<string>")
    return (
        F.when(found, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none),
        F.when(found, F.split(text, pattern, -1)).otherwise(none),
    )


def _placed(matches: Column, gaps: Column, values: Column, kind: int) -> Column:
    """Structs (start, k, end, s, v) of matches, from the lengths of what lies between them.

    Places are running sums: within blocks of 256 matches first, then over the blocks, so that the work on a text with very many
    matches grows almost in proportion to them.
    """
    item = F.transform(
        F.arrays_zip(matches.alias("s"), F.slice(gaps, F.lit(1), F.size(matches)).alias("g"), values.alias("v")),
        lambda x: F.struct(F.length(x["g"]).alias("gap"), F.length(x["s"]).alias("n"), x["s"].alias("s"), x["v"].alias("v")),
    )
    n_blocks = F.ceil(F.size(matches) / BLOCK).cast("int")
    # the array is bound to a variable first, else it would be made again for each block
    blocks = F.transform(F.array(item), lambda xs: F.transform(F.sequence(F.lit(0), n_blocks - 1), lambda b: F.slice(xs, b * BLOCK + 1, F.lit(BLOCK))))[0]
    span = "array<struct<start:int,k:int,end:int,s:string,v:string>>"

    def within(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        made = F.struct(start.alias("start"), F.lit(kind).alias("k"), (start + x["n"]).alias("end"), x["s"].alias("s"), x["v"].alias("v"))
        return F.struct((start + x["n"]).alias("at"), F.concat(acc["out"], F.array(made)).cast(span).alias("out"))

    empty = F.struct(F.lit(0).alias("at"), F.array().cast(span).alias("out"))
    local = F.transform(blocks, lambda b: F.aggregate(b, empty, within))

    def over(acc: Column, b: Column) -> Column:
        moved = F.transform(
            b["out"],
            lambda x: F.struct((x["start"] + acc["at"]).alias("start"), x["k"].alias("k"), (x["end"] + acc["at"]).alias("end"), x["s"].alias("s"), x["v"].alias("v")),
        )
        return F.struct((acc["at"] + b["at"]).alias("at"), F.concat(acc["out"], F.array(moved)).cast(f"array<{span}>").alias("out"))

    first = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{span}>").alias("out"))
    return F.when(F.size(matches) > 0, F.flatten(F.aggregate(local, first, over)["out"])).otherwise(F.array().cast(span))


def _excess(string: Column) -> Column:
    """The largest excess, over all windows of string, of the window's entropy in bits over what its character class needs.

    The counts of the window's characters, one character each of a string, and the sum of c * log2(c) over them change by one
    character in and one out a step.
    """
    weights = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(WINDOW + 2)])
    none = chr(COUNT_BASE)

    def weight(n: Column) -> Column:
        return F.element_at(weights, n + 1)

    def count(counts: Column, code: Column) -> Column:
        return F.ascii(F.substr(counts, code + 1, F.lit(1))) - COUNT_BASE

    def changed(counts: Column, code: Column, n: Column) -> Column:
        return F.overlay(counts, F.chr(n + COUNT_BASE), code + 1, F.lit(1))

    def of(codes: Column) -> Column:
        start = F.struct(F.lit(none * len(ALPHABET)).alias("counts"), F.lit(0.0).alias("sum"), F.lit(0).alias("other"), F.lit(-99.0).alias("best"))

        def step(acc: Column, i: Column) -> Column:
            full = i >= WINDOW
            new = F.element_at(codes, i + 1)
            old = F.when(full, F.element_at(codes, F.greatest(F.lit(1), i + 1 - WINDOW))).otherwise(F.lit(0))
            c_old = F.when(full, count(acc["counts"], old)).otherwise(F.lit(0))
            less = F.when(full, weight(c_old) - weight(F.greatest(F.lit(0), c_old - 1))).otherwise(F.lit(0.0))
            counts = F.when(full, changed(acc["counts"], old, c_old - 1)).otherwise(acc["counts"])

            def entered(counts: Column) -> Column:
                c_new = count(counts, new)
                total = acc["sum"] - less + weight(c_new + 1) - weight(c_new)
                other = acc["other"] + F.when(new >= HEX_CHARS, 1).otherwise(0) - F.when(full & (old >= HEX_CHARS), 1).otherwise(0)
                over = F.lit(math.log2(WINDOW)) - total / WINDOW - F.when(other == 0, F.lit(HEX_BITS)).otherwise(F.lit(OTHER_BITS))
                best = F.when(i >= WINDOW - 1, F.greatest(acc["best"], over)).otherwise(acc["best"])
                return F.struct(changed(counts, new, c_new + 1).alias("counts"), total.alias("sum"), other.cast("int").alias("other"), best.alias("best"))

            return F.transform(F.array(counts), entered)[0]

        return F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), start, step)["best"]

    return F.transform(F.array(F.transform(F.split(string, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)), of)[0]


def _beside_allowed(string: Column) -> Column:
    """The pieces of string between what the unanchored patterns of ALLOWED match; a window in a piece overlaps no match."""
    marked = F.regexp_replace(string, ALLOWED_RUN, "$1\r$1")
    return F.split(F.regexp_replace(F.regexp_replace(marked, ALLOWED_LITERAL, "\n"), MARK, "\n"), "\n+")


def _overlaps(spans: Column, x: Column) -> Column:
    """Whether x overlaps one of spans, which are sorted and apart: a binary search finds the first that ends after x begins."""

    def halve(at: Column, _: Column) -> Column:
        middle = F.shiftright(at["lo"] + at["hi"], 1)
        after = F.get(spans, middle)["end"] > x["start"]
        closed = at["lo"] >= at["hi"]
        lo = F.when(closed | after, at["lo"]).otherwise(middle + 1)
        return F.struct(lo.alias("lo"), F.when(~closed & after, middle).otherwise(at["hi"]).alias("hi"))

    begun = F.struct(F.lit(0).alias("lo"), F.size(spans).alias("hi"))
    first = F.aggregate(F.sequence(F.lit(0), F.length(F.bin(F.size(spans).cast("long")))), begun, halve)["lo"]
    return F.when(F.size(spans) > 0, F.coalesce(F.get(spans, first)["start"] < x["end"], F.lit(False))).otherwise(F.lit(False))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, found of every row; found has (start, end, kind, string).

    Base kinds are matched leftmost and without overlaps: assign (matches whose value has under 6 characters are dropped after
    matching), access and hex. Candidates of 20 or more characters with letters and digits that lie in no base span are added as kind
    entropy if any window of 20 characters that touches nothing the allow-list matches has the entropy that its class needs. UUIDs
    are allowed whole.

    Places count code points from 0, ends are exclusive. Null and empty texts have no spans (base_sha256 is that of the empty
    string). Rows are judged one by one, so null or repeated identifiers and ties don't matter. Other columns aren't read, whatever
    their names. An empty table gives no rows.
    """
    text = F.col("text")
    rows = id_and_text(docs, id_col, text_col)
    made = []
    for k, (kind, pattern) in enumerate(zip(KINDS, (ASSIGN, ACCESS, HEX, CANDIDATE), strict=True)):
        rows = rows.withColumn(f"f{k}", text.rlike(pattern))
        m, g = _matches(text, pattern, F.col(f"f{k}"))
        v = F.when(F.col("f0"), F.regexp_extract_all(text, F.lit(pattern), F.lit(2))).otherwise(F.array().cast("array<string>")) if k == 0 else m
        made += [m.alias(f"m{k}"), g.alias(f"g{k}"), v.alias(f"v{k}")]
    rows = rows.select("doc_id", *made)
    rows = rows.select("doc_id", *[_placed(F.col(f"m{k}"), F.col(f"g{k}"), F.col(f"v{k}"), k).alias(f"s{k}") for k in range(4)])
    rows = rows.withColumn("s0", F.filter("s0", lambda x: F.length(x["v"]) >= 6))
    rows = rows.withColumn("base", F.array_sort(F.concat("s0", "s1", "s2")))

    def apart(x: Column) -> Column:
        return ~(_overlaps(F.col("s0"), x) | _overlaps(F.col("s1"), x) | _overlaps(F.col("s2"), x))

    whole = [p for p in ALLOWED if p.startswith("^")]
    parts = [p for p in ALLOWED if not p.startswith("^")]

    def candidate(x: Column) -> Column:
        fits = x["s"].rlike("[0-9]") & x["s"].rlike("[A-Za-z]")
        for pattern in whole:
            fits = fits & ~x["s"].rlike(pattern)
        return fits & apart(x)

    def dense(x: Column) -> Column:
        touched = F.lit(False)
        for pattern in parts:
            touched = touched | x["s"].rlike(pattern)
        some = F.exists(_beside_allowed(x["s"]), lambda p: (F.length(p) >= WINDOW) & (_excess(p) >= 0))
        return F.when(touched, some).otherwise(_excess(x["s"]) >= 0)

    rows = rows.withColumn("s3", F.filter("s3", candidate))
    rows = rows.withColumn("s3", F.filter("s3", dense))
    rows = rows.withColumn("every", F.array_sort(F.concat("base", "s3")))
    names = F.array(*[F.lit(x) for x in KINDS])

    def listed(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["k"] + 1), x["start"], x["end"])), ",")

    def described(spans: str) -> Column:
        return F.transform(spans, lambda x: F.struct(
            x["start"].alias("start"), x["end"].alias("end"), F.element_at(names, x["k"] + 1).alias("kind"), x["s"].alias("string"),
        ))

    return rows.select(
        "doc_id", *[F.size(f"s{k}").cast("long").alias(f"n_{KINDS[k]}") for k in range(3)],
        F.sha2(listed("base"), 256).alias("base_sha256"), listed("every").alias("spans"),
        described("every").alias("found"),
    )
