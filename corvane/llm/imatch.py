"""Document fingerprints by I-Match with randomised lexicons. DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.llm.common import id_and_text, lower_ascii
from corvane.shared import written

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # what separates words, after A-Z are in lower case
#: The band of inverse document frequencies: words of at least one in RAREST documents and at most one in COMMONEST. The lexicon
#: thus has at most RAREST times as many words as a document has distinct ones on average, however many documents there are.
RAREST, COMMONEST = 5000, 10
#: Random subsets of the lexicon at one sampling rate, rates in a fingerprint, hexadecimal digits of a subset's hash.
SUBSETS, RATES, DIGITS = 32, 3, 4
EMPTY = "-" * DIGITS
#: A word's crc32 times the factor, of which 32 bits count: the lowest say its subset, the others decide at which rates it's sampled.
BITS, FACTOR = 32, 1_640_531_527
#: A lexicon with more words, or more bytes of them, isn't kept by every task but joined.
MOST_TERMS, MOST_BYTES = 1 << 21, 32 << 20
BLOCK = 1024  # slots of the lexicon's table that are made together


def bound(value: Column, use) -> Column:
    """use(value) with the value made once, however often use() names it."""
    return F.transform(F.array(value), use)[0]


def distinct_words(text: Column) -> Column:
    return F.array_remove(F.array_distinct(F.split(lower_ascii(text), SEPARATORS)), "")


def lexicon(texts: DataFrame, rarest: int = RAREST, commonest: int = COMMONEST) -> DataFrame:
    """(word) of the words in the band; document frequencies are counted over all rows of texts (text)."""
    n = texts.count()
    counted = texts.select(F.explode(distinct_words(F.col("text"))).alias("word")).groupBy("word").agg(F.count("*").alias("df"))
    return counted.filter((F.col("df") * rarest >= n) & (F.col("df") * commonest <= n)).select("word")


class Band:
    """Finds the words of texts that are in a lexicon (word), or all words where none is.

    A small lexicon is a table of slots by the word's hash, one scalar value that each task gets, and looking a word up reads one slot.
    A larger one is joined with the distinct texts' words. Both ways give the same words.
    """

    def __init__(self, words: DataFrame, most_terms: int = MOST_TERMS, most_bytes: int = MOST_BYTES):
        self.words = written(words, "lexicon")
        n, size = self.words.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("word")), F.lit(0))).first()
        self.table = self.slots = None
        if n <= most_terms and size <= most_bytes:
            self.slots = max(BLOCK, 1 << (n // 2).bit_length())  # a power of two, with two words at most on average
            slot = F.expr(f"cast(crc32(word) % {self.slots} as int)")
            spark = self.words.sparkSession
            filled = self.words.groupBy(slot.alias("slot")).agg(F.collect_list("word").alias("words"))
            every = spark.range(self.slots).select(F.col("id").cast("int").alias("slot"), F.array().cast("array<string>").alias("words"))
            full = filled.unionByName(every).groupBy("slot").agg(F.flatten(F.collect_list("words")).alias("words"))
            blocks = full.groupBy(F.expr(f"slot div {BLOCK}").alias("block")).agg(F.array_sort(F.collect_list(F.struct("slot", "words"))).alias("slots"))
            self.table = written(blocks.select("block", F.col("slots.words").alias("slots")), "lexicon-slots")

    def kept(self, rows: DataFrame, text: str, name: str) -> DataFrame:
        """rows with the column name, structs (w, c): the distinct words of the text in the lexicon, or all if none is, and their crc32."""
        if self.table is None:
            return self._joined(rows, text, name)
        one = self.table.agg(F.array_sort(F.collect_list(F.struct("block", "slots"))).alias("t")).select(F.col("t.slots").alias("t"))

        def inside(x: Column) -> Column:
            def held(m: Column) -> Column:
                slots = F.element_at(x["table"], (F.shiftright(m["c"], BLOCK.bit_length() - 1) % (self.slots // BLOCK) + 1).cast("int"))
                return F.array_contains(F.element_at(slots, (m["c"] % BLOCK + 1).cast("int")), m["w"])

            return bound(F.filter(x["words"], held), lambda some: F.when(F.size(some) > 0, some).otherwise(x["words"]))

        # the optimizer merges this column into the expression that uses it, so that no row ever holds the table
        rows = rows.withColumn("_table", one.scalar())
        return rows.withColumn(name, bound(F.struct(_hashed(F.col(text)).alias("words"), F.col("_table").alias("table")), inside)).drop("_table")

    def _joined(self, rows: DataFrame, text: str, name: str) -> DataFrame:
        keyed = rows.withColumn("_digest", F.sha2(text, 256))
        texts = keyed.select("_digest", _hashed(F.col(text)).alias("_words")).groupBy("_digest").agg(F.first("_words").alias("_words"))
        some = texts.select("_digest", F.explode("_words").alias("_m")).join(self.words, F.col("_m.w") == F.col("word"), "left_semi").groupBy("_digest").agg(F.collect_list("_m").alias("_some"))
        some = keyed.join(some, "_digest", "left").withColumn(name, F.when(F.size("_some") > 0, F.col("_some")).otherwise(_hashed(F.col(text))))
        return some.drop("_digest", "_some")


def _hashed(text: Column) -> Column:
    return F.transform(distinct_words(text), lambda w: F.struct(w.alias("w"), F.crc32(w).alias("c")))


def fingerprint(terms: Column) -> Column:
    """The fingerprint of distinct terms (w, c): the number of its first rate, and 32 hashes for each of three rates.

    Every term is by chance of one of 32 subsets and of a rate: half the terms stay from one rate to the next. A document is
    described from the first rate on that leaves it at most 32 terms, so that a hash, made of a subset's sorted terms, covers about
    one of them, and a change of some terms spares the other hashes. Equal documents thus agree in all hashes, similar ones in some.
    """
    mark = lambda c: c * FACTOR % (1 << BITS)

    def described(x: Column) -> Column:
        marks = F.sort_array(F.transform(x, lambda m: mark(m["c"])))
        # a rate's marks are under 2^(BITS - rate); all where there are few, else the first rate that leaves out the 33rd
        rate = bound(marks, lambda s: F.when(F.size(s) <= SUBSETS, F.lit(0)).otherwise(BITS + 1 - F.length(F.bin(F.element_at(s, SUBSETS + 1)))))
        powers = F.array(*[F.lit(1 << max(0, BITS - i)) for i in range(BITS + RATES + 1)])

        def of(r: Column) -> Column:
            kept = F.array_sort(F.transform(F.filter(x, lambda m: mark(m["c"]) < F.element_at(powers, r + 1)), lambda m: F.struct(m["w"].alias("w"), mark(m["c"]).alias("v"))))

            def row(members: Column, i: int) -> Column:
                def one(k: Column) -> Column:
                    own = F.filter(members, lambda m: (m["v"] % SUBSETS == k) & (m["v"] < F.element_at(powers, r + i + 1)))
                    return bound(own, lambda o: F.when(F.size(o) > 0, F.substring(F.md5(F.array_join(o["w"], " ")), 1, DIGITS)).otherwise(EMPTY))

                return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(SUBSETS - 1)), one), "")

            rows = bound(kept, lambda members: F.concat(*[row(members, i) for i in range(RATES)]))
            return F.concat(F.lpad(r.cast("string"), 2, "0"), rows)

        return bound(rate, of)

    return bound(terms, described)


def likeness(a: Column, b: Column) -> Column:
    """The share of equal hashes among the subsets that hold terms of either document, at the first rate that both have."""
    ra, rb = F.substring(a, 1, 2).cast("int"), F.substring(b, 1, 2).cast("int")
    rate = F.greatest(ra, rb)
    row = lambda x, r: F.substr(x, (F.lit(3) + (rate - r) * (SUBSETS * DIGITS)).cast("int"), F.lit(SUBSETS * DIGITS))

    def share(x: Column) -> Column:
        at = lambda s, i: F.substr(s, i * DIGITS + 1, F.lit(DIGITS))
        every = F.sequence(F.lit(0), F.lit(SUBSETS - 1))
        same = F.size(F.filter(every, lambda i: (at(x["p"], i) == at(x["q"], i)) & (at(x["p"], i) != EMPTY)))
        some = F.size(F.filter(every, lambda i: (at(x["p"], i) != EMPTY) | (at(x["q"], i) != EMPTY)))
        return F.when(some > 0, same / some).otherwise(F.lit(0.0))

    shared = F.transform(F.array(F.struct(row(a, ra).alias("p"), row(b, rb).alias("q"))), share)[0]
    return F.when(a == b, F.lit(1.0)).when(F.abs(ra - rb) >= RATES, F.lit(0.0)).otherwise(shared)


def with_previous(ids: DataFrame) -> DataFrame:
    """ids (none, turned, ...), in the order of the first two, with a struct prev of the row before; the first row's is the last.

    Rows are dealt to ranges; each range is worked on by itself, and only its last row meets those of the other ranges.
    """
    own = F.struct(*ids.columns)
    spread = written(ids.repartitionByRange("none", "turned").withColumn("part", F.spark_partition_id()), "identifiers")
    rows = spread.withColumn("prev", F.lag(own).over(Window.partitionBy("part").orderBy("none", "turned")))
    ends = spread.groupBy("part").agg(F.max(own).alias("last"))  # one row a range
    line, whole = Window.orderBy("part"), Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select("part", F.coalesce(F.lag("last").over(line), F.last("last").over(whole)).alias("before"))
    return rows.join(F.broadcast(ends), "part").withColumn("prev", F.coalesce("prev", "before")).drop("part", "before")


def document_fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rarest: int = RAREST, commonest: int = COMMONEST,
    most_terms: int = MOST_TERMS, most_bytes: int = MOST_BYTES,
) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row.

    The edited text has the first half of the text, of odd ones one more, and as much from the start of the next document in
    descending order of identifiers, the first one's after the last; a single document is its own next one. Texts move once
    for the pairing, halves once more.

    Null text counts as empty. A text without a word of the lexicon is described by all its words; texts without words have equal
    fingerprints and are like each other only. Rows that repeat an identifier have the same next document; of several rows of the
    next identifier, the text with the smallest SHA-256 counts. Null identifiers come after all others. Equal identifiers and texts
    give equal rows. Other columns aren't read, whatever their names. An empty table gives no rows.
    """
    texts = id_and_text(docs, id_col, text_col)
    band = Band(lexicon(texts, rarest, commonest), most_terms, most_bytes)
    # ~x falls as x rises, without an overflow
    rows = texts.select(F.col("doc_id").isNull().alias("none"), F.bitwise_not(F.coalesce("doc_id", F.lit(0))).alias("turned"), "text")
    rows = rows.withColumn("digest", F.unhex(F.sha2("text", 256)))
    printed = band.kept(rows, "text", "terms").select("none", "turned", "text", "digest", fingerprint(F.col("terms")).alias("print"))
    ids = printed.groupBy("none", "turned").agg(F.max(F.expr("length(text) div 2")).alias("half"), F.min(F.struct("digest", "print")).alias("least"), F.count("*").alias("n"))
    ids = written(ids, "identifiers")
    before = with_previous(ids.select("none", "turned", "half")).select("none", "turned", "prev")
    facts = ids.join(before, ["none", "turned"])
    # no digest of an identifier is under its least one; both uses of met deal the texts out by the same keys, so Spark does it once
    met = rows.select("none", "turned", "text", "digest").join(facts, ["none", "turned"])
    first = met.filter(F.col("digest") <= F.col("least.digest"))
    tails = first.select(F.col("prev.none").alias("to_none"), F.col("prev.turned").alias("to_turned"), F.expr("substring(text, 1, cast(prev.half as int))").alias("tail"), F.col("least.print").alias("next_print"))
    heads = first.withColumn("fingerprint", F.col("least.print"))
    if not ids.filter("n > 1").isEmpty():
        tails = tails.dropDuplicates(["to_none", "to_turned"])
        others = band.kept(met.filter(F.col("digest") > F.col("least.digest")), "text", "terms").withColumn("fingerprint", fingerprint(F.col("terms")))
        heads = heads.unionByName(others.drop("terms"))
    heads = heads.select("none", "turned", F.length("text").alias("n_chars"), F.expr("substring(text, 1, cast(length(text) - length(text) div 2 as int))").alias("head"), "fingerprint")
    both = heads.join(tails, (F.col("none") == F.col("to_none")) & (F.col("turned") == F.col("to_turned")))
    edited = both.withColumn("edited", F.concat("head", F.expr("substring(tail, 1, cast(n_chars div 2 as int))")))
    doc_id = F.when(~F.col("none"), F.bitwise_not("turned")).alias("doc_id")
    edited = edited.select(doc_id, "n_chars", "edited", "fingerprint", "next_print", F.sha2("edited", 256).alias("edited_sha256"))
    edited = band.kept(edited, "edited", "terms").withColumn("edited_fingerprint", fingerprint(F.col("terms")))
    return edited.select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"), likeness(F.col("fingerprint"), F.col("next_print")).alias("near_next"),
    )
