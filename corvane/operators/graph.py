"""Ownership hierarchies: indentation to parents, closure to the top parent, mutual parents."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.shared import written

_OUT = "array<struct<id: bigint, parent: bigint, level: int>>"
_ENTRIES = "array<struct<h: double, id: bigint>>"
_STACK = f"struct<parents: {_ENTRIES}, level: int, out: {_OUT}>"
_SUMMARY = f"struct<lows: array<double>, tail: {_ENTRIES}>"
#: Rows of a group are folded in blocks, whose results are put together at the end: a fold copies what it has gathered for each row.
BLOCK = 256
#: Rows of a part of a group, about; a larger group has several.
PART_ROWS = 65_536


def _indent_fold(rows: Column, stack: Column) -> Column:
    """(id, parent, level) of each of the ordered rows (o, id, h), from a stack of (h, id), one entry a level.

    A deeper indent goes down one level, however far it jumps; a smaller one goes up while the stack's entry is deeper. The row
    then takes its level's place, and its parent is the entry above.
    """

    def step(acc: Column, row: Column) -> Column:
        h, level, parents = row["h"], acc["level"], acc["parents"]
        depth = lambda k: F.element_at(parents, k + 1)["h"]
        down = h > depth(level)
        # going up ends at the deepest level, no deeper than this one, whose indent isn't above h, or else at 0
        fits = F.filter(F.sequence(F.lit(0), level), lambda k: (k == 0) | (depth(k) <= h))
        new = F.when(down, level + 1).otherwise(F.array_max(fits))
        me = F.struct(h.alias("h"), row["id"].alias("id"))
        stack = F.concat(F.slice(parents, F.lit(1), new), F.array(me))
        parent = F.when(new > 0, F.element_at(parents, F.greatest(new, F.lit(1)))["id"]).otherwise(F.lit(0).cast("bigint"))
        found = F.struct(row["id"].alias("id"), parent.alias("parent"), new.cast("int").alias("level"))
        return F.struct(stack.alias("parents"), new.cast("int").alias("level"), F.concat(acc["out"], F.array(found)).alias("out")).cast(_STACK)

    def block(acc: Column, part: Column) -> Column:
        start = F.struct(acc["parents"].alias("parents"), acc["level"].alias("level"), F.array().cast(_OUT).alias("out")).cast(_STACK)
        # bound to a variable, or the block would be folded once for each field
        return F.transform(F.array(F.aggregate(part, start, step)), lambda x: F.struct(
            x["parents"].alias("parents"), x["level"].alias("level"), F.concat(acc["outs"], F.array(x["out"])).alias("outs"),
        ))[0]

    first = F.struct(stack.cast(_ENTRIES).alias("parents"), (F.size(stack) - 1).alias("level"), F.array().cast(f"array<{_OUT}>").alias("outs"))
    return F.flatten(F.aggregate(_blocks(rows), first, block)["outs"])


def _blocks(rows: Column) -> Column:
    return F.transform(F.array(rows), lambda xs: F.transform(F.sequence(F.lit(0), F.ceil(F.size(xs) / BLOCK).cast("int") - 1), lambda b: F.slice(xs, b * BLOCK + 1, F.lit(BLOCK))))[0]


def _summary(rows: Column) -> Column:
    """(lows, tail): what ordered rows do to any stack that they begin with.

    Rows under all before them in the run are its lows; each of them takes from the stack what is deeper, and one entry more, whose
    place it takes. What comes after the last low is the tail, which ends up above what is left. Two such summaries combine to one.
    """

    def step(acc: Column, row: Column) -> Column:
        tail, me = acc["tail"], F.array(F.struct(row["h"].alias("h"), row["id"].alias("id")))
        fits = F.size(F.filter(tail, lambda e: e["h"] <= row["h"]))
        low = fits == 0
        deeper = ~low & (F.element_at(tail, F.greatest(F.size(tail), F.lit(1)))["h"] < row["h"])
        kept = F.when(low, F.array().cast(_ENTRIES)).when(deeper, tail).otherwise(F.slice(tail, F.lit(1), F.greatest(fits - 1, F.lit(0))))
        return F.struct(F.when(low, F.concat(acc["lows"], F.array(row["h"]))).otherwise(acc["lows"]).alias("lows"), F.concat(kept, me).alias("tail")).cast(_SUMMARY)

    empty = F.struct(F.array().cast("array<double>").alias("lows"), F.array().cast(_ENTRIES).alias("tail")).cast(_SUMMARY)
    return F.aggregate(rows, empty, step)


def _after(stack: Column, summary: Column) -> Column:
    """The stack that rows of a summary leave of one that they begin with."""

    def low(acc: Column, h: Column) -> Column:
        top = F.element_at(acc["stack"], F.greatest(F.size(acc["stack"]), F.lit(1)))["h"]
        pushed = acc["first"] & (F.size(acc["stack"]) > 0) & (top < h)
        fits = F.filter(acc["stack"], lambda e: e["h"] <= h)
        return F.struct(F.lit(False).alias("first"), F.when(pushed, acc["stack"]).otherwise(F.slice(fits, F.lit(1), F.greatest(F.size(fits) - 1, F.lit(0)))).alias("stack"))

    begun = F.struct(F.lit(True).alias("first"), stack.alias("stack"))
    return F.concat(F.aggregate(summary["lows"], begun, low)["stack"], summary["tail"])


def _indents(rows: DataFrame, group: str, order: str, entity: str, indent: str, part_rows: int = PART_ROWS) -> DataFrame:
    """(group, pos, id, parent, level) of the rows of groups with more than one indent.

    Rows are dealt to ranges of (group, order), so that a large group is spread over tasks. The parts of a group are summed up, each
    by itself; a scan over the summaries gives the stack that each part begins with; then each part is folded. Rows that agree
    in the order go by entity and indent.
    """
    item = F.struct(F.col(order).alias("o"), F.col(entity).cast("bigint").alias("id"), F.col(indent).cast("double").alias("h"))
    plain = rows.select(F.col(group).alias("g"), item.alias("x"))
    n = -(-plain.count() // part_rows)
    spread = written(plain.repartitionByRange(max(1, n), "g", "x").withColumn("part", F.spark_partition_id()), "indents")
    parts = spread.groupBy("g", "part").agg(F.array_sort(F.collect_list("x")).alias("items"), F.min("x.h").alias("lo"), F.max("x.h").alias("hi"), F.count("*").alias("n"))
    root = F.array(F.struct(F.lit(0.0).alias("h"), F.lit(0).cast("bigint").alias("id"))).cast(_ENTRIES)
    summed = F.array_sort(F.collect_list(F.struct("part", "n", F.when(F.col("of") > 1, _summary(F.col("items"))).alias("s"))))
    facts = parts.groupBy("g").agg(F.min("lo").alias("glo"), F.max("hi").alias("ghi"), F.count("*").alias("of")).filter("not glo <=> ghi")
    per = parts.join(facts, "g").groupBy("g").agg(summed.alias("parts"))

    def scan(acc: Column, x: Column) -> Column:
        me = F.struct(x["part"].alias("part"), acc["stack"].alias("stack"), acc["n"].alias("before"))
        then = F.when(x["s"].isNull(), acc["stack"]).otherwise(_after(acc["stack"], x["s"]))
        return F.struct(then.alias("stack"), (acc["n"] + x["n"]).alias("n"), F.concat(acc["out"], F.array(me)).alias("out"))

    kind = f"array<struct<part: int, stack: {_ENTRIES}, before: bigint>>"
    begun = F.struct(root.alias("stack"), F.lit(0).cast("bigint").alias("n"), F.array().cast(kind).alias("out"))
    starts = per.select("g", F.explode(F.aggregate("parts", begun, scan)["out"]).alias("b")).select("g", "b.*")
    folded = parts.join(starts, ["g", "part"]).select("g", "before", F.posexplode(_indent_fold(F.col("items"), F.col("stack"))).alias("nth", "x"))
    return folded.select(F.col("g").alias(group), (F.col("before") + F.col("nth")).cast("int").alias("pos"), "x.id", "x.parent", "x.level")


def indent_parents(rows: DataFrame, group: str, order: str, entity: str, indent: str) -> DataFrame:
    """(group, entity, parent) from the indents of each group's ordered rows, groups of a single indent left out.

    The last row of a repeated entity wins; roots and own parents are left out.
    """
    found = _indents(rows, group, order, entity, indent).filter("parent <> 0 and parent <> id")
    last = found.groupBy(group, "id").agg(F.max_by("parent", "pos").alias("parent"))
    return last.select(group, F.col("id").alias(entity), "parent")


def indent_levels(rows: DataFrame, group: str, order: str, entity: str, indent: str) -> DataFrame:
    """(group, pos, entity, level): the depth to show each row at."""
    found = _indents(rows, group, order, entity, indent)
    return found.select(group, "pos", F.col("id").alias(entity), "level")


def distinct_edges(rows: DataFrame, child: str, parent: str, year: str) -> DataFrame:
    """(source, target, year): each parent-child edge of a year once, without loops."""
    edges = rows.filter(F.col(parent).isNotNull() & (F.col(parent) != F.col(child)))
    return edges.select(F.col(parent).alias("source"), F.col(child).alias("target"), F.col(year).alias("year")).distinct()


@dataclass
class Closure:
    """The way of each company-year to its top, as closure() finds it."""

    rows: DataFrame  # cw_id, year, top, n: parents to the top; open: no top within the paths' length, as in a cycle
    paths: list[DataFrame]  # t, y, to, n, open: 1, 2, 4, ... parents ahead
    most_steps: int

    def distances(self) -> DataFrame:
        """(year, n, open), each once: at most as many rows a year as there are steps, and one for the rows without a top."""
        short = F.least("n", F.lit(self.most_steps))
        return self.rows.select("year", F.when(~F.col("open"), short).alias("n"), "open").distinct()

    def tops(self, steps: int, merge: bool = False) -> DataFrame:
        """(cw_id, year, top_parent_id) after so many steps: rows with a nearer top are done, the others go by the digits of steps.

        merge gives merge_mutual() of it. Companies that are each other's top have parents, and the tops of rows that are done have
        none, so only the others are merged, and nothing is joined where there are no others.
        """
        done = ~F.col("open") & (F.col("n") <= steps)
        left = self.rows.filter(~done).select("cw_id", "year", F.col("cw_id").alias("top"))
        if not left.isEmpty():
            for k, path in enumerate(self.paths):
                if steps >> k & 1:
                    ahead = path.select(F.col("t").alias("_t"), F.col("y").alias("_y"), F.col("to").alias("_to"))
                    left = left.join(ahead, _at("top", "year"), "left").select("cw_id", "year", F.coalesce("_to", "top").alias("top"))
            if merge:
                left = written(left.withColumnRenamed("top", "top_parent_id"), "left")
                left = merge_mutual(left).withColumnRenamed("top_parent_id", "top")
        return self.rows.filter(done).select("cw_id", "year", "top").unionByName(left).withColumnRenamed("top", "top_parent_id")


def _at(node: str, year: str) -> Column:
    return (F.col(node) == F.col("_t")) & F.col(year).eqNullSafe(F.col("_y"))


def last_step(distances: set[int], most_steps: int = 100) -> int:
    """The step at which the rule of top_parents() ends, from the distances of all rows that have a top."""
    return min(next(m for m in range(1, most_steps + 2) if m not in distances or m >= most_steps) + 1, most_steps)


def closure(info: DataFrame, edges: DataFrame, most_steps: int = 100) -> Closure:
    """Each row's distance to its top: paths to 1, 2, 4, ... parents ahead come from those of half the length.

    A company whose path has reached a top leaves the work. Of several parents the one with the smallest id counts.
    """
    up = edges.groupBy("target", "year").agg(F.min("source").alias("parent")).filter("target <> parent")
    up = written(up.select(F.col("target").alias("t"), F.col("year").alias("y"), F.col("parent").alias("to")), "parents")
    named = lambda d, **names: d.select(*[F.col(c).alias(n) for c, n in names.items()])
    more = named(up, t="_t", y="_y").withColumn("open", F.lit(True))
    now = up.join(more, _at("to", "y"), "left").select("t", "y", "to", F.lit(1).alias("n"), F.coalesce("open", F.lit(False)).alias("open"))
    paths = [written(now, "paths")]
    while 1 << (len(paths) - 1) < most_steps and not paths[-1].filter("open").isEmpty():
        ahead = named(paths[-1], t="_t", y="_y", to="_to", n="_n", open="_open")
        longer = paths[-1].filter("open").join(ahead, _at("to", "y")).select("t", "y", F.col("_to").alias("to"), (F.col("n") + F.col("_n")).alias("n"), F.col("_open").alias("open"))
        paths.append(written(paths[-1].filter("not open").unionByName(longer), "paths"))
    rows = info.select("cw_id", "year").join(named(paths[-1], t="_t", y="_y", to="_to", n="n", open="open"), _at("cw_id", "year"), "left")
    rows = rows.select("cw_id", "year", F.coalesce("_to", "cw_id").alias("top"), F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("open", F.lit(False)).alias("open"))
    return Closure(written(rows, "tops"), paths, most_steps)


def top_parents(info: DataFrame, edges: DataFrame, most_steps: int = 100, merge: bool = False) -> DataFrame:
    """info (cw_id, year) with top_parent_id: itself, replaced by its parent of the year step by step.

    Of several parents the one with the smallest id counts, chosen before the join. The steps end when as many rows have a parent
    as in the step before, which is none in a graph without cycles, or after most_steps.

    The steps aren't made one by one: closure() gives each row's distance to its top, and so the step at which the rule ends, one
    after the smallest distance that no row has. Rows whose top is within it are done; the others, those of cycles among them, go as
    many steps as that number's binary digits say. merge gives merge_mutual() of the result.
    """
    found = closure(info, edges, most_steps)
    distances = {r.n for r in found.distances().filter("not open").select("n").distinct().collect()}  # at most most_steps
    return found.tops(last_step(distances, most_steps), merge)


def merge_mutual(info: DataFrame) -> DataFrame:
    """info (cw_id, year, top_parent_id) in which two companies that are each other's top get the larger id, and so do their dependants."""
    a = info.select(F.col("cw_id").alias("a"), F.col("year").alias("ay"), F.col("top_parent_id").alias("at"))
    b = info.select(F.col("cw_id").alias("b"), F.col("year").alias("by"), F.col("top_parent_id").alias("bt"))
    both = a.join(b, (F.col("at") == F.col("b")) & (F.col("bt") == F.col("a")) & (F.col("ay") == F.col("by")) & (F.col("a") != F.col("b")))
    merged = both.select(F.col("a").alias("_top"), F.col("ay").alias("_year"), F.greatest("a", "b").alias("_to")).distinct()
    out = info.join(merged, (F.col("top_parent_id") == F.col("_top")) & (F.col("year") == F.col("_year")), "left")
    return out.withColumn("top_parent_id", F.coalesce("_to", "top_parent_id")).drop("_top", "_year", "_to")


def cut_top_edges(edges: DataFrame, info: DataFrame) -> DataFrame:
    """edges (source, target, year) without those that lead to a top parent of their year."""
    tops = info.select(F.col("top_parent_id").alias("target"), "year").distinct()
    return edges.join(tops, ["target", "year"], "left_anti").select("source", "target", "year")


def degrees(info: DataFrame, edges: DataFrame) -> DataFrame:
    """info (cw_id, year) with num_children and num_parents, each side counted before it's joined."""
    children = edges.groupBy(F.col("source").alias("cw_id"), "year").agg(F.count_distinct("target").alias("num_children"))
    parents = edges.groupBy(F.col("target").alias("cw_id"), "year").agg(F.count_distinct("source").alias("num_parents"))
    out = info.join(children, ["cw_id", "year"], "left").join(parents, ["cw_id", "year"], "left")
    return out.fillna(0, ["num_children", "num_parents"])


def tops_with_degrees(tops: DataFrame, edges: DataFrame) -> DataFrame:
    """degrees() of tops (cw_id, year, top_parent_id), each company-year once, and of edges that are distinct: one shuffle, without joins."""
    none, no, one = F.lit(None).cast("long"), F.lit(0), F.lit(1)
    row = lambda d, c, top, child, parent: d.select(F.col(c).cast("long").alias("cw_id"), "year", top.cast("long").alias("top_parent_id"), child.alias("_c"), parent.alias("_p"))
    rows = row(tops, "cw_id", F.col("top_parent_id"), no, no).unionByName(row(edges, "source", none, one, no)).unionByName(row(edges, "target", none, no, one))
    found = rows.groupBy("cw_id", "year").agg(F.max("top_parent_id").alias("top_parent_id"), F.sum("_c").alias("num_children"), F.sum("_p").alias("num_parents"))
    return found.filter("top_parent_id is not null")
