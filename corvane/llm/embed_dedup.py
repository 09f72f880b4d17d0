"""Near duplicates of embeddings: exact threshold pairs by a dual traversal of cover trees."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import connected_components, ship
from corvane.llm.forest import Forest
from corvane.shared import removed, written

#: Vectors of one block, about, and so half of what a task holds; a block pair is one task's work.
BLOCK_ROWS = 4096
#: A cell with more vectors is cut into up to so many around centres, and these again, level by level.
MOST_CENTRES, MOST_LEVELS = 64, 8
#: Centres of a cell are chosen among so many of its vectors for each; every vector is compared.
SAMPLE = 8
SLACK = 1e-6  # chord lengths near zero lose half of a double's digits


def unit(rows: list[np.ndarray]) -> np.ndarray:
    """Rows scaled to length 1, as doubles; scaling by the largest entry first avoids overflow."""
    x = np.array(rows, np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def chords(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (x @ y.T)))


class CoverNode:
    """Members of a tree within `radius` (a chord length) of a centre, which is a member; children halve the radius."""

    __slots__ = ("centre", "children", "members", "radius")

    def __init__(self, centre: int, radius: float, members: np.ndarray):
        self.centre, self.radius, self.members, self.children = centre, radius, members, None

    def parts(self, x: np.ndarray) -> list[CoverNode]:
        """The children, made when first asked for: the centre's own ball of half the radius, then balls around what is left."""
        if self.radius <= SLACK or len(self.members) == 1:
            return [self]
        if self.children is None:
            left = np.r_[self.centre, self.members[self.members != self.centre]]
            self.children = []
            while len(left):
                tried = left[:64]
                d = chords(x[tried], x[left])
                free = np.ones(len(left), bool)
                for k in range(len(tried)):
                    if free[k]:
                        mine = free & (d[k] <= self.radius / 2)
                        mine[k] = True
                        free &= ~mine
                        self.children.append(CoverNode(int(tried[k]), float(d[k][mine].max()) if mine.sum() > 1 else 0.0, left[mine]))
                left = left[free]
        return self.children


def cover_tree(x: np.ndarray, members: np.ndarray) -> CoverNode:
    return CoverNode(int(members[0]), float(chords(x[members[:1]], x[members]).max()), members)


def threshold_links(x: np.ndarray, weight: np.ndarray, n_own: int | None, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """(links, roots) of each row of x, whose rows have length 1.

    n_own None compares all rows with each other; otherwise the first n_own rows with the others. links adds up the weights of
    the rows linked; linked rows share a root. Node pairs farther apart than both radii and the threshold's chord are pruned,
    and those that must be nearer are linked as a whole.
    """
    reach = float(np.sqrt(2.0 - 2.0 * cosine))
    links, forest = np.zeros(len(x), np.int64), Forest(len(x))
    everything = np.arange(len(x))
    if not len(x) or n_own in (0, len(x)):
        return links, everything

    def whole(a: CoverNode, b: CoverNode) -> None:
        links[a.members] += weight[b.members].sum()
        links[b.members] += weight[a.members].sum()
        forest.add(np.r_[a.members, b.members], np.full(len(a.members) + len(b.members), a.members[0]))

    def within(a: CoverNode) -> None:
        links[a.members] += weight[a.members].sum() - weight[a.members]
        forest.add(a.members, np.full(len(a.members), a.members[0]))

    def exact(rows: np.ndarray, cols: np.ndarray) -> None:
        for i in range(0, len(rows), 512):
            r, c = np.nonzero(x[rows[i : i + 512]] @ x[cols].T >= cosine)
            pair(rows[i + r], cols[c])

    def pair(a: np.ndarray, b: np.ndarray) -> None:
        np.add.at(links, a, weight[b])
        np.add.at(links, b, weight[a])
        forest.add(a, b)

    if n_own is None:
        root = cover_tree(x, everything)
        stack = [(root, root)]
    else:
        stack = [(cover_tree(x, everything[:n_own]), cover_tree(x, everything[n_own:]))]
    while stack:
        a, b = stack.pop()
        same = a is b
        if same and 2 * a.radius <= reach - SLACK:
            within(a)
            continue
        mine = a.parts(x)
        theirs = mine if same else b.parts(x)
        if same:
            stack += [(n, n) for n in mine if len(n.members) > 1]
        mc, mr = np.array([n.centre for n in mine]), np.array([n.radius for n in mine])
        tc, tr = (mc, mr) if same else (np.array([n.centre for n in theirs]), np.array([n.radius for n in theirs]))
        single_m, single_t = np.array([len(n.members) == 1 for n in mine]), np.array([len(n.members) == 1 for n in theirs])
        for at in range(0, len(mine), 512):
            rows = slice(at, at + 512)
            dots = x[mc[rows]] @ x[tc].T
            d = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * dots))
            live = d <= mr[rows, None] + tr[None, :] + reach + SLACK
            if same:
                live &= np.arange(len(tc))[None, :] > (at + np.arange(live.shape[0]))[:, None]
            ones = single_m[rows, None] & single_t[None, :]
            r, c = np.nonzero(live & ones & (dots >= cosine))
            pair(mc[at + r], tc[c])
            for i, j in zip(*np.nonzero(live & ~ones), strict=True):
                p, q = mine[at + i], theirs[j]
                if d[i, j] + p.radius + q.radius <= reach - SLACK:
                    whole(p, q)
                elif p.radius <= SLACK and q.radius <= SLACK:
                    exact(p.members, q.members)
                else:
                    stack.append((p, q))
    return links, forest.roots(everything)


def _farthest(x: np.ndarray, want: int) -> np.ndarray:
    """Up to `want` rows of x, each the farthest from those before it; fewer where the rest coincide with them."""
    chosen, d = [0], chords(x[:1], x)[0]
    while len(chosen) < min(want, len(x)) and d.max() > SLACK:
        chosen.append(int(d.argmax()))
        d = np.minimum(d, chords(x[chosen[-1:]], x)[0])
    return x[chosen]


def _chord(a: Column, b: Column) -> Column:
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return F.sqrt(F.greatest(F.lit(0.0), 2.0 - 2.0 * dot))


def cells_of(distinct: DataFrame, reach: float, block_rows: int, sample: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The upper levels of the trees: (placed, cells, pairs).

    placed has every row of distinct (grp, node, weight, embedding) with its cell, a path of centres below its grp; cells has
    (grp, cell, n, radius); pairs has the (grp, a, b, ra, rb, d) of cells a <= b that may hold linked vectors. Cells with more than
    block_rows vectors are cut around up to MOST_CENTRES of them, again and again, unless all in them must link. Levels are
    traversed together: only children of node pairs that their covering radii leave are paired. The driver holds the centres, one
    vector for some thousands.
    """
    spark = distinct.sparkSession
    placed = distinct.select("grp", "node", "weight", "embedding", F.lit("").alias("cell"), F.lit(1.0).alias("away"))
    cells = written(placed.groupBy("grp", "cell").agg(F.count("*").alias("n"), F.max("away").alias("radius")), "cells")
    pairs = cells.select("grp", F.col("cell").alias("a"), F.col("cell").alias("b"), F.col("radius").alias("ra"), F.col("radius").alias("rb"), F.lit(0.0).alias("d"))
    every = None  # the centres so far, by cell
    for level in range(MOST_LEVELS):
        big = cells.filter((F.col("n") > block_rows) & (2 * F.col("radius") > reach - SLACK)).select("grp", "cell", "n")
        if big.isEmpty():
            break
        some = F.least(F.ceil(F.col("n") / block_rows), F.lit(MOST_CENTRES)).cast("int")
        big = big.withColumn("want", F.greatest(some, F.lit(2))).withColumn("rate", F.greatest(F.lit(64), F.col("want") * sample) / F.col("n"))
        drawn = F.pmod(F.xxhash64("node", F.lit(level)), F.lit(1 << 30)) < F.col("rate") * float(1 << 30)
        picked = placed.join(big, ["grp", "cell"]).filter(drawn).select("grp", "cell", "node", "want", "embedding")

        def choose(part: pd.DataFrame) -> pd.DataFrame:
            part = part.sort_values("node")
            x = _farthest(unit(list(part["embedding"])), int(part["want"].iloc[0]))
            return pd.DataFrame({"grp": part["grp"].iloc[0], "parent": part["cell"].iloc[0], "k": np.arange(len(x)), "centre": list(x)})

        made = picked.groupBy("grp", "cell").applyInPandas(choose, "grp string, parent string, k int, centre array<double>")
        made = written(made.withColumn("cell", F.concat("parent", F.lit("."), "k")), "centres")
        matrix: dict[tuple[str, str], list] = {}
        for r in made.orderBy("grp", "parent", "k").toPandas().itertuples():
            matrix.setdefault((r.grp, r.parent), []).append(r.centre)
        matrix = {k: np.array(v) for k, v in matrix.items() if len(v) > 1}
        if not matrix:
            break
        shared = spark.sparkContext.broadcast(matrix)

        def assign(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for (grp, cell), part in batch.groupby(["grp", "cell"], sort=False):
                    c = shared.value.get((grp, cell))
                    if c is not None:
                        d = chords(unit(list(part["embedding"])), c)
                        part = part.assign(cell=[f"{cell}.{k}" for k in d.argmin(axis=1).tolist()], away=d.min(axis=1))
                    yield part

        last, placed = placed, written(placed.mapInPandas(assign, placed.schema), "placed")
        removed(last)
        cells = written(placed.groupBy("grp", "cell").agg(F.count("*").alias("n"), F.max("away").alias("radius")), "cells")
        every = made if every is None else every.unionByName(made)
        deep = F.size(F.split("cell", r"\.")) - 1 == level + 1
        kids = cells.withColumn("parent", F.when(deep, F.regexp_replace("cell", r"\.[0-9]+$", "")).otherwise(F.col("cell")))
        kids = kids.join(every.select("grp", "cell", "centre"), ["grp", "cell"], "left").select("grp", "parent", "cell", "radius", "centre")
        left = kids.select("grp", F.col("parent").alias("a"), F.col("cell").alias("a2"), F.col("radius").alias("ra"), F.col("centre").alias("ca"))
        right = kids.select("grp", F.col("parent").alias("b"), F.col("cell").alias("b2"), F.col("radius").alias("rb"), F.col("centre").alias("cb"))
        both = pairs.select("grp", "a", "b").join(left, ["grp", "a"]).join(right, ["grp", "b"]).filter("a <> b or a2 <= b2")
        both = both.withColumn("d", F.when(F.col("a2") == F.col("b2"), F.lit(0.0)).otherwise(_chord(F.col("ca"), F.col("cb"))))
        both = both.filter((F.col("a2") == F.col("b2")) | F.col("d").isNull() | (F.col("d") <= F.col("ra") + F.col("rb") + reach + SLACK))
        pairs = written(both.select("grp", F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b"),
                                    F.when(F.col("a2") <= F.col("b2"), F.col("ra")).otherwise(F.col("rb")).alias("ra"),
                                    F.when(F.col("a2") <= F.col("b2"), F.col("rb")).otherwise(F.col("ra")).alias("rb"), "d"), "cell-pairs")
    return placed, cells, pairs


def embedding_dedup(
    vectors: DataFrame, cosine: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = "label",
    block_rows: int = BLOCK_ROWS, sample: int = SAMPLE,
) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row.

    Rows of one label and length link if their cosine is at least the threshold, in double precision. Equal vectors are collapsed
    first and count by their number. The distinct ones of a label are dealt to cells by the upper levels of a tree (cells_of), and
    cells to blocks. Block pairs that covering radii rule out are pruned; those in which all must link are linked by their sums, so a
    tight group costs no comparisons; each other pair is one task: a cover tree for either block, traversed together. Only counts
    and a spanning forest of a task's links leave it. Without a label_col all vectors are one group.

    Vectors that are null, empty or zero, or that hold null or non-finite entries, and rows whose label or identifier is null,
    link with nothing: n_links 0, component_id their own identifier, kept. Repeated rows, and rows of one identifier with several
    vectors or labels, are vectors of their own: each has its own links and component; all rows of the kept identifier are kept.
    Other columns aren't read, whatever their names. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    ship(spark)
    label = F.lit(0) if label_col is None else F.col(label_col)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("embedding"), label.alias("label"))
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    sound = F.coalesce(finite & F.exists("embedding", lambda v: v != 0), F.lit(False)) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    rows = rows.withColumn("sound", sound)
    grp = F.concat_ws(":", F.size("embedding").cast("string"), F.col("label").cast("string"))
    distinct = rows.filter("sound").groupBy("label", "embedding").agg(F.min("vec_id").alias("least"), F.count("*").alias("weight"))
    # a node is a row of this table: an identifier may stand at several
    distinct = written(distinct.withColumn("grp", grp).withColumn("node", F.monotonically_increasing_id()), "vectors")
    reach = float(np.sqrt(2.0 - 2.0 * cosine))
    placed, cells, pairs = cells_of(distinct, reach, block_rows, sample)

    splits = cells.select("grp", "cell", F.ceil(F.col("n") / block_rows).cast("int").alias("splits"))
    placed = placed.join(splits, ["grp", "cell"]).withColumn("part", F.pmod(F.xxhash64("node"), "splits").cast("int"))
    placed = written(placed.select("grp", "cell", "part", "node", "weight", "embedding"), "blocks")
    blocks = written(placed.groupBy("grp", "cell", "part").agg(F.sum("weight").alias("sum"), F.min("node").alias("first")), "block-sums")
    left = blocks.select("grp", *[F.col(c).alias(f"{c}1") for c in ("cell", "part", "sum", "first")])
    right = blocks.select("grp", *[F.col(c).alias(f"{c}2") for c in ("cell", "part", "sum", "first")])
    pairs = pairs.withColumnsRenamed({"a": "cell1", "b": "cell2"}).join(left, ["grp", "cell1"]).join(right, ["grp", "cell2"])
    pairs = pairs.filter("cell1 <> cell2 or part1 <= part2")
    pairs = pairs.withColumn("whole", F.coalesce(F.col("d") + F.col("ra") + F.col("rb") <= reach - SLACK, F.lit(False)))
    pairs = written(pairs.select("grp", "cell1", "part1", "cell2", "part2", "sum1", "sum2", "first1", "first2", "whole"), "block-pairs")
    itself = (F.col("cell1") == F.col("cell2")) & (F.col("part1") == F.col("part2"))

    tied = pairs.filter("whole")
    ends = tied.select("grp", F.col("cell1").alias("cell"), F.col("part1").alias("part"), F.col("sum2").alias("more"), itself.cast("int").alias("own"), F.col("first1").alias("root"))
    ends = ends.unionByName(tied.filter(~itself).select(
        "grp", F.col("cell2").alias("cell"), F.col("part2").alias("part"), F.col("sum1").alias("more"), F.lit(0).alias("own"), F.col("first2").alias("root")
    ))
    ends = ends.groupBy("grp", "cell", "part").agg(F.sum("more").alias("more"), F.max("own").alias("own"), F.min("root").alias("root"))
    by_sums = placed.drop("embedding").join(ends, ["grp", "cell", "part"]).select("node", (F.col("more") - F.col("own") * F.col("weight")).alias("links"), "root")

    left = pairs.filter(~F.col("whole")).drop("sum1", "sum2", "first1", "first2", "whole")
    task = F.concat_ws(":", "grp", "cell1", "part1", "cell2", "part2").alias("task")
    tasks = left.select("grp", F.col("cell1").alias("cell"), F.col("part1").alias("part"), task, F.lit(False).alias("second")).unionByName(
        left.filter(~itself).select("grp", F.col("cell2").alias("cell"), F.col("part2").alias("part"), task, F.lit(True).alias("second"))
    )

    def compare(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["second", "node"], ignore_index=True)
        own = int((~block["second"]).sum())
        both = own < len(block)
        links, root = threshold_links(unit(list(block["embedding"])), block["weight"].to_numpy(), own if both else None, cosine)
        some = np.flatnonzero(links > 0)
        node = block["node"].to_numpy()
        return pd.DataFrame({"node": node[some], "links": links[some], "root": node[root[some]]})

    dealt = placed.join(tasks, ["grp", "cell", "part"]).select("task", "second", "node", "weight", "embedding")
    by_task = dealt.groupBy("task").applyInPandas(compare, "node long, links long, root long")
    found = written(by_task.unionByName(by_sums), "links")
    edges = found.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(tied.select(F.col("first1").alias("a"), F.col("first2").alias("b")))
    parts = connected_components(edges)
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    known = distinct.drop("grp").join(counts, "node", "left").join(parts, "node", "left").filter("weight > 1 or links > 0")
    known = written(known.withColumn("component", F.coalesce("component", "node")), "linked")
    named = known.groupBy("component").agg(F.min("least").alias("component_id"))
    known = known.join(named, "component").select(
        F.col("label").alias("_label"), F.col("embedding").alias("_embedding"),
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n"), "component_id",
    )
    out = rows.join(known, (F.col("label") == F.col("_label")) & (F.col("embedding") == F.col("_embedding")) & F.col("sound"), "left")
    return out.select(
        "vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"),
        F.col("vec_id").eqNullSafe(F.coalesce("component_id", "vec_id")).alias("kept"),
    )
