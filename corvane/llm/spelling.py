"""Groups of spelling variants: pairs of words one edit apart by self-joins of tries with active-node sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import id_and_text, lower_ascii, ship
from corvane.shared import removed, written

RUN = r"[A-Za-zÀ-ÿ]"
#: Words of a group of the trie; one with more is cut at its window's middle. Rows of a task, about.
MOST_GROUP, TASK_ROWS = 16_384, 65_536


def misspelt_words(docs: DataFrame, every: int = 97, least_length: int = 5, least_count: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): the words of the texts and how often they occur, built-in functions only.

    Runs of fewer code points than a word needs are never made rows. Each task adds up its own words before any are dealt out, so a
    frequent word costs one row a task.
    """
    runs = F.regexp_extract_all(lower_ascii(F.col("text")), F.lit(RUN + "{%d,}" % least_length), F.lit(0))
    rows = id_and_text(docs, id_col, text_col).select(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("id"), F.explode(runs).alias("run"))
    rows = rows.withColumn("h", F.crc32(F.concat_ws(":", "id", "run")))
    cut = F.expr("concat(substring(run, 1, cast(h % length(run) as int)), substring(run, cast(h % length(run) as int) + 2))")
    rows = rows.select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("word")).filter(F.length("word") >= least_length)
    return rows.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_count)


class Trie:
    """A forest of tries over sorted rows: for each depth the parent, symbol, row that ends there and reach of every node.

    Nodes of a depth stand in the order of (parent, symbol), so the children of a node are neighbours.
    """

    def __init__(self, groups: np.ndarray, strings: list[str], longer: np.ndarray):
        lengths = np.fromiter(map(len, strings), np.int64, len(strings))
        codes = np.frombuffer("".join(strings).encode("utf-32-le"), np.uint32).astype(np.int64)
        offsets = np.cumsum(lengths) - lengths
        first = np.r_[True, groups[1:] != groups[:-1]]
        self.group = [groups[first]]
        self.parent, self.symbol, self.ends, self.long, self.short, self.child = [], [], [], [], [], []
        at, rows, depth = np.cumsum(first) - 1, np.arange(len(strings)), 0
        self._add(rows, at, first, lengths == 0, longer)
        while True:
            on = lengths[rows] > depth
            parents = at[on]
            rows = rows[on]
            n_before = len(self.group[-1])
            if not len(rows):
                self.child.append(np.zeros(n_before + 1, np.int64))
                break
            symbols = codes[offsets[rows] + depth]
            new = np.r_[True, (parents[1:] != parents[:-1]) | (symbols[1:] != symbols[:-1])]
            at, depth = np.cumsum(new) - 1, depth + 1
            self.parent.append(parents[new])
            self.symbol.append(symbols[new])
            self.group.append(groups[rows][new])
            self.child.append(np.searchsorted(parents[new], np.arange(n_before + 1)))
            self._add(rows, at, new, lengths[rows] == depth, longer[rows])

    def _add(self, rows: np.ndarray, at: np.ndarray, new: np.ndarray, end: np.ndarray, longer: np.ndarray) -> None:
        ends = np.full(int(new.sum()), -1, np.int64)
        ends[at[end]] = rows[end]
        starts = np.flatnonzero(new)
        self.ends.append(ends)
        self.long.append(np.logical_or.reduceat(longer, starts))
        self.short.append(np.logical_or.reduceat(~longer, starts))

    @property
    def depth(self) -> int:
        return len(self.parent)

    def children(self, d: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in nodes, child) for every child, at depth d + 1, of nodes of depth d."""
        low = self.child[d][nodes]
        n = self.child[d][nodes + 1] - low
        place = np.repeat(np.arange(len(nodes)), n)
        return place, np.arange(len(place)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)

    def step(self, d: int, nodes: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The child, at depth d + 1, that each node of depth d has by a symbol; -1 where there is none."""
        if d >= self.depth or not len(self.parent[d]):
            return np.full(len(nodes), -1)
        wide = 1 << 21
        keys, wanted = self.parent[d] * wide + self.symbol[d], nodes * wide + symbols
        found = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[found] == wanted, found, -1)


def near_rows(groups: np.ndarray, windows: np.ndarray, strings: list[str], longer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of one group that are one edit apart, each once; rows are sorted by (group, string).

    A group's strings are windows of words, with the word's next symbol where there is one; windows has their width without it.
    longer marks those of the longer words: pairs replace a symbol of two longer ones or insert one into a shorter one.

    The active nodes of a node are those at distance one that lead to such a pair. They're kept as two sets of node pairs for a
    depth, `same` (a symbol replaced) and `more` (one inserted, which lie a level apart). Both begin at their first difference
    and go down by equal symbols. A symbol inserted into a run of its like counts as the run's last one, so that a pair has one place.
    """
    trie = Trie(groups, strings, longer)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    none = np.zeros(0, np.int64)
    su, sv, iu, iv, fresh = none, none, none, none, np.zeros(0, bool)
    width = dict(zip(groups.tolist(), windows.tolist(), strict=True))

    def ended(d: int, a: np.ndarray, e: int, b: np.ndarray, a_long: bool) -> None:
        ra, rb = trie.ends[d][a], trie.ends[e][b]
        ok = (ra >= 0) & (rb >= 0)
        ra, rb = ra[ok], rb[ok]
        ok = (longer[ra] == a_long) & longer[rb]
        found.append((ra[ok], rb[ok]))

    for d in range(trie.depth + 1):
        if d:
            # pairs of the depth before go down by equal symbols
            place, child = trie.children(d - 1, su)
            other = trie.step(d - 1, sv[place], trie.symbol[d - 1][child])
            ok = (other >= 0) & trie.long[d][child]
            ok[ok] &= trie.long[d][other[ok]]
            su, sv = child[ok], other[ok]
            # and children of one node begin to differ here
            brothers, last = np.arange(len(trie.parent[d - 1])), trie.child[d - 1][trie.parent[d - 1] + 1]
            n = last - brothers - 1
            a = np.repeat(brothers, n)
            b = np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n) + a + 1
            ok = trie.long[d][a] & trie.long[d][b]
            su, sv = np.r_[su, a[ok]], np.r_[sv, b[ok]]
            ended(d, su, d, sv, True)
            place, child = trie.children(d - 1, iu)
            symbol = trie.symbol[d - 1][child]
            other = trie.step(d, iv[place], symbol)
            ok = (other >= 0) & trie.short[d][child] & ~(fresh[place] & (symbol == trie.symbol[d - 1][iv[place]]))
            if ok.any():
                ok[ok] &= trie.long[d + 1][other[ok]]
            iu, iv, fresh = child[ok], other[ok], np.zeros(int(ok.sum()), bool)
        if d < trie.depth:
            nodes = np.flatnonzero(trie.short[d] & (np.array([width[g] for g in trie.group[d].tolist()], np.int64) > d))
            place, child = trie.children(d, nodes)
            ok = trie.long[d + 1][child]
            iu, iv, fresh = np.r_[iu, nodes[place[ok]]], np.r_[iv, child[ok]], np.r_[fresh, np.ones(int(ok.sum()), bool)]
            ended(d, iu, d + 1, iv, False)
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def _windows(rows: DataFrame) -> DataFrame:
    """rows (word, n, m, lo, hi) with k, a hash of what lies outside the window [lo, hi) of a word of m symbols.

    A word of m - 1 symbols lacks one of the window's.
    """
    left, right = F.expr("substring(word, 1, lo)"), F.expr("substring(word, hi + 1 - (m - length(word)))")
    return rows.withColumn("k", F.xxhash64("m", "lo", "hi", left, right))


def _halved(rows: DataFrame) -> DataFrame:
    middle = F.expr("(lo + hi) div 2").cast("int")
    halves = F.array(F.struct("lo", middle.alias("hi")), F.struct(middle.alias("lo"), "hi"))
    return rows.select("word", "n", "m", F.explode(halves).alias("w")).select("word", "n", "m", "w.lo", "w.hi")


def near_words(words: DataFrame, most_group: int = MOST_GROUP, task_rows: int = TASK_ROWS) -> DataFrame:
    """(word, other, other_n) for both directions of every pair of words (word, n; no word twice) one edit apart.

    A pair's longer word has m symbols, and its edit lies in the first or in the second half of them: the words then agree in all
    that lies outside this window. So every word goes, as the longer and as the shorter one of a pair, to the group of each of its
    two windows, and a group is a small trie below a prefix (or before a suffix) of half a word. A group of over most_group words is
    cut again: its rows go to the groups of half its window, until windows have one symbol and groups no more words than there are symbols.
    """
    ship(words.sparkSession)
    both = F.explode(F.array(F.length("word"), F.length("word") + 1)).alias("m")
    rows = words.select("word", F.col("n").cast("long").alias("n"), both).withColumns({"lo": F.lit(0), "hi": F.col("m")})
    rows, total = _windows(_halved(rows)), 4 * words.count()
    while True:
        large = rows.filter("hi - lo > 1").groupBy("k").agg(F.count("*").alias("c")).filter(F.col("c") > most_group).select("k")
        large = written(large, "large-groups")
        if large.isEmpty():
            break
        cut = _windows(_halved(rows.filter("hi - lo > 1").join(large, "k", "left_semi")))
        rows = written(rows.join(large.withColumn("wide", F.lit(True)), "k", "left").filter("wide is null or hi - lo <= 1").drop("wide").unionByName(cut), "windows")
        total = rows.count()
    removed(large)
    n_tasks = max(1, -(-total // task_rows))

    def joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = pd.concat([*batches, pd.DataFrame({c: [] for c in ("word", "n", "m", "lo", "hi")})])
        if not len(table):
            return
        known: dict[tuple, int] = {}
        lines = []
        for word, n, m, lo, hi in zip(table["word"], table["n"], table["m"].astype(int), table["lo"].astype(int), table["hi"].astype(int), strict=True):
            short = m - len(word)
            key = known.setdefault((m, lo, hi, word[:lo], word[hi - short :]), len(known))
            lines.append((key, word[lo : hi + 1 - short], not short, hi - lo, word, int(n)))
        lines.sort(key=lambda x: x[:2])
        a, b = near_rows(np.array([x[0] for x in lines]), np.array([x[3] for x in lines]), [x[1] for x in lines], np.array([x[2] for x in lines]))
        for i in range(0, len(a), 50_000):
            one, two = a[i : i + 50_000].tolist(), b[i : i + 50_000].tolist()
            yield pd.DataFrame({
                "word": [lines[x][4] for x in one] + [lines[y][4] for y in two], "other": [lines[y][4] for y in two] + [lines[x][4] for x in one],
                "other_n": [lines[y][5] for y in two] + [lines[x][5] for x in one],
            })

    dealt = rows.repartition(n_tasks, "k").select("word", "n", "m", "lo", "hi")
    return dealt.mapInPandas(joined, "word string, other string, other_n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of forms (word, form): the end of the path of forms, whose length doubles each round.

    A form is at least twice as frequent as its word, so paths have under 63 steps, and no more than 7 rounds follow.
    """
    now = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        last, now = now, written(now.join(ahead, F.col("root") == F.col("_at"), "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "roots")
        removed(last)
        if now.filter("moved").isEmpty():
            return now.drop("moved")


def spelling_variants(words: DataFrame, factor: int = 2, most_group: int = MOST_GROUP, task_rows: int = TASK_ROWS) -> DataFrame:
    """word, form, root, n, n_near, form_n for every row of words (word, n).

    A word's form is its near word of the largest n, the smallest in code-point order of several, if that n is at least factor times
    its own; root follows the forms to the last. Words without near ones have n_near 0, no form and themselves as root.
    """
    near = near_words(words, most_group, task_rows).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form"))).alias("best"),
    )
    best_n = -F.col("best.less")
    rows = words.join(near, "word", "left").withColumn("fits", F.coalesce(best_n >= factor * F.col("n"), F.lit(False)))
    rows = rows.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("fits"), F.col("best.form")).alias("form"), F.when(F.col("fits"), best_n).alias("form_n"),
    )
    rows = written(rows, "forms")
    ends = roots(rows.filter("form is not null").select("word", "form"))
    return rows.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_groups(
    docs: DataFrame, every: int = 97, least_length: int = 5, least_count: int = 3, factor: int = 2, id_col: str = "doc_id", text_col: str = "text",
    most_group: int = MOST_GROUP, task_rows: int = TASK_ROWS,
) -> DataFrame:
    """spelling_variants() of the words of the texts: runs of letters, of which every 97th or so loses a letter.

    A run loses the code point h % length if `every` divides h, the crc32 of "<doc_id>:<run>". Null and empty texts have no words; a
    null identifier is written "null". Repeated rows count each. A very long run is a word like any other. Ties go by the
    word. Other columns aren't read, whatever their names. An empty table gives no rows.
    """
    words = written(misspelt_words(docs, every, least_length, least_count, id_col, text_col), "vocabulary")
    return spelling_variants(words, factor, most_group, task_rows)
