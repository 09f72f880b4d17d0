"""Quality of texts by a generalised additive model with pairwise interactions."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import id_and_text, ship
from corvane.llm.labelled import held_out, one_of_each, training_rows

#: The model is fitted on at most so many labelled rows.
FIT_ROWS = 30_000
FEATURES = (
    "log_words", "word_length", "longest_word", "distinct_words", "top_word", "short_words", "symbols", "symbol_ends", "top_symbol",
    "stops_commas", "digits", "capitals", "log_line", "repeated_lines", "other_bytes", "entropy",
)
_SYMBOL_SIGNS = "#$%&*+/<=>@[\\]^_`{|}~"
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[[ord(c) for c in _SYMBOL_SIGNS]] = True


def features(text: str) -> list[float]:
    """FEATURES of one text, over all of it."""
    raw = np.frombuffer(text.encode(), np.uint8)
    n = max(1, len(raw))
    seen = np.bincount(raw, minlength=256)
    words = text.split()
    k = max(1, len(words))
    counts = Counter(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    lines = [x for x in text.split("\n") if x]
    repeated = 0
    if len(lines) > 1:
        line_counts = Counter(lines)
        repeated = sum(len(x) * (c - 1) for x, c in line_counts.items() if c > 1)
    ends = sum(c for w, c in counts.items() if w[-1] in _SYMBOL_SIGNS)
    p = seen[seen > 0] / n
    return [
        np.log1p(len(words)), lengths.mean() if len(words) else 0.0, float(lengths.max(initial=0)), len(counts) / k,
        max(counts.values(), default=0) / k, (lengths <= 2).sum() / k, seen[_SYMBOLS].sum() / n, ends / k, seen[_SYMBOLS].max() / k,
        (seen[44] + seen[46]) / k, seen[48:58].sum() / n, seen[65:91].sum() / n, np.log1p(n / max(1, len(lines))), repeated / n,
        seen[128:].sum() / n, float(-(p * np.log2(p)).sum()),
    ]


@dataclass
class Gam:
    """Lookup tables: the score of a row is the sigmoid of the base plus one entry of each feature's table and of each pair's."""

    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pair_edges: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def logit(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for f, (e, t) in enumerate(zip(self.edges, self.tables, strict=True)):
            out += t[np.searchsorted(e, x[:, f], "right")]
        coarse = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(self.pair_edges)]
        for (a, b), t in zip(self.pairs, self.pair_tables, strict=True):
            out += t[coarse[a], coarse[b]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -40, 40)))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    cuts = np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))
    return cuts[cuts > x.min()] if len(x) else cuts


def _gains(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    """The gain of a cut before each bin but the first."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    return gl * gl / (hl + ridge) + gr * gr / (hr + ridge) - g.sum() ** 2 / (h.sum() + ridge)


def _shallow(g: np.ndarray, h: np.ndarray, leaves: int, ridge: float) -> np.ndarray:
    """A tree over ordered bins, grown best cut first to so many leaves: the step of each bin."""
    spans = [(0, len(g))]
    while len(spans) < leaves:
        best = (1e-9, None, None)
        for s, (lo, hi) in enumerate(spans):
            if hi - lo > 1:
                gain = _gains(g[lo:hi], h[lo:hi], ridge)
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], s, lo + k + 1)
        if best[1] is None:
            break
        lo, hi = spans.pop(best[1])
        spans += [(lo, best[2]), (best[2], hi)]
    step = np.zeros(len(g))
    for lo, hi in spans:
        step[lo:hi] = g[lo:hi].sum() / (h[lo:hi].sum() + ridge)
    return step


def _quadrants(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[np.ndarray, float]:
    """The step of the best cut in two ways of both features (four leaves), and its gain."""
    total = lambda t: np.cumsum(np.cumsum(t, 0), 1)
    cg, ch = total(g), total(h)
    a, b = cg[:-1, :-1], ch[:-1, :-1]
    ga, ha, gb, hb, gt, ht = cg[:-1, -1:], ch[:-1, -1:], cg[-1:, :-1], ch[-1:, :-1], cg[-1, -1], ch[-1, -1]
    parts = [(a, b), (ga - a, ha - b), (gb - a, hb - b), (gt - ga - gb + a, ht - ha - hb + b)]
    gain = sum(x * x / (y + ridge) for x, y in parts) - gt * gt / (ht + ridge)
    if not gain.size:
        return np.zeros_like(g), 0.0
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    step = np.zeros_like(g)
    for rows, cols, (x, y) in zip(
        (slice(None, i + 1), slice(None, i + 1), slice(i + 1, None), slice(i + 1, None)),
        (slice(None, j + 1), slice(j + 1, None), slice(None, j + 1), slice(j + 1, None)), parts, strict=True,
    ):
        step[rows, cols] = x[i, j] / (y[i, j] + ridge)
    return step, float(gain[i, j])


def fit(
    x: np.ndarray, y: np.ndarray, rounds: int = 120, pair_rounds: int = 60, rate: float = 0.1, bins: int = 64, pair_bins: int = 12,
    most_pairs: int = 10, leaves: int = 4, ridge: float = 2.0,
) -> Gam:
    """Boosts one shallow tree for each feature in turn, round after round, then one for each pair with the largest gains.

    Without rows of both classes the model is the share of ones (one half without rows).
    """
    share = float(np.clip(y.mean(), 0.001, 0.999)) if len(y) else 0.5
    base = float(np.log(share / (1 - share)))
    n_features = x.shape[1]
    none = [np.empty(0)] * n_features
    if not len(y) or y.min() == y.max():
        return Gam(base, none, [np.zeros(1)] * n_features, none, [], [])
    edges = [_edges(x[:, f], bins) for f in range(n_features)]
    at = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    margin = np.full(len(y), base)

    def slope() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-margin))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for f in range(n_features):
            g, h = slope()
            step = rate * _shallow(np.bincount(at[f], g, len(tables[f])), np.bincount(at[f], h, len(tables[f])), leaves, ridge)
            tables[f] += step
            margin += step[at[f]]
    pair_edges = [_edges(x[:, f], pair_bins) for f in range(n_features)]
    coarse = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(pair_edges)]

    def grids(a: int, b: int, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        shape = (len(pair_edges[a]) + 1, len(pair_edges[b]) + 1)
        cell = coarse[a] * shape[1] + coarse[b]
        return tuple(np.bincount(cell, v, shape[0] * shape[1]).reshape(shape) for v in (g, h))

    g, h = slope()
    gains = {(a, b): _quadrants(*grids(a, b, g, h), ridge)[1] for a in range(n_features) for b in range(a + 1, n_features)}
    pairs = sorted(gains, key=lambda k: (-gains[k], k))[:most_pairs]
    pair_tables = [np.zeros((len(pair_edges[a]) + 1, len(pair_edges[b]) + 1)) for a, b in pairs]
    for _ in range(pair_rounds):
        for k, (a, b) in enumerate(pairs):
            g, h = slope()
            step = rate * _quadrants(*grids(a, b, g, h), ridge)[0]
            pair_tables[k] += step
            margin += step[coarse[a], coarse[b]]
    return Gam(base, edges, tables, pair_edges, pairs, pair_tables)


def quality_model(
    docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> Gam:
    """The model fitted on at most fit_rows labelled rows (the ones with the smallest hashes) outside the held-out fifth."""
    ship(docs.sparkSession)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = pd.DataFrame([features(t) for t in batch["text"].tolist()], columns=list(FEATURES), dtype=float)
            out.insert(0, "doc_id", batch["doc_id"].array)
            out.insert(1, "y", batch["y"].array)
            yield out

    known = training_rows(id_and_text(docs, id_col, text_col), labels, label_col, fit_rows, id_col)
    schema = "doc_id long, y int, " + ", ".join(f"{f} double" for f in FEATURES)
    rows = one_of_each(known.select("doc_id", "text", "y").mapInPandas(measure, schema)).toPandas()
    rows = rows.sort_values([*FEATURES, "y"])
    return fit(rows[list(FEATURES)].to_numpy(float), rows["y"].to_numpy(float))


def _scorer(model: Gam):
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            x = np.array([features(t) for t in texts.tolist()], float).reshape(len(texts), len(FEATURES))
            yield pd.Series(model.score(x))

    return F.pandas_udf(judge, "double")


def quality_scores(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text", **how
) -> DataFrame:
    """doc_id, held_out, score, predicted of every row, by quality_model().

    Features are measured on whole texts and scores add up table entries. Labels, language, source and identifier are no inputs
    of a score.

    Null texts count as empty and get the score that the tables give an empty text. Null identifiers are scored, too, and not held
    out. Repeated rows get equal scores. Without usable labels every score is the share of ones (0.5 without any). An empty
    table gives no rows.
    """
    model = quality_model(docs, labels, id_col=id_col, text_col=text_col, **how)
    scored = id_and_text(docs, id_col, text_col).select("doc_id", _scorer(model)("text").alias("score"))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def good_documents(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text", **how
) -> DataFrame:
    """The rows of docs whose score is at least the threshold; no row is dealt out or joined for that."""
    model = quality_model(docs, labels, id_col=id_col, text_col=text_col, **how)
    return docs.filter(_scorer(model)(F.coalesce(F.col(text_col), F.lit(""))) >= threshold)
