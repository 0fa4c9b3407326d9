"""Quality classifier: a generalised additive model with pairwise interactions.

Shape features of the whole text are cut into bins. Cyclic boosting adds, feature after feature, a shallow tree over
the bins of that one feature, so that every feature ends up as one lookup table of log odds; the pairs whose quadrant
trees explain most of what is left then get two-dimensional tables the same way. A score is the sum of table entries
for the text's bins, passed through the logistic function.

The model is fitted on at most ``SAMPLE_ROWS`` labelled rows (chosen by a hash of the id), a bounded number; scoring
reads every text whole and needs no shuffle. Only the text is an input. Defined results: null and empty texts are
scored like an empty text; rows with a null label or id teach nothing; repeated rows count as often as they stand; with
labels of one class only (or none) every score is that class's share (or 0.5); an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeworks.llm.common import is_held_out

SAMPLE_ROWS = 20_000
THRESHOLD = 0.7
BINS, PAIR_BINS, PAIRS = 32, 12, 6
ROUNDS, PAIR_ROUNDS, RATE, SMOOTH, MIN_LEAF = 150, 60, 0.1, 1.0, 20

FEATURES = (
    "chars", "words", "lines", "word_length", "short_words", "long_words", "upper", "digit", "punctuation", "symbol",
    "pipe", "exclamation", "blank", "distinct_words", "distinct_pairs", "distinct_fours", "distinct_lines", "line_words",
    "top_word", "stops", "capital_starts", "other_script",
)

_POINTS = 0x300


def _classes() -> np.ndarray:
    """Character classes as columns, code points as rows; everything beyond the table shares its last row."""
    table = np.zeros((_POINTS, 9))
    for point in range(_POINTS - 1):
        c = chr(point)
        is_symbol = not c.isalnum() and not c.isspace()
        table[point] = (
            c.isupper(), c.isdigit(), c in ".,;:?'\"-()", is_symbol and c not in ".,;:?'\"-()", c == "|", c == "!",
            c.isspace(), c.isalpha(), c in ".?!",
        )
    table[-1, 7] = 1
    return table


_CLASS = _classes()


def features(text: str | None) -> list[float]:
    """The numbers of one text, in the order of FEATURES."""
    text = text or ""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), dtype="<u4")
    seen = np.bincount(np.minimum(points, _POINTS - 1), minlength=_POINTS)
    upper, digit, punctuation, symbol, pipe, exclamation, blank, letters, stops = (seen @ _CLASS).tolist()
    words, lines = text.split(), text.split("\n")
    n, chars = len(words), max(1, len(text))
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=n) if n else np.zeros(1, dtype=np.int64)
    share = lambda parts, of: len(set(parts)) / max(1, of)
    top = Counter(words).most_common(1)[0][1] / n if n else 1.0
    return [
        math.log1p(len(text)), math.log1p(n), math.log1p(len(lines)), float(lengths.mean()),
        float((lengths <= 3).mean()), float((lengths >= 10).mean()), upper / max(1, letters), digit / chars,
        punctuation / chars, symbol / chars, pipe / chars, exclamation / chars, blank / chars, share(words, n),
        share(zip(words, words[1:]), n - 1), share(zip(words, words[1:], words[2:], words[3:]), n - 3),
        share(lines, len(lines)), n / len(lines), top, stops / max(1, n),
        sum(w[0].isupper() for w in words) / max(1, n), float(seen[-1]) / chars,
    ]


@dataclass
class Additive:
    """Lookup tables: ``edges`` cut a feature into bins, ``tables`` and ``pairs`` hold log odds per bin."""

    base: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for j, table in enumerate(self.tables):
            total += table[np.searchsorted(self.edges[j], x[:, j], side="right")]
        for (i, j), table in self.pairs.items():
            a = np.searchsorted(self.pair_edges[i], x[:, i], side="right")
            total += table[a, np.searchsorted(self.pair_edges[j], x[:, j], side="right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1]))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + SMOOTH)


def _shallow_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, depth: int = 2) -> np.ndarray:
    """Leaf values per bin of a tree of the given depth over ordered bins with gradient, curvature and row sums."""
    if depth and len(g) > 1:
        left_g, left_h, left_n = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(n)[:-1]
        gain = _gain(left_g, left_h) + _gain(g.sum() - left_g, h.sum() - left_h)
        gain[(left_n < MIN_LEAF) | (n.sum() - left_n < MIN_LEAF)] = -1
        cut = int(np.argmax(gain)) + 1
        if gain[cut - 1] > _gain(g.sum(), h.sum()) + 1e-9:
            parts = (_shallow_tree(g[s], h[s], n[s], depth - 1) for s in (slice(0, cut), slice(cut, None)))
            return np.concatenate(list(parts))
    return np.full(len(g), -g.sum() / (h.sum() + SMOOTH))


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best split of a bin grid into four rectangles: what it gains, and the leaf value of every cell."""
    sums = []
    for m in (g, h):
        corner = m.cumsum(0).cumsum(1)[:-1, :-1]
        rows, cols = m.sum(1).cumsum()[:-1, None], m.sum(0).cumsum()[None, :-1]
        sums.append((corner, rows - corner, cols - corner, m.sum() - rows - cols + corner))
    if not sums[0][0].size:
        return 0.0, np.zeros_like(g)
    gain = sum(_gain(a, b) for a, b in zip(*sums, strict=True))
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    leaf = [-a[i, j] / (b[i, j] + SMOOTH) for a, b in zip(*sums, strict=True)]
    cells = np.empty_like(g)
    cells[: i + 1, : j + 1], cells[: i + 1, j + 1 :], cells[i + 1 :, : j + 1], cells[i + 1 :, j + 1 :] = leaf
    return float(gain[i, j]) - float(_gain(g.sum(), h.sum())), cells


def boost(x: np.ndarray, y: np.ndarray) -> Additive:
    """Fit the tables on a bounded sample."""
    if len(y) == 0 or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.5
        return Additive(base=math.log((share + 1e-6) / (1 - share + 1e-6)))
    share = float(y.mean())
    model = Additive(base=math.log(share / (1 - share)))
    model.edges = [_edges(c, BINS) for c in x.T]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    model.pair_edges = [_edges(c, PAIR_BINS) for c in x.T]
    bins = [np.searchsorted(e, c, side="right") for e, c in zip(model.edges, x.T, strict=True)]
    coarse = [np.searchsorted(e, c, side="right") for e, c in zip(model.pair_edges, x.T, strict=True)]
    rows = [np.bincount(b, minlength=len(t)) for b, t in zip(bins, model.tables, strict=True)]
    total = np.full(len(y), model.base)

    def slope() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return p - y, p * (1 - p)

    for _ in range(ROUNDS):
        for j, b in enumerate(bins):
            g, h = (np.bincount(b, v, minlength=len(model.tables[j])) for v in slope())
            step = RATE * _shallow_tree(g, h, rows[j])
            model.tables[j] += step
            total += step[b]

    def grid(i: int, j: int) -> tuple[np.ndarray, ...]:
        shape = (len(model.pair_edges[i]) + 1, len(model.pair_edges[j]) + 1)
        cell = coarse[i] * shape[1] + coarse[j]
        return (cell, *[np.bincount(cell, v, minlength=shape[0] * shape[1]).reshape(shape) for v in slope()])

    ranked = sorted(((_quadrants(*grid(i, j)[1:])[0], i, j) for i, j in combinations(range(x.shape[1]), 2)), reverse=True)
    chosen = [(i, j) for gain, i, j in ranked[:PAIRS] if gain > 0]
    for _ in range(PAIR_ROUNDS):
        for i, j in chosen:
            cell, g, h = grid(i, j)
            step = RATE * _quadrants(g, h)[1]
            model.pairs[i, j] = model.pairs.get((i, j), 0) + step
            total += step.ravel()[cell]
    return model


def training_sample(labels: DataFrame, label: str, rows: int, key: str = "doc_id") -> DataFrame:
    """At most ``rows`` labelled rows outside the held-out part, by a hash of the id."""
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & ~is_held_out(F.col(key)))
    chosen = known.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_label"))
    return chosen.orderBy(F.xxhash64("_key"), "_key", "_label").limit(rows)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", rows: int = SAMPLE_ROWS) -> Additive:
    numbers = F.pandas_udf(lambda s: s.map(features), "array<double>")
    sample = F.broadcast(training_sample(labels, "quality", rows))  # bounded by ``rows``
    taught = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(sample, "_key")
    bounded = taught.orderBy(F.xxhash64("_key"), "_key", "_label").limit(rows) if rows else taught
    learned = bounded.select(numbers("_text").alias("x"), "_label").toPandas()
    x = np.asarray(learned["x"].to_list(), dtype=np.float64).reshape(-1, len(FEATURES))
    return boost(x, learned["_label"].to_numpy(dtype=np.float64))


def scorer(model: Additive):
    """A column function from text to score."""

    def score(texts: pd.Series) -> pd.Series:
        x = np.asarray([features(t) for t in texts], dtype=np.float64).reshape(-1, len(FEATURES))
        return pd.Series(model.score(x))

    return F.pandas_udf(score, "double")


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted."""
    score = scorer(fit(docs, labels, key, text))
    rows = docs.select(F.col(key).alias("doc_id"), score(F.col(text)).alias("score"))
    return rows.select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents the classifier does not reject, with their columns."""
    return docs.where(scorer(fit(docs, labels))(F.col("text")) >= threshold)
