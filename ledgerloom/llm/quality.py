"""Quality rules: fixed limits on document statistics and gradient-boosted trees over them."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

#: Labelled rows that the trees are fitted on, by the hash of their id; numbers only.
SAMPLE = 20_000
TREES, DEPTH, BINS, RATE, LEAST_ROWS, PENALTY = 60, 3, 32, 0.15, 20, 1.0
THRESHOLD = 0.5
#: Statistics used by the trees, with the direction in which the score may move, 0: either.
FEATURES = {
    "words": 0, "word_length": 0, "symbols_a_char": -1, "dup_lines": -1, "repeat_words": -1,
    "distinct_words": 0, "line_words": 0, "uppercase": 0, "digits": 0, "stops": 0, "longest_word": 0,
}
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

# What counts as a symbol, and the characters between words.
SYMBOLS, SPACES = "#*$%&|<>", " \t\n\x0b\f\r"
_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
_UPPER, _DIGIT = re.compile(r"[A-Z]"), re.compile(r"[0-9]")


def statistics(text: str) -> tuple[list[int], list[float]]:
    """The base counts and the features of one whole text."""
    words = _WORDS.findall(text)
    n = len(words)
    chars = len(text) - sum(text.count(c) for c in SPACES)
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    dup = len(lines) - len(set(lines))
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        many = Counter(windows)
        hit = np.fromiter((many[w] > 1 for w in windows), bool, len(windows))
        covered = np.zeros(n, bool)
        for k in range(3):
            covered[k : k + len(hit)] |= hit
        repeated = int(covered.sum())
    per = 1 / max(n, 1)
    features = [
        np.log1p(n), chars * per, symbols / max(chars, 1), dup / max(len(lines), 1), repeated * per,
        len(set(words)) / max(n, 1) ** 0.8, n / max(len(lines), 1), len(_UPPER.findall(text)) * per,
        len(_DIGIT.findall(text)) * per, (text.count(".") + text.count(",")) * per,
        np.log1p(max(map(len, words), default=0)),
    ]
    return [n, chars, symbols, dup, repeated], features


@dataclass
class Trees:
    """Trees flattened into node arrays; leaves point to themselves."""

    start: float
    roots: np.ndarray
    feature: np.ndarray
    limit: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def probability(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(DEPTH):
                node = np.where(x[rows, self.feature[node]] <= self.limit[node], self.left[node], self.right[node])
            total += self.value[node]
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


class _Grower:
    """Boosting with Newton steps on binned features. A split on a constrained feature is taken only
    if the children's values are in order, and bounds them by their middle from then on."""

    def __init__(self, x: np.ndarray, y: np.ndarray, signs: list[int]):
        self.x, self.y, self.signs = x, y, signs
        self.cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        self.bins = np.stack([np.searchsorted(c, v, "left") for c, v in zip(self.cuts, x.T)], 1)
        self.nodes: list[list] = []

    def _leaf(self, value: float) -> int:
        self.nodes.append([0, 0.0, len(self.nodes), len(self.nodes), value])
        return len(self.nodes) - 1

    def _value(self, g, h, low: float, high: float):
        return np.clip(g / (h + PENALTY), low, high)

    def grow(self, rows: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int, low: float, high: float) -> int:
        own = float(self._value(g[rows].sum(), h[rows].sum(), low, high))
        best = (1e-6, None)
        if depth and len(rows) >= 2 * LEAST_ROWS:
            for f, cuts in enumerate(self.cuts):
                k = len(cuts) + 1
                b = self.bins[rows, f]
                gs, hs, ns = (np.cumsum(np.bincount(b, w, k))[:-1] for w in (g[rows], h[rows], None))
                gr, hr, nr = g[rows].sum() - gs, h[rows].sum() - hs, len(rows) - ns
                vl, vr = self._value(gs, hs, low, high), self._value(gr, hr, low, high)
                gain = self._gain(gs, hs, vl) + self._gain(gr, hr, vr) - self._gain(g[rows].sum(), h[rows].sum(), own)
                fine = (ns >= LEAST_ROWS) & (nr >= LEAST_ROWS) & (self.signs[f] * (vr - vl) >= 0)
                gain = np.where(fine, gain, -1.0)
                if len(gain) and gain.max() > best[0]:
                    best = (float(gain.max()), (f, int(gain.argmax()), vl, vr))
        if best[1] is None:
            return self._leaf(own * RATE)
        f, cut, vl, vr = best[1]
        middle = float(vl[cut] + vr[cut]) / 2
        bounds = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}
        at = len(self.nodes)
        self.nodes.append([f, float(self.cuts[f][cut]), 0, 0, 0.0])
        below = self.bins[rows, f] <= cut
        for side, part, (lo, hi) in zip((2, 3), (rows[below], rows[~below]), bounds[self.signs[f]]):
            self.nodes[at][side] = self.grow(part, g, h, depth - 1, lo, hi)
        return at

    @staticmethod
    def _gain(g, h, v):
        return g * v - 0.5 * (h + PENALTY) * v * v


def fit_trees(x: np.ndarray, y: np.ndarray, signs: list[int]) -> Trees:
    """Boosted trees for 0/1 labels. Without rows, or with one label only, they say its share."""
    share = float(np.clip(y.mean() if len(y) else 0.5, 1e-6, 1 - 1e-6))
    start = float(np.log(share / (1 - share)))
    roots: list[int] = []
    grower = _Grower(x, y, signs) if len(y) else None
    if len(y) and 0 < y.mean() < 1:
        z = np.full(len(y), start)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-z))
            first = len(grower.nodes)
            roots.append(grower.grow(np.arange(len(y)), y - p, p * (1 - p), DEPTH, -4.0, 4.0))
            tree = _flat(0.0, [roots[-1]], grower.nodes)
            q = tree.probability(x)
            z += np.log(q / (1 - q))
            assert first == roots[-1]
    return _flat(start, roots, grower.nodes if grower else [])


def _flat(start: float, roots: list[int], nodes: list[list]) -> Trees:
    columns = list(zip(*nodes)) if nodes else [[]] * 5
    kinds = (np.int64, float, np.int64, np.int64, float)
    return Trees(start, np.array(roots, np.int64), *[np.array(c, k) for c, k in zip(columns, kinds)])


_STATS = ", ".join([f"{c} bigint" for c in BASE] + [f"{c} double" for c in FEATURES])


def _stats_frame(texts: pd.Series) -> pd.DataFrame:
    rows = [statistics(t) for t in texts.fillna("")]
    out = pd.DataFrame([r[0] for r in rows], columns=BASE, dtype="int64")
    return out.join(pd.DataFrame([r[1] for r in rows], columns=list(FEATURES), dtype="float64"))


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality") -> Trees:
    """Trees from labelled documents: a sample of SAMPLE rows by the hash of their id, of which only the
    statistics reach the driver. Rows of ``labels`` without id or label are left out."""
    known = labels.select(F.col(id).alias("id"), F.col(label).cast("double").alias("y")).dropna().distinct()
    # Written, so that the planner knows how little it is and leaves the texts where they are.
    picked = staged(known.orderBy(F.xxhash64("id"), "id", "y").limit(SAMPLE), "sample")

    @F.pandas_udf(_STATS)
    def stats(texts: pd.Series) -> pd.DataFrame:
        return _stats_frame(texts)

    rows = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(picked, "id")
    data = rows.select("id", "y", stats("text").alias("s")).select("id", "y", "s.*").toPandas()
    data = data.sort_values(["id", *FEATURES, "y"])
    return fit_trees(data[list(FEATURES)].to_numpy(float), data["y"].to_numpy(float), list(FEATURES.values()))


def judged(
    docs: DataFrame, trees: Trees, id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, quality, base_failed, kept), one
    row per row of ``docs``. Null texts have no words; these and all texts of less than 50 words, or more
    than half in repeated windows, fail the base rules."""
    kind = f"{', '.join(f'{c} bigint' for c in BASE)}, quality double"

    @F.pandas_udf(kind)
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            s = _stats_frame(texts)
            yield s[BASE].assign(quality=trees.probability(s[list(FEATURES)].to_numpy(float)))

    rows = docs.select(F.col(id).alias(id), judge(F.coalesce(F.col(text), F.lit(""))).alias("s"))
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    return rows.select(id, "s.*").withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality") >= threshold)
    )
