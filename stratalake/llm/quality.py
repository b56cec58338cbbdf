"""Quality by a generalised additive model with pairwise interactions."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stratalake.llm.common import slices, strings
from stratalake.llm.sample import labelled_texts

#: Labelled texts of each class that the model is fitted on.
EXAMPLES = 6000
BINS, COARSE = 32, 8
ROUNDS, PAIR_ROUNDS, PAIRS = 150, 60, 8
RATE, RIDGE = 0.1, 4.0
THRESHOLD = 0.7

FEATURES = (
    "log_bytes", "log_words", "word_bytes", "capitals", "digits", "exclamation", "bars", "signs", "stops",
    "commas", "other_bytes", "distinct_words", "top_word", "repeated_next", "capital_words", "closed_lines",
    "distinct_lines", "line_words", "longest_word", "word_entropy", "short_words",
)


def features(text: str) -> list[float]:
    """Measures of one whole text, in the order of FEATURES; an empty text has zeros."""
    raw = text.encode()
    words = raw.split()
    n, w = len(raw), len(words)
    if not w:
        return [math.log1p(n)] + [0.0] * (len(FEATURES) - 1)
    b = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    counts = Counter(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    held = np.array(list(counts.values())) / w
    return [
        math.log1p(n), math.log1p(w), n / w, b[65:91].sum() / n, b[48:58].sum() / n, b[33] / w, b[124] / w,
        (b[35:39].sum() + b[42] + b[64] + b[94] + b[126]) / w, (b[46] + b[63]) / w, b[44] / w, b[128:].sum() / n,
        len(counts) / w, float(held.max()), sum(map(bytes.__eq__, words, words[1:])) / w,
        sum(map(bytes.isupper, words)) / w, sum(x.rstrip()[-1:] in b".!?" for x in lines) / len(lines),
        len(set(lines)) / len(lines), w / len(lines), max(map(len, words)), float(-(held * np.log(held)).sum() / math.log(w + 1)),
        sum(1 for x in words if len(x) <= 3) / w,
    ]


@dataclass
class Gam:
    """Lookup tables per feature and per pair of features; a score is a sum of table entries."""

    edges: list[np.ndarray]
    tables: list[np.ndarray]
    base: float
    pairs: list[tuple[int, int]] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, f], "right") for f, e in enumerate(self.edges)], 1)

    def score(self, x: np.ndarray) -> np.ndarray:
        bins = self.bins(x)
        z = np.full(len(x), self.base)
        for f, table in enumerate(self.tables):
            z += table[bins[:, f]]
        for (f, g), table in zip(self.pairs, self.pair_tables):
            z += table[self.coarse[f][bins[:, f]], self.coarse[g][bins[:, g]]]
        return 1 / (1 + np.exp(-z))


def _tree(gradient: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """A tree of up to three leaves over ordered bins: the cut of most gain, then the best within its sides."""

    def cut(a: int, b: int) -> tuple[float, int]:
        g, h = np.cumsum(gradient[a:b]), np.cumsum(weight[a:b])
        gain = g[:-1] ** 2 / (h[:-1] + RIDGE) + (g[-1] - g[:-1]) ** 2 / (h[-1] - h[:-1] + RIDGE) - g[-1] ** 2 / (h[-1] + RIDGE)
        at = int(np.argmax(gain)) if len(gain) else -1
        return (float(gain[at]), a + at + 1) if at >= 0 else (0.0, a)

    _, first = cut(0, len(gradient))
    sides = [(cut(a, b), a, b) for a, b in ((0, first), (first, len(gradient))) if b - a > 1]
    edges = sorted({0, first, len(gradient), *([max(sides)[0][1]] if sides else [])})
    out = np.zeros(len(gradient))
    for a, b in zip(edges, edges[1:]):
        out[a:b] = gradient[a:b].sum() / (weight[a:b].sum() + RIDGE)
    return out


def _pair_tree(gradient: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
    """Four leaves from one cut along either axis: the pair of cuts of most gain."""
    g, h = gradient.cumsum(0).cumsum(1), weight.cumsum(0).cumsum(1)
    best, cuts = 0.0, (0, 0)
    for i in range(len(g) - 1):
        for j in range(g.shape[1] - 1):
            gs = (g[i, j], g[i, -1] - g[i, j], g[-1, j] - g[i, j], g[-1, -1] - g[i, -1] - g[-1, j] + g[i, j])
            hs = (h[i, j], h[i, -1] - h[i, j], h[-1, j] - h[i, j], h[-1, -1] - h[i, -1] - h[-1, j] + h[i, j])
            gain = sum(x * x / (y + RIDGE) for x, y in zip(gs, hs))
            if gain > best:
                best, cuts = gain, (i + 1, j + 1)
    out = np.zeros_like(gradient)
    for rows in (slice(0, cuts[0]), slice(cuts[0], None)):
        for cols in (slice(0, cuts[1]), slice(cuts[1], None)):
            out[rows, cols] = gradient[rows, cols].sum() / (weight[rows, cols].sum() + RIDGE)
    return best, out


def fit_tables(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Gam:
    """Boosts one shallow tree per feature in turn, then per pair of the most promising pairs."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    rate = float(np.clip(np.average(y, weights=weight), 1e-3, 1 - 1e-3))
    model = Gam(edges, [np.zeros(len(e) + 1) for e in edges], math.log(rate / (1 - rate)))
    bins = model.bins(x)
    z = np.full(len(x), model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-z))
        return weight * (y - p), weight * p * (1 - p)

    for _ in range(ROUNDS):
        for f, table in enumerate(model.tables):
            if len(table) < 2:
                continue
            g, h = slopes()
            step = RATE * _tree(np.bincount(bins[:, f], g, len(table)), np.bincount(bins[:, f], h, len(table)))
            table += step
            z += step[bins[:, f]]
    model.coarse = [np.arange(len(t)) * COARSE // max(len(t), COARSE) for t in model.tables]
    coarse = np.stack([c[bins[:, f]] for f, c in enumerate(model.coarse)], 1)

    def grid(f: int, k: int, values: np.ndarray) -> np.ndarray:
        return np.bincount(coarse[:, f] * COARSE + coarse[:, k], values, COARSE * COARSE).reshape(COARSE, COARSE)

    g, h = slopes()
    several = [f for f, t in enumerate(model.tables) if len(t) > 2]
    gains = [(_pair_tree(grid(f, k, g), grid(f, k, h))[0], f, k) for i, f in enumerate(several) for k in several[i + 1 :]]
    model.pairs = [(f, k) for _, f, k in sorted(gains, reverse=True)[:PAIRS]]
    model.pair_tables = [np.zeros((COARSE, COARSE)) for _ in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for (f, k), table in zip(model.pairs, model.pair_tables):
            g, h = slopes()
            step = RATE * _pair_tree(grid(f, k, g), grid(f, k, h))[1]
            table += step
            z += step[coarse[:, f], coarse[:, k]]
    return model


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", each: int = EXAMPLES) -> Gam:
    """Fits on up to `each` labelled texts a class, weighted back to the classes' sizes.

    With labels of one class only, or none, the model scores their rate, or one half.
    """
    sample, sizes = labelled_texts(docs, labels, label, each)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b)):
            x = [features(text) for text in strings(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "label", "x"])

    kind = sample.schema["doc_id"].dataType.simpleString()
    measured = sample.mapInArrow(measure, f"doc_id {kind}, label int, x array<double>").collect()  # 2 * each rows of numbers
    rows = sorted(((r.doc_id, r.label, r.x) for r in measured), key=lambda r: r[0])
    y = np.array([r[1] for r in rows], float)
    if len(set(y.tolist())) < 2:
        rate = (y.mean() * 0.998 + 0.001) if rows else 0.5
        return Gam([np.zeros(0)] * len(FEATURES), [np.zeros(1)] * len(FEATURES), math.log(rate / (1 - rate)))
    held = Counter(r[1] for r in rows)
    share = np.array([sizes[r[1]] / held[r[1]] for r in rows])
    return fit_tables(np.array([r[2] for r in rows]), y, share / share.mean())


def score_quality(docs: DataFrame, model: Gam) -> DataFrame:
    """doc_id and score of every row, from its whole text; a null text scores as an empty one.

    Repeated rows score alike. Other columns of `docs` are not read. No rows give no rows.
    """
    source = docs.select("doc_id", "text")
    kind = source.schema["doc_id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b)):
            x = np.array([features(text) for text in strings(batch.column("text"))])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(x))], ["doc_id", "score"])

    return source.mapInArrow(score, f"doc_id {kind}, score double")
