"""Quality classifier: a generalised additive model with pairwise interactions.

A text becomes a row of numbers (lengths, shares of character kinds, repetition).
The model is an intercept, one lookup table per feature and some tables for pairs of
features. Tables are learnt by cyclic boosting: in turn, each feature gets a shallow
tree over its bins, fitted to the current residuals and added to its table with a
small step. Pairs are chosen by how much of the remaining error a tree over both
would remove, and boosted the same way. Scoring looks bins up and adds.

The model is fitted on at most ``SAMPLE`` labelled documents, those with the lowest
hashes, on the driver, and is a few kilobytes. Features and scores of all documents
are computed in the tasks, batch by batch.

Defined results: a null text counts as empty; an empty text gets a score like any
other; without labels of both kinds every score is the share of label 1 (0.5 without
labels); labels other than 0 and 1 and labels of unknown documents are ignored; of
several labels of one document the lowest counts; repeated documents are scored one
by one.
"""

from __future__ import annotations

import math
import operator
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

SAMPLE = 20_000         # labelled documents to fit on, at most
BINS = 32
ROUNDS, PAIR_ROUNDS, STEP = 120, 60, 0.15
PAIRS = 6
SHRINK = 2.0            # added to the weight of a leaf

FEATURES = ["log_bytes", "log_words", "word_bytes", "symbols", "capitals", "digits", "marks", "pipes",
            "shouts", "spaces", "non_ascii", "distinct_words", "doubled_words", "repeated_lines",
            "longest_word", "line_words"]

# Kinds of bytes, one bit of a count each.
_KIND = np.zeros(256, np.uint8)
for _n, _chars in enumerate((b"#*$%&<>@^~=+{}[]\\", bytes(range(65, 91)), b"0123456789", b".,;:'\"?()-", b"|",
                             b"!", b" \t\n\r\x0b\x0c", bytes(range(128, 256))), 1):
    _KIND[list(_chars)] = _n


def _numbers(text: str | None) -> list[float]:
    raw = (text or "").encode()
    words = raw.split()
    n, m = max(len(raw), 1), max(len(words), 1)
    kinds = np.bincount(_KIND[np.frombuffer(raw, np.uint8)], minlength=9)[1:9] / n
    symbols, capitals, digits, marks, pipes, shouts, spaces, wide = kinds
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return [math.log1p(len(raw)), math.log1p(len(words)), sum(map(len, words)) / m, symbols, capitals, digits,
            marks, pipes, shouts, spaces, wide, len(set(words)) / m,
            sum(map(operator.eq, words, words[1:])) / m, 1 - len(set(lines)) / max(len(lines), 1),
            math.log1p(max(map(len, words), default=0)), math.log1p(m / max(len(lines), 1))]


def numbers(texts: Iterable[str | None]) -> np.ndarray:
    return np.array([_numbers(t) for t in texts], np.float64).reshape(-1, len(FEATURES))


@dataclass
class Gam:
    """The fitted tables."""
    intercept: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(self.edges)], 1)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        if self.edges:
            b = self.bins(x)
            for f, table in enumerate(self.tables):
                total += table[b[:, f]]
            for f, g, table in self.pairs:
                total += table[b[:, f], b[:, g]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + SHRINK)


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Best place to cut a run of bins in two, and what it gains."""
    if len(g) < 2:
        return 0.0, 0
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gains = _gain(left_g, left_h) + _gain(g.sum() - left_g, h.sum() - left_h) - _gain(g.sum(), h.sum())
    at = int(np.argmax(gains))
    return float(gains[at]), at + 1


def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Leaf values, one per bin, of a tree over the bins of one feature."""
    gain, at = _best_cut(g, h) if depth else (0.0, 0)
    if gain <= 1e-9:
        return np.full(len(g), g.sum() / (h.sum() + SHRINK))
    return np.concatenate([_tree(g[:at], h[:at], depth - 1), _tree(g[at:], h[at:], depth - 1)])


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """A tree that cuts the first feature once and then the second on either side."""
    best, out = 0.0, np.full(g.shape, g.sum() / (h.sum() + SHRINK))
    for at in range(1, g.shape[0]):
        if not h[:at].any() or not h[at:].any():
            continue
        sides = [(g[:at].sum(0), h[:at].sum(0)), (g[at:].sum(0), h[at:].sum(0))]
        cuts = [_best_cut(*s) for s in sides]
        gain = sum(c[0] for c in cuts) + sum(_gain(s[0].sum(), s[1].sum()) for s in sides) - _gain(g.sum(), h.sum())
        if gain > best:
            best = float(gain)
            rows = []
            for (sg, sh), (_, c), n in zip(sides, cuts, (at, g.shape[0] - at)):
                line = np.concatenate([np.full(len(p), p.sum() / (q.sum() + SHRINK))
                                       for p, q in ((sg[:c], sh[:c]), (sg[c:], sh[c:]))])
                rows.append(np.tile(line, (n, 1)))
            out = np.concatenate(rows)
    return best, out


def fit(x: np.ndarray, y: np.ndarray) -> Gam:
    """Tables for rows ``x`` and labels ``y`` (0 or 1). The same rows in the same order
    give the same tables."""
    if len(y) == 0 or y.min() == y.max():
        share = float(np.clip(y.mean() if len(y) else 0.5, 0.001, 0.999))
        return Gam(math.log(share / (1 - share)))
    share = float(y.mean())
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    model = Gam(math.log(share / (1 - share)), edges, [np.zeros(len(e) + 1) for e in edges])
    bins = model.bins(x)
    total = np.full(len(y), model.intercept)

    def residuals():
        p = 1 / (1 + np.exp(-total))
        return y - p, np.maximum(p * (1 - p), 1e-6)

    for _ in range(ROUNDS):
        for f, table in enumerate(model.tables):
            g, h = residuals()
            step = STEP * _tree(np.bincount(bins[:, f], g, len(table)), np.bincount(bins[:, f], h, len(table)))
            table += step
            total += step[bins[:, f]]

    def cells(f, n):
        width = len(model.tables[n])
        key, size = bins[:, f] * width + bins[:, n], len(model.tables[f]) * width
        g, h = residuals()
        return [np.bincount(key, v, size).reshape(-1, width) for v in (g, h)]

    ranked = sorted(((_pair_tree(*cells(f, n))[0], f, n) for f in range(len(edges)) for n in range(len(edges))
                     if f != n), reverse=True)
    chosen = [(f, n) for _, f, n in ranked[:PAIRS]]
    model.pairs = [(f, n, np.zeros((len(model.tables[f]), len(model.tables[n])))) for f, n in chosen]
    for _ in range(PAIR_ROUNDS):
        for f, n, table in model.pairs:
            step = STEP * _pair_tree(*cells(f, n))[1]
            table += step
            total += step[bins[:, f], bins[:, n]]
    return model


def is_held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, text: str = "text", sample: int = SAMPLE) -> Gam:
    """Fit on the labelled documents that are not held out, at most ``sample``."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~is_held_out())
    known = usable.groupBy("doc_id").agg(F.min("quality").cast("int").alias("_quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # At most ``sample`` rows of two numbers.
    rows = docs.select("doc_id", text).join(F.broadcast(chosen), "doc_id")
    measured = rows.select("doc_id", "_quality", features(F.col(text)).alias("x"))
    got = measured.orderBy(F.xxhash64("doc_id"), "doc_id", "x").limit(sample).toPandas()
    x = np.array(got["x"].tolist(), np.float64).reshape(-1, len(FEATURES))
    return fit(x, got["_quality"].to_numpy(np.float64))


def features(text: Column) -> Column:
    @F.pandas_udf("array<double>")
    def measured(texts: pd.Series) -> pd.Series:
        return pd.Series(list(numbers(texts)))
    return measured(text)


def score(text: Column, model: Gam) -> Column:
    """Probability of label 1."""
    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(numbers(texts)))
    return scored(text)
