"""Quality: a generalised additive model with pairwise interactions.

Shallow trees are boosted in cycles over the features; each adds to a lookup table over the bins of
its feature. Pairs of features that still explain the residual get tables over both bins. A score is
the logistic of the sum of the bins' values, read by vectorised indexing.

Cases: a null text is scored as an empty one. Null labels teach nothing; of several labels of one id
the largest counts. With one class only the score is that class's share, without labels 0. Repeated
rows get equal scores. Very long texts are measured whole. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from trailsight.llm.common import bounded_sample

#: Training documents at most.
ROWS = 20_000
BINS, PAIR_BINS, PAIRS = 64, 16, 8
CYCLES, PAIR_CYCLES, RATE = 250, 120, 0.1
FEATURES = (
    "log_chars", "log_words", "word_length", "upper", "symbols", "exclamations", "bars", "digits",
    "points", "other_bytes", "lines", "distinct_words", "repeated_lines", "capital_words",
)
_UPPER, _LOWER, _DIGIT, _SYMBOL, _MARK, _BAR, _POINT, _SPACE, _OTHER = range(9)


def _classes() -> np.ndarray:
    out = np.full(256, _POINT, dtype=np.uint8)
    for chars, kind in (("ABCDEFGHIJKLMNOPQRSTUVWXYZ", _UPPER), ("abcdefghijklmnopqrstuvwxyz", _LOWER), ("0123456789", _DIGIT), ("#*$%&<>", _SYMBOL), ("!", _MARK), ("|", _BAR), (" \t\n\x0b\x0c\r", _SPACE)):
        out[list(chars.encode())] = kind
    out[128:] = _OTHER
    return out


CLASSES = _classes()


def measure(text: str | None) -> list[float]:
    """The values of FEATURES for one text."""
    raw = np.frombuffer((text or "").encode("utf-8", "replace"), dtype=np.uint8)
    n = np.bincount(CLASSES[raw], minlength=9)
    words = (text or "").split()
    lines = [x for x in (text or "").split("\n") if x]
    size, count = max(1, len(raw)), max(1, len(words))
    marks = n[_SYMBOL] + n[_MARK] + n[_BAR] + n[_POINT]
    return [
        np.log1p(len(raw)), np.log1p(len(words)), (len(raw) - n[_SPACE]) / count, n[_UPPER] / max(1, n[_UPPER] + n[_LOWER]),
        n[_SYMBOL] / count, n[_MARK] / count, n[_BAR] / count, n[_DIGIT] / size, marks / size, n[_OTHER] / size,
        len(lines) / count, len(set(words)) / count, 1 - len(set(lines)) / max(1, len(lines)), sum(map(str.isupper, words)) / count,
    ]


def cut_at(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


@dataclass
class Additive:
    """Cut points and a table for each feature; for each pair (i, j) coarse cut points and a table."""

    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)
    intercept: float = 0.0
    prior: float | None = None

    def logit(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.intercept)
        for i, (cuts, table) in enumerate(zip(self.cuts, self.tables, strict=True)):
            z += table[np.searchsorted(cuts, x[:, i], side="right")]
        at = {i: np.searchsorted(self.coarse[i], x[:, i], side="right") for p in self.pairs for i in p[:2]}
        for i, j, table in self.pairs:
            z += table[at[i], at[j]]
        return z

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.prior is not None or not texts:
            return np.full(len(texts), self.prior or 0.0)
        x = np.array([measure(t) for t in texts])
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -35, 35)))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def shallow_tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Values of a tree over ordered bins, from the sums of gradients and Hessians of each bin."""
    cg, ch = np.cumsum(g), np.cumsum(h)
    leaf = np.full(len(g), -cg[-1] / (ch[-1] + 1.0))
    if depth == 0 or len(g) < 2:
        return leaf
    gain = _gain(cg[:-1], ch[:-1]) + _gain(cg[-1] - cg[:-1], ch[-1] - ch[:-1]) - _gain(cg[-1], ch[-1])
    gain[(ch[:-1] < 0.5) | (ch[-1] - ch[:-1] < 0.5)] = 0
    k = int(gain.argmax()) + 1
    if gain[k - 1] <= 1e-9:
        return leaf
    return np.concatenate([shallow_tree(g[:k], h[:k], depth - 1), shallow_tree(g[k:], h[k:], depth - 1)])


def pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Values and gain of the best tree that cuts rows once, then the columns of each side once."""
    best = (np.zeros_like(g), 0.0)
    for turned in (False, True):
        a, b = (g.T, h.T) if turned else (g, h)
        cg, ch = a.cumsum(0).cumsum(1), b.cumsum(0).cumsum(1)
        sides = [(cg[:-1], ch[:-1]), (cg[-1] - cg[:-1], ch[-1] - ch[:-1])]
        gains, cuts = 0.0, []
        for sg, sh in sides:
            x = _gain(sg[:, :-1], sh[:, :-1]) + _gain(sg[:, -1:] - sg[:, :-1], sh[:, -1:] - sh[:, :-1])
            cuts.append(x.argmax(1))
            gains = gains + x.max(1)
        k = int(np.argmax(gains))
        value = float(gains[k] - _gain(cg[-1, -1], ch[-1, -1]))
        if value > best[1]:
            table = np.empty_like(a)
            for part, c in ((slice(0, k + 1), cuts[0][k] + 1), (slice(k + 1, None), cuts[1][k] + 1)):
                for cols in (slice(0, c), slice(c, None)):
                    table[part, cols] = -a[part, cols].sum() / (b[part, cols].sum() + 1.0)
            best = (table.T.copy() if turned else table, value)
    return best


def fit(x: np.ndarray, y: np.ndarray, cycles: int = CYCLES, pair_cycles: int = PAIR_CYCLES) -> Additive:
    n, width = x.shape
    m = Additive(intercept=float(np.log(y.mean() / (1 - y.mean()))))
    m.cuts = [cut_at(x[:, i], BINS) for i in range(width)]
    m.coarse = [cut_at(x[:, i], PAIR_BINS) for i in range(width)]
    fine = [np.searchsorted(m.cuts[i], x[:, i], side="right") for i in range(width)]
    rough = [np.searchsorted(m.coarse[i], x[:, i], side="right") for i in range(width)]
    m.tables = [np.zeros(len(c) + 1) for c in m.cuts]
    z = np.full(n, m.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(z, -35, 35)))
        return p - y, p * (1 - p)

    for _ in range(cycles):
        for i in range(width):
            g, h = slopes()
            size = len(m.tables[i])
            step = RATE * shallow_tree(np.bincount(fine[i], g, size), np.bincount(fine[i], h, size))
            m.tables[i] += step
            z += step[fine[i]]

    def grid(i: int, j: int, v: np.ndarray) -> np.ndarray:
        a, b = len(m.coarse[i]) + 1, len(m.coarse[j]) + 1
        return np.bincount(rough[i] * b + rough[j], v, a * b).reshape(a, b)

    g, h = slopes()
    wide = [i for i in range(width) if len(m.coarse[i])]
    gains = {(i, j): pair_tree(grid(i, j, g), grid(i, j, h))[1] for i, j in combinations(wide, 2)}
    chosen = sorted(sorted(gains, key=lambda p: (-gains[p], p))[:PAIRS])
    m.pairs = [(i, j, np.zeros((len(m.coarse[i]) + 1, len(m.coarse[j]) + 1))) for i, j in chosen]
    for _ in range(pair_cycles):
        for i, j, table in m.pairs:
            g, h = slopes()
            step = RATE * pair_tree(grid(i, j, g), grid(i, j, h))[0]
            table += step
            z += step[rough[i], rough[j]]
    for i, table in enumerate(m.tables):  # centred, so that a table shows its feature's own share
        mean = table[fine[i]].mean()
        table -= mean
        m.intercept += mean
    return m


def learn(train: DataFrame, most: int = ROWS) -> Additive:
    """A model from (doc_id, text, y); fits on the features of at most `most` rows."""

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([measure(t) for t in b["text"].to_pylist()]).reshape(-1, len(FEATURES))
            yield pa.record_batch([b["doc_id"], b["y"], *x.T], names=["doc_id", "y", *FEATURES])

    schema = "doc_id long, y int, " + ", ".join(f"{f} double" for f in FEATURES)
    got = bounded_sample(train, "doc_id", most).select("doc_id", "text", "y").mapInArrow(features, schema).toPandas()
    got = got.sort_values(["doc_id", "y", *FEATURES])
    y = (got["y"].to_numpy() > 0).astype(float)
    if not len(y) or y.min() == y.max():
        return Additive(prior=float(y.mean()) if len(y) else 0.0)
    return fit(got[list(FEATURES)].to_numpy(), y)
