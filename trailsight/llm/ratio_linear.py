"""Toxicity: a linear classifier over character n-grams, scaled by naive Bayes log-count ratios.

A feature says whether an n-gram occurs in a text; its value is the log ratio of the smoothed shares
of toxic and clean training texts that have it. A logistic regression with a ridge penalty is fitted
on these values. Vocabulary: n-grams of at least MIN_DF toxic training texts, the FEATURES that tell
the classes apart best.

Cases: a null text is scored as an empty one. Null labels teach nothing; of several labels of one id
the largest counts. With one class only the score is that class's share, without labels 0. Repeated
rows get equal scores. Very long texts are read whole. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailsight.llm.common import bounded_sample, written

#: Training documents of each class at most.
TOXIC_ROWS, CLEAN_ROWS = 1500, 4500
SIZES = (4, 5, 6)
MIN_DF, FEATURES, RIDGE = 3, 6000, 2.0
_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_BITS = 20


def grams(text: str | None, sizes: tuple[int, ...] = SIZES) -> np.ndarray:
    """Hashes of all n-grams of the lower-cased text, not distinct."""
    c = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.uint64)
    out, h = [np.zeros(0, dtype=np.uint64)], c
    for n in range(2, max(sizes) + 1):
        if len(c) < n:
            break
        h = h[:-1] * _STEP + c[n - 1 :]
        if n in sizes:
            m = (h ^ (h >> np.uint64(29))) * _MIX
            out.append(m ^ (m >> np.uint64(32)) ^ np.uint64(n))
    return np.concatenate(out)


@dataclass
class Model:
    """Sorted n-gram hashes with a weight each, and the intercept; `prior` is the score without features."""

    keys: np.ndarray
    weights: np.ndarray
    intercept: float
    prior: float | None = None

    def __post_init__(self) -> None:
        self.seen = np.zeros(1 << _BITS, dtype=bool)
        self.seen[self.slot(self.keys)] = True

    @staticmethod
    def slot(h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - _BITS)).astype(np.int64)

    def found(self, text: str | None) -> np.ndarray:
        """Indices of the features of a text, ascending."""
        h = grams(text)
        h = np.sort(h[self.seen[self.slot(h)]])
        if not len(h) or not len(self.keys):
            return np.zeros(0, dtype=np.int64)
        h = h[np.r_[True, h[1:] != h[:-1]]]
        at = np.searchsorted(self.keys, h)
        at[at == len(self.keys)] = 0
        return at[self.keys[at] == h]

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(texts), self.prior)
        z = np.array([self.intercept + self.weights[self.found(t)].sum() for t in texts])
        return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def _toxic_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        one = [np.unique(grams(t)) for t in b["text"].to_pylist()]
        keys, n = np.unique(np.concatenate(one), return_counts=True)
        yield pa.record_batch({"gram": keys.view(np.int64), "n": n.astype(np.int64)})


def _logistic(rows: np.ndarray, cols: np.ndarray, x: np.ndarray, y: np.ndarray, width: int, ridge: float, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by accelerated gradient steps over the entries (rows, cols, x)."""
    n = len(y)
    w, b, v, vb, t = np.zeros(width), float(np.log(y.mean() / (1 - y.mean()))), np.zeros(width), 0.0, 1.0
    vb = b
    norm = np.bincount(rows, x * x, n)
    step = 1.0 / (0.25 * max(1.0, np.quantile(norm, 0.99)) * n / 8 + ridge)
    for _ in range(rounds):
        z = np.bincount(rows, x * v[cols], n) + vb
        e = 1 / (1 + np.exp(-np.clip(z, -35, 35))) - y
        g = np.bincount(cols, x * e[rows], width) + ridge * v
        w2, b2 = v - step * g, vb - step * e.sum()
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        if (g @ (w2 - w)) > 0:
            t2 = 1.0
        v, vb = w2 + (t - 1) / t2 * (w2 - w), b2 + (t - 1) / t2 * (b2 - b)
        w, b, t = w2, b2, t2
    return w, b


def learn(train: DataFrame, toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS, features: int = FEATURES, min_df: int = MIN_DF) -> Model:
    """A model from (doc_id, text, y); fits on at most the given rows of each class."""
    none = np.zeros(0, dtype=np.uint64)
    share = {r["y"]: r["n"] for r in train.groupBy((F.col("y") > 0).cast("int").alias("y")).agg(F.count("*").alias("n")).collect()}
    total = sum(share.values())
    if len(share) < 2:
        return Model(none, np.zeros(0), 0.0, share.get(1, 0) / total if total else 0.0)
    parts = [bounded_sample(train.where(c), "doc_id", m) for c, m in (("y > 0", toxic_rows), ("y <= 0", clean_rows))]
    sample = written(parts[0].unionByName(parts[1]).select("doc_id", "text", (F.col("y") > 0).cast("int").alias("y")))
    df = sample.where("y = 1").mapInArrow(_toxic_grams, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    keys = np.sort(df.where(F.col("n") >= min_df).select("gram").toPandas()["gram"].to_numpy(dtype=np.int64).view(np.uint64))
    sc, wide = sample.sparkSession.sparkContext, Model(keys, np.zeros(len(keys)), 0.0)
    known = sc.broadcast(wide)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((2, len(known.value.keys)), dtype=np.int64)
        for b in batches:
            for text, y in zip(b["text"].to_pylist(), b["y"].to_pylist(), strict=True):
                n[y, known.value.found(text)] += 1
        at = np.flatnonzero(n.any(axis=0))
        yield pa.record_batch({"at": at.astype(np.int64), "clean": n[0, at], "toxic": n[1, at]})

    tallied = sample.mapInArrow(tally, "at long, clean long, toxic long").groupBy("at").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toPandas()
    sizes = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    clean, toxic = tallied["clean"].to_numpy(), tallied["toxic"].to_numpy()
    p, q = (toxic + 1) / (sizes[1] + 2), (clean + 1) / (sizes[0] + 2)
    ratio, both = np.log(p / q), (toxic + clean + 1) / (sizes[0] + sizes[1] + 2)
    tells = toxic * np.log(p / both) + clean * np.log(q / both)
    top = np.lexsort((tallied["at"], -tells))[:features]
    at = tallied["at"].to_numpy()[top]
    order = np.argsort(at)
    chosen, ratio = at[order], ratio[top][order]
    narrow = sc.broadcast(Model(keys[chosen], np.zeros(len(chosen)), 0.0))

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [narrow.value.found(t).astype(np.int32) for t in b["text"].to_pylist()]
            yield pa.record_batch([b["doc_id"], b["y"], pa.array([x.tobytes() for x in found], pa.binary())], names=["doc_id", "y", "found"])

    got = sample.mapInArrow(entries, "doc_id long, y int, found binary").toPandas().sort_values(["doc_id", "y"])
    found = [np.frombuffer(x, dtype=np.int32) for x in got["found"]]
    rows, cols = np.repeat(np.arange(len(found)), [len(x) for x in found]), np.concatenate(found).astype(np.int64)
    w, b = _logistic(rows, cols, ratio[cols], got["y"].to_numpy(dtype=float), len(chosen), RIDGE)
    b += np.log(share[1] / share[0]) - np.log(sizes[1] / sizes[0])
    return Model(keys[chosen], w * ratio, float(b))
