"""Quality classifier: naive Bayes support vectors.

Features are indicators of hashed n-grams: words, pairs of neighbouring words, and
runs of two and three characters, letter case and punctuation kept. Each indicator is scaled
by its class log-count ratio, the row is brought to unit length, and a linear
hinge-loss model is fitted by dual coordinate descent. A logistic curve fitted on
rows left out of the descent turns margins into scores.

Rules: null text counts as empty; an empty text has no features and gets the curve's
value at the bias. Labels other than 0 and 1, ids labelled both ways and null ids are
not learned from. With no labels of one class, every score is the known class's share
(0.5 with none).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import labelled_sample, mix, remainder, word_hashes, word_spans

BITS = 18
#: Bounds of the learning sample: documents per class, characters per document.
PER_CLASS = 1500
MAX_CHARS = 20_000


def ngrams(text: str | None) -> np.ndarray:
    """Distinct hashed features of a whole text."""
    buf = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    if not len(buf):
        return np.zeros(0, np.int64)
    words = word_hashes(buf, *word_spans(buf))
    parts = [words, mix(words[1:] * np.uint64(3) + words[:-1]),
             np.uint64(11) * (words[1:] == words[:-1]).astype(np.uint64)]  # a word right after itself
    wide = buf.astype(np.uint64) + np.uint64(1)
    two = wide[:-1] * np.uint64(257) + wide[1:]
    three = two[:-1] * np.uint64(257) + wide[2:]
    parts += [mix(two + np.uint64(1 << 40)), mix(three + np.uint64(1 << 41))]
    idx = (np.concatenate(parts) & np.uint64((1 << BITS) - 1)).astype(np.int64)
    seen = np.zeros(1 << BITS, bool) if len(idx) > 4096 else None
    if seen is None:
        return np.unique(idx)
    seen[idx] = True
    return np.flatnonzero(seen)


def dual_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, cost: np.ndarray, epochs: int = 15,
                 seed: int = 5) -> tuple[np.ndarray, float]:
    """Hinge-loss weights and bias by dual coordinate descent over sparse rows
    (indices, values); the bias is the weight of a constant feature."""
    w, b = np.zeros(1 << BITS), 0.0
    alpha = np.zeros(len(rows))
    norm = np.array([float((v * v).sum()) + 1.0 for v in values])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            idx, val = rows[i], values[i]
            grad = y[i] * (float(w[idx] @ val) + b) - 1.0
            new = min(max(alpha[i] - grad / norm[i], 0.0), cost[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[idx] += step * val
                b += step
                alpha[i] = new
    return w, b


def logistic_curve(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of P(1) over margins, by Newton steps on smoothed targets."""
    pos, neg = float((y > 0).sum()), float((y <= 0).sum())
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    wt = np.where(y > 0, 0.5 / max(pos, 1.0), 0.5 / max(neg, 1.0)) * len(y)
    a, c = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + c, -30, 30)))
        g = np.array([(wt * (p - t) * margins).sum() + 1e-3 * (a - 1), (wt * (p - t)).sum()])
        h = wt * np.maximum(p * (1 - p), 1e-6)
        m = np.array([[(h * margins * margins).sum() + 1e-3, (h * margins).sum()], [(h * margins).sum(), h.sum() + 1e-9]])
        step = np.linalg.solve(m, g)
        step = step / max(1.0, float(np.abs(step).max()))
        a, c = a - step[0], c - step[1]
    return max(a, 1e-3), c


@dataclass
class NbsvmModel:
    ratio: np.ndarray = field(default_factory=lambda: np.zeros(1 << BITS, np.float32))
    weight: np.ndarray = field(default_factory=lambda: np.zeros(1 << BITS, np.float32))
    bias: float = 0.0
    curve: tuple[float, float] = (0.0, 0.0)

    def margin(self, idx: np.ndarray) -> float:
        scaled = self.ratio[idx].astype(np.float64)
        size = float(np.sqrt((scaled * scaled).sum()))
        return self.bias + (float(scaled @ self.weight[idx]) / size if size else 0.0)

    def score(self, text: str | None) -> float:
        a, c = self.curve
        return float(1 / (1 + np.exp(-np.clip(a * self.margin(ngrams(text)) + c, -30, 30))))


def fit(sample: list[tuple[int, float, np.ndarray]], smooth: float = 1.0, cost: float = 4.0) -> NbsvmModel:
    """Model from (label, hash share, features); every fifth row, by its place in the
    hash order, is kept for the score curve."""
    y = np.array([1.0 if r[0] == 1 else -1.0 for r in sample])
    if not len(y) or (y > 0).all() or (y < 0).all():
        sure = 0.0 if not len(y) else float(np.sign(y[0])) * 4.0
        return NbsvmModel(curve=(0.0, sure))
    fitted = np.array([i % 5 != 0 for i in range(len(y))])
    if len(set(y[fitted])) < 2 or len(set(y[~fitted])) < 2:
        fitted[:] = True
    mass = {s: np.full(1 << BITS, smooth) for s in (1.0, -1.0)}
    for i in np.flatnonzero(fitted):
        mass[y[i]][sample[i][2]] += 1
    ratio = np.log((mass[1.0] / mass[1.0].sum()) / (mass[-1.0] / mass[-1.0].sum()))
    seen = (mass[1.0] + mass[-1.0]) > 2 * smooth + 1.5  # features of a single document say nothing
    ratio = np.where(seen, ratio, 0.0).astype(np.float32)
    rows, values = [], []
    for _, _, idx in sample:
        idx = idx[ratio[idx] != 0]
        scaled = ratio[idx].astype(np.float64)
        size = float(np.sqrt((scaled * scaled).sum()))
        rows.append(idx)
        values.append(scaled / size if size else scaled)
    pick = np.flatnonzero(fitted)
    per = {s: 0.5 * len(pick) / max(1, int((y[pick] == s).sum())) for s in (1.0, -1.0)}
    w, b = dual_descent([rows[i] for i in pick], [values[i] for i in pick], y[pick],
                        cost * np.array([per[s] for s in y[pick]]))
    rest = np.flatnonzero(~fitted) if not fitted.all() else pick
    margins = np.array([float(w[rows[i]] @ values[i]) + b for i in rest])
    return NbsvmModel(ratio, w.astype(np.float32), b, logistic_curve(margins, y[rest]))


def learn(docs: DataFrame, labels: DataFrame, rows: Column, per_class: int = PER_CLASS,
          max_chars: int = MAX_CHARS) -> NbsvmModel:
    """Fit on a bounded sample (see `labelled_sample`) of the ids where `rows`, over `_id`, holds."""
    sample, counts = labelled_sample(docs, labels, "quality", rows, per_class, max_chars, ngrams)
    model = fit(sample)
    if counts.get(0) and counts.get(1) and model.curve[0] > 0:  # the sample is balanced, the labels are not
        model.curve = (model.curve[0], model.curve[1] + float(np.log(counts[1] / counts[0])))
    return model


def score(docs: DataFrame, model: NbsvmModel) -> DataFrame:
    """docs' columns inside a struct `row`, with the score of each whole text."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def predict(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series([held.value.score(t if isinstance(t, str) else None) for t in texts], dtype="float64")

    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(row.alias("row"), predict(F.col("text")).alias("score"))


def report(docs: DataFrame, labels: DataFrame, mod: int = 4, out: int = 2, cut: float = 0.7) -> DataFrame:
    """doc_id, held_out (a null id counts as held out), score, predicted."""
    model = learn(docs, labels, remainder("_id", mod) != out)
    held = F.coalesce(remainder("row.doc_id", mod) == out, F.lit(True))
    return score(docs, model).select(F.col("row.doc_id").alias("doc_id"), held.alias("held_out"), "score",
                                     (F.col("score") >= cut).cast("int").alias("predicted"))
