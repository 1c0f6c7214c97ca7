"""Toxicity: a logistic classifier over words, regularised by counterfactuals.

Features are hashed indicators of words (letters only, lower-cased). Every labelled text that names an identity term
is paired with copies of itself in which that term is swapped, one copy for each other term of its group, and the
squared change of the score between the two is added to the loss, so a group mention alone moves no
score. The groups are a parameter (`IDENTITY_GROUPS` by default); the model says how many pairs it was fitted
with. A term that no labelled text and no swap names has no weight. Fitted by gradient steps on a bounded sample.

Rules: null text counts as empty and has the score of the intercept; labels other than
0 and 1, ids labelled both ways and null ids are not learned from; with one class or
none labelled, every score is that class's side of the curve (0.5 with none).
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import labelled_sample, remainder, word_hashes, word_spans

BITS = 18
#: Bounds of the learning sample: documents per class, characters per document.
PER_CLASS = 4000
MAX_CHARS = 20_000

# Identity terms by group; a term is swapped within its group.
IDENTITY_GROUPS = (
    ("muslim", "christian", "jewish", "hindu", "buddhist", "catholic", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "catholics", "atheists"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("woman", "man"), ("women", "men"), ("girl", "boy"), ("female", "male"),
    ("gay", "straight", "lesbian", "bisexual", "transgender", "queer"),
    ("blind", "deaf", "disabled", "autistic"),
    ("immigrant", "refugee", "foreigner"), ("immigrants", "refugees", "foreigners"),
    ("old", "young", "elderly"),
    ("chinese", "mexican", "arab", "american", "indian", "turkish"),
)

#: ASCII bytes other than letters and the apostrophe separate words; bytes above 127 belong to words.
NOT_LETTER = np.array([b < 128 and not chr(b).isalpha() and b != 0x27 for b in range(256)])


def _words(text: str | None) -> np.ndarray:
    buf = np.frombuffer((text or "").lower().encode("utf-8", "surrogatepass"), np.uint8)
    return word_hashes(buf, *word_spans(buf, NOT_LETTER))


def _indices(words: np.ndarray) -> np.ndarray:
    return (words & np.uint64((1 << BITS) - 1)).astype(np.int64)


def features(text: str | None) -> np.ndarray:
    """Distinct hashed words of a whole text."""
    return np.unique(_indices(_words(text)))


def _hash(word: str) -> np.uint64:
    return _words(word)[0]


@functools.lru_cache(maxsize=4)
def _others(groups: tuple[tuple[str, ...], ...]) -> dict[int, list[np.uint64]]:
    """Each term's hash to the hashes of the other terms of its groups."""
    out: dict[int, list[np.uint64]] = {}
    for group in groups:
        for term in group:
            out.setdefault(int(_hash(term)), []).extend(_hash(t) for t in group if t != term)
    return out


def swapped(words: np.ndarray, groups=IDENTITY_GROUPS) -> list[np.ndarray]:
    """The text's words with one of its identity terms, wherever it stands, swapped for another of its
    group: one copy for every term found and every other term."""
    others = _others(groups)
    return [np.where(words == term, new, words) for term in np.unique(words) for new in others.get(int(term), ())]


def with_swaps(text: str | None, groups=IDENTITY_GROUPS) -> np.ndarray:
    """Features of the text and, each after a -1, of its swapped copies."""
    words = _words(text)
    parts = [np.unique(_indices(words))]
    for copy in swapped(words, groups):
        parts += [np.array([-1]), np.unique(_indices(copy))]
    return np.concatenate(parts)


@dataclass
class ToxicityModel:
    weight: np.ndarray = field(default_factory=lambda: np.zeros(1 << BITS, np.float32))
    bias: float = 0.0
    pairs: int = 0  # swapped copies that the fit compared with their texts

    def score(self, text: str | None) -> float:
        z = self.bias + float(self.weight[features(text)].sum(dtype=np.float64))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit(sample: list[tuple[int, float, np.ndarray]], epochs: int = 200, ridge: float = 1e-3,
        invariance: float = 1.0, toxic_weight: float = 3.0) -> ToxicityModel:
    """Adam steps on class-balanced logistic loss + ridge + the swap penalty, over all rows
    at once; a missed toxic text costs `toxic_weight` times a false alarm."""
    y = np.array([float(r[0]) for r in sample])
    if not len(y) or y.min() == y.max():
        return ToxicityModel(bias=0.0 if not len(y) else (4.0 if y[0] else -4.0))
    plain, copies, owner = [], [], []
    for i, (_, _, f) in enumerate(sample):
        parts = np.split(f, np.flatnonzero(f == -1))
        plain.append(parts[0])
        copies += [p[1:] for p in parts[1:]]
        owner += [i] * (len(parts) - 1)
    every, times = np.unique(np.concatenate(plain), return_counts=True)
    known = np.zeros(1 << BITS, bool)
    known[every[times > 1]] = True  # a feature of a single document says nothing
    column = np.cumsum(known) - 1
    n_feat = int(known.sum())

    def matrix(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        own = [column[r[known[r]]] for r in rows]
        return np.repeat(np.arange(len(own)), [len(o) for o in own]), np.concatenate([*own, np.zeros(0, np.int64)])

    r1, c1 = matrix(plain)
    r2, c2 = matrix([plain[i] for i in owner])
    r3, c3 = matrix(copies)
    share = np.where(y == 1, toxic_weight / y.sum(), 1.0 / (1 - y).sum()) / (1 + toxic_weight)
    w, b = np.zeros(n_feat), 0.0
    m, v, t = np.zeros(n_feat + 1), np.zeros(n_feat + 1), 0
    for _ in range(epochs):
        z = np.bincount(r1, w[c1], len(y)) + b
        g = share * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        grad = np.bincount(c1, g[r1], n_feat) + ridge * w
        if copies:
            gap = np.bincount(r2, w[c2], len(copies)) - np.bincount(r3, w[c3], len(copies))
            gap *= 2 * invariance / len(copies)
            grad += np.bincount(c2, gap[r2], n_feat) - np.bincount(c3, gap[r3], n_feat)
        full = np.append(grad, g.sum())
        t += 1
        m = 0.9 * m + 0.1 * full
        v = 0.999 * v + 0.001 * full * full
        step = 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    weight = np.zeros(1 << BITS, np.float32)
    weight[known] = w
    return ToxicityModel(weight, float(b), len(copies))


def learn(docs: DataFrame, labels: DataFrame, rows: Column, per_class: int = PER_CLASS,
          max_chars: int = MAX_CHARS, groups=IDENTITY_GROUPS) -> ToxicityModel:
    """Fit on a bounded sample (see `labelled_sample`) of the ids where `rows`, over `_id`, holds."""
    features_of = functools.partial(with_swaps, groups=groups)
    return fit(labelled_sample(docs, labels, "toxic", rows, per_class, max_chars, features_of)[0])


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """docs' columns inside a struct `row`, with the score of each whole text."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def predict(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series([held.value.score(t if isinstance(t, str) else None) for t in texts], dtype="float64")

    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(row.alias("row"), predict(F.col("text")).alias("score"))


def report(docs: DataFrame, labels: DataFrame, mod: int = 5, out: int = 0, cut: float = 0.5) -> DataFrame:
    """doc_id, held_out (a null id counts as held out), score, predicted, swap_pairs (of the fit)."""
    model = learn(docs, labels, remainder("_id", mod) != out)
    held = F.coalesce(remainder("row.doc_id", mod) == out, F.lit(True))
    return score(docs, model).select(F.col("row.doc_id").alias("doc_id"), held.alias("held_out"), "score",
                                     (F.col("score") >= cut).cast("int").alias("predicted"),
                                     F.lit(model.pairs).cast("long").alias("swap_pairs"))


def drop_toxic(docs: DataFrame, labels: DataFrame, cut: float = 0.5) -> DataFrame:
    """Documents scored below `cut`, by a model learned from all labels; columns unchanged."""
    return score(docs, learn(docs, labels, F.lit(True))).where(F.col("score") < cut).select("row.*")
