"""Isolation forest on Spark.

* Fit: each tree needs its own sample of ``psi`` rows. Instead of sorting the
  table once per tree, every row draws, per tree, a hash-uniform number
  ``u(row, tree)`` and is a candidate for that tree when ``u < rate`` (rate ~ a
  few times psi / N). Only candidates are exploded, so the data that reaches
  the shuffle is about ``trees * rate * N`` rows, independent of N. Each tree
  keeps its ``psi`` candidates with the smallest ``u`` (a uniform sample without
  replacement) and is grown by ``groupBy(tree).applyInPandas`` — trees grow in
  parallel, one small group each. A tree that got fewer than ``psi``
  candidates is redrawn at a higher rate.
* Model: a node table (tree, node, feature, threshold, left, right, leaf_len)
  of at most ``trees * (2 psi - 1)`` rows; saved as parquet + JSON metadata.
* Score: ``-2 ** (-mean path length / c(psi))``; the node table is broadcast
  (its size bound follows from trees and psi) and traversed vectorised in
  NumPy inside an Arrow UDF.
* Threshold: the ``contamination`` quantile of training scores, exact, by counts
  on a grid that is refined around the rank; saved with the model.
"""

from __future__ import annotations

import json
import math
import os

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import FOREST_CONTAMINATION, FOREST_SAMPLE, FOREST_SEED, FOREST_TREES
from ..functions.timefn import utc_now_iso

EULER_GAMMA = 0.5772156649015329
NODE_DDL = "tree INT, node INT, feature INT, threshold DOUBLE, left INT, right INT, leaf_len DOUBLE"


def c_factor(n: float) -> float:
    """Average path length of an unsuccessful BST search among n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + EULER_GAMMA) - 2.0 * (n - 1.0) / n


# ------------------------------------------------------------------ growing

def grow_tree(x: np.ndarray, rng: np.random.Generator, max_depth: int) -> list[tuple]:
    """Isolation tree over rows ``x`` -> nodes (node, feature, threshold, left, right, leaf_len)."""
    nodes: list = []

    def build(idx: np.ndarray, depth: int) -> int:
        nid = len(nodes)
        nodes.append(None)
        n = len(idx)
        if depth >= max_depth or n <= 1:
            nodes[nid] = (nid, -1, None, -1, -1, depth + c_factor(n))
            return nid
        for f in rng.permutation(x.shape[1]):
            col = x[idx, f]
            lo, hi = col.min(), col.max()
            if lo < hi:
                thr = float(rng.uniform(lo, hi))
                go_left = col < thr
                left = build(idx[go_left], depth + 1)
                right = build(idx[~go_left], depth + 1)
                nodes[nid] = (nid, int(f), thr, left, right, None)
                return nid
        nodes[nid] = (nid, -1, None, -1, -1, depth + c_factor(n))  # all points equal
        return nid

    build(np.arange(len(x)), 0)
    return nodes


def _unit_hash(key: Column, tree: Column, seed: int) -> Column:
    """Uniform [0, 1) number per (row, tree)."""
    return F.pmod(F.xxhash64(key, tree, F.lit(seed)), F.lit(1 << 53)).cast("double") / float(1 << 53)


def fit(points: DataFrame, features: list[str], key: str, trees: int = FOREST_TREES, psi: int = FOREST_SAMPLE,
        seed: int = FOREST_SEED, oversample: float = 3.0, path: str | None = None) -> DataFrame:
    """Grow ``trees`` isolation trees on ``psi``-row samples -> node table.

    Passes over the input: one count (for the sampling rate) and one that
    samples, shuffles only the candidates and grows the trees. The node table
    (small) is written once to the shared folder and read back, so scoring
    never re-runs the fit; a tree that drew fewer than ``psi`` candidates makes
    the fit redraw at a higher rate.
    """
    from ..session import fresh_path

    spark = points.sparkSession
    n = points.count()
    psi_eff = int(min(psi, n))
    max_depth = int(math.ceil(math.log2(max(psi_eff, 2))))
    rate = min(1.0, oversample * psi_eff / max(n, 1))
    names = [f"f{i}" for i in range(len(features))]
    out_schema = NODE_DDL + ", n_sample INT"

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        t = int(pdf["tree"].iloc[0])
        pdf = pdf.nsmallest(psi_eff, "u")
        x = pdf[names].to_numpy(np.float64)
        rng = np.random.default_rng([seed, t])
        rows = grow_tree(x, rng, max_depth)
        return pd.DataFrame([(t, *r, len(pdf)) for r in rows],
                            columns=["tree", "node", "feature", "threshold", "left", "right", "leaf_len", "n_sample"])

    feats = [F.col(f).cast("double").alias(nm) for f, nm in zip(features, names)]
    k = F.col(key).cast("string")
    while True:
        picked = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: _unit_hash(k, t, seed) < F.lit(rate))
        cand = points.select(*feats, k.alias("_k"), F.explode(picked).alias("tree"))
        cand = cand.select(F.col("tree").cast("int").alias("tree"), *names,
                           _unit_hash(F.col("_k"), F.col("tree"), seed).alias("u"))
        out = path or fresh_path(spark, "forest", "nodes")
        cand.groupBy("tree").applyInPandas(grow, out_schema).write.mode("overwrite").parquet(out)
        nodes = spark.read.parquet(out)
        check = nodes.agg(F.countDistinct("tree").alias("t"), F.min("n_sample").alias("m")).first()
        if check["t"] == trees and check["m"] >= psi_eff:
            return nodes.drop("n_sample")
        if rate >= 1.0:
            raise ValueError("not enough distinct rows to sample every tree")
        rate = min(1.0, rate * 2)


# ------------------------------------------------------------------ model I/O

class Forest:
    """Node arrays of a fitted forest (bounded: trees * (2 psi - 1) nodes)."""

    def __init__(self, nodes: pd.DataFrame, psi: int):
        nodes = nodes.sort_values(["tree", "node"]).reset_index(drop=True)
        self.psi = int(psi)
        self.trees = []
        for _, g in nodes.groupby("tree", sort=True):
            self.trees.append((
                g["feature"].to_numpy(np.int64),
                g["threshold"].fillna(0.0).to_numpy(np.float64),
                g["left"].to_numpy(np.int64),
                g["right"].to_numpy(np.int64),
                g["leaf_len"].fillna(0.0).to_numpy(np.float64),
            ))

    @classmethod
    def from_frame(cls, nodes: DataFrame, psi: int, max_nodes: int = 5_000_000) -> Forest:
        n = nodes.count()
        if n > max_nodes:
            raise ValueError(f"forest has {n} nodes, above the broadcast limit {max_nodes}")
        return cls(nodes.toPandas(), psi)

    def path_lengths(self, x: np.ndarray) -> np.ndarray:
        """x[n, d] -> mean path length over trees, vectorised per tree."""
        total = np.zeros(len(x))
        for feature, thr, left, right, leaf_len in self.trees:
            node = np.zeros(len(x), np.int64)
            while True:
                f = feature[node]
                inner = f >= 0
                if not inner.any():
                    break
                xi = x[np.arange(len(x)), np.where(inner, f, 0)]
                nxt = np.where(xi < thr[node], left[node], right[node])
                node = np.where(inner, nxt, node)
            total += leaf_len[node]
        return total / max(len(self.trees), 1)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return -np.power(2.0, -self.path_lengths(x) / c_factor(self.psi))


def save(nodes: DataFrame, path: str, psi: int, features: list[str], threshold: float | None = None) -> None:
    """Node table and metadata; ``threshold`` is the score below which a point is
    abnormal, fixed on the training scores."""
    nodes.write.mode("overwrite").parquet(os.path.join(path, "nodes"))
    meta = {"psi": psi, "features": features, "threshold": threshold, "format": "isolation-forest-nodes-v1"}
    nodes.sparkSession.createDataFrame([(json.dumps(meta),)], "meta STRING").coalesce(1) \
        .write.mode("overwrite").text(os.path.join(path, "meta"))


def load(spark: SparkSession, path: str) -> tuple[DataFrame, dict]:
    meta = json.loads(spark.read.text(os.path.join(path, "meta")).first()[0])
    return spark.read.parquet(os.path.join(path, "nodes")), meta


# ------------------------------------------------------------------ scoring

def score_points(spark: SparkSession, forest: Forest, points: Column) -> Column:
    """``ARRAY<ARRAY<DOUBLE>>`` (a record's points) -> ``ARRAY<DOUBLE>`` scores.

    Arrow-native: the nested lists are flattened to one NumPy matrix per batch
    without touching rows in Python, scored, and re-wrapped with the original
    list offsets (one score per point)."""
    bc = spark.sparkContext.broadcast(forest)

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def forest_scores(recs: pa.Array) -> pa.Array:
        model = bc.value
        pts = recs.flatten()                       # one list per point
        vals = pts.values.to_numpy(zero_copy_only=False).astype(float)
        start = pts.offsets.to_numpy()
        need = 1 + max([int(t[0].max()) for t in model.trees if len(t[0])] + [-1])
        usable = ~pts.is_null().to_numpy(zero_copy_only=False) & (np.diff(start) >= need)
        x = vals[start[:-1][usable][:, None] + np.arange(need)[None, :]]
        s = np.full(len(pts), np.nan)
        if len(x):
            s[usable] = np.where(np.isnan(x).any(axis=1), np.nan, model.scores(x))
        off = pc.subtract(recs.offsets, recs.offsets[0])
        return pa.ListArray.from_arrays(off, pa.array(s, pa.float64(), mask=np.isnan(s)), mask=recs.is_null())

    # Non-deterministic for the optimizer only: a filter on the scores (the
    # verdict) must not be pushed through the projection and re-run the model.
    return forest_scores.asNondeterministic()(points)


def threshold(scores: DataFrame, col: str, q: float = FOREST_CONTAMINATION, cells: int = 4096) -> float:
    """Exact ``q`` quantile (linear interpolation, as ``quantile_cont``); NaN without scores.

    Scores are counted into a grid of ``cells`` cells between their least and
    greatest value (a partial aggregate: at most ``cells + 1`` rows per task
    and on the driver), and the one cell that holds the rank is cut into a
    finer grid until it holds a single value or ends at the rank. Least and
    greatest value of a cell never share the next grid's cell, so it ends.
    The input is read once per grid (about three times); give it stored scores.
    """
    s = F.col(col).cast("double")
    scores = scores.select(s.alias("s")).where(s.isNotNull() & ~F.isnan(s))
    row = scores.agg(F.count(F.lit(1)).alias("n"), F.min("s").alias("lo"), F.max("s").alias("hi")).first()
    if not row["n"]:
        return float("nan")
    h = q * (row["n"] - 1)
    rank = math.floor(h)  # wanted: the values at this rank and the next, counted from 0
    lo, hi, below = row["lo"], row["hi"], 0
    while lo < hi:
        inside = scores.where((F.col("s") >= lo) & (F.col("s") <= hi))
        cell = F.floor((F.col("s") - lo) / (hi - lo) * cells)
        counts = inside.groupBy(cell.alias("cell")).agg(
            F.count(F.lit(1)).alias("n"), F.min("s").alias("lo"), F.max("s").alias("hi")).collect()
        counts.sort(key=lambda r: r["cell"])
        at = 0
        while below + counts[at]["n"] <= rank:
            below += counts[at]["n"]
            at += 1
        found = counts[at]
        if below + found["n"] == rank + 1:  # the last of its cell: the next value opens the next cell
            after = counts[at + 1]["lo"] if at + 1 < len(counts) else found["hi"]
            return found["hi"] + (after - found["hi"]) * (h - rank)
        lo, hi = found["lo"], found["hi"]
    return float(lo)


def verdict(first_score: Column, thr: float) -> Column:
    """1 = normal, -1 = abnormal (score below the contamination threshold), null without a score."""
    return F.when(first_score < F.lit(thr), F.lit(-1)).when(first_score.isNotNull(), F.lit(1))


# ------------------------------------------------------------------ generators

def training_points(spark: SparkSession, n_per_cluster: int = 500, seed: int = FOREST_SEED) -> DataFrame:
    """Two clusters: 0.3 * N(0, 1) shifted by +2 and -2, rounded to 3 places."""
    base = spark.range(n_per_cluster).select(
        "id", (F.randn(seed) * 0.3).alias("dx"), (F.randn(seed + 1) * 0.3).alias("dy"))
    shifted = [base.select((F.col("id") + i * n_per_cluster).alias("id"),
                           F.round(F.col("dx") + s, 3).alias("x"), F.round(F.col("dy") + s, 3).alias("y"))
               for i, s in enumerate((2.0, -2.0))]
    return shifted[0].unionByName(shifted[1])


def synthetic_transactions(ids: DataFrame, id_col: str, seed: int = 7, outlier_p: float = 0.2) -> DataFrame:
    """One record per id: with probability ``outlier_p`` a uniform(-4, 4)^2 point,
    else 0.3 * N(0, 1) around (2, 2) or (-2, -2) with equal odds; rounded to 3."""
    u, side = F.rand(seed), F.rand(seed + 1)
    centre = F.when(side < 0.5, F.lit(2.0)).otherwise(F.lit(-2.0))
    x = F.when(u <= outlier_p, F.rand(seed + 2) * 8 - 4).otherwise(F.randn(seed + 3) * 0.3 + centre)
    y = F.when(u <= outlier_p, F.rand(seed + 4) * 8 - 4).otherwise(F.randn(seed + 5) * 0.3 + centre)
    return ids.select(F.col(id_col).cast("bigint").alias("id"),
                      F.array(F.array(F.round(x, 3), F.round(y, 3))).alias("data"),
                      utc_now_iso().alias("current_time"))
