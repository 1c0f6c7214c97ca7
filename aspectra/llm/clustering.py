"""Centroid clustering of integer vectors with a progressive search in the Walsh-Hadamard domain.

A vector's components become integers and are transformed without division, so for the transforms
V and C of a vector and a centroid sum((V - C)^2) is `DIMENSIONS` times their squared distance, and a
sum over some of the coefficients never exceeds it. Coefficients are added up from coarse to
fine (by sign changes, `STEP` at a time); after each step the centroids whose sum is already
greater than the whole distance of some other centroid are given up. What is left is summed over
all coefficients, so nearest centroids are exact, ties included (smaller number).

Vectors stay where the scan puts them: every round reads them once, and each task returns its
exact sums per cluster. Only centroids reach the driver and the tasks (`k` times
`DIMENSIONS` integers). Components so large that 64-bit sums could overflow are computed with
Python's integers by the same steps.

Rules: a vector is kept if it has exactly `DIMENSIONS` components, none null, NaN or infinite; other
rows give no row. Repeated rows and ids each count. A null id is assigned as any other but starts no
centroid; ids of equal hash (repeated ones) start in the order of their components. Fewer
vectors than `k` give as many centroids (none, and no rows, where every id is null); a distance or
inertia beyond 64 bits is null.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

DIMENSIONS = 64
CENTROIDS = 40
ROUNDS = 5
#: Factor between a component and its integer.
SCALE = 256
SEED = "2:"
#: Coefficients that are added between two eliminations.
STEP = 8
#: Magnitude up to which sums of squares over all coefficients fit 64 bits.
SMALL = 1 << 24


def valid(vector: str) -> Column:
    """Exactly `DIMENSIONS` components, none null or non-finite."""
    x = F.col(vector)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return F.coalesce((F.size(x) == DIMENSIONS) & finite, F.lit(False))


def integers(flat: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) per component, exact; Python integers where they may not fit 64-bit sums."""
    scaled = flat.astype(np.float64).reshape(-1, DIMENSIONS)
    if not len(scaled) or np.abs(scaled).max() * SCALE < SMALL - 1:
        return np.floor(scaled * SCALE).astype(np.int64)
    return np.array([[math.floor(Fraction(v) * SCALE) for v in row] for row in scaled.tolist()], object)


def transform(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of every row in order of sign changes (coarse to fine)."""
    y = x
    half = 1
    while half < DIMENSIONS:
        y = y.reshape(len(x), -1, 2, half)
        y = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(len(x), DIMENSIONS)
        half *= 2
    return y[:, ORDER]


def _order() -> np.ndarray:
    signs = np.array([[(-1) ** bin(i & j).count("1") for j in range(DIMENSIONS)] for i in range(DIMENSIONS)])
    return np.argsort((np.diff(signs, axis=1) != 0).sum(axis=1), kind="stable")


ORDER = _order()


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of each row's nearest centroid (ties: the smaller number)."""
    if x.dtype == object or centroids.dtype == object:
        x, centroids = x.astype(object), centroids.astype(object)
    v, c = transform(x), transform(centroids)
    number, distance = np.zeros(len(x), np.int64), np.zeros(len(x), x.dtype)
    for at in range(0, len(x), 512):
        part = v[at:at + 512]
        n = len(part)
        total = np.zeros((n, len(c)), part.dtype)
        for i in range(STEP):
            d = part[:, i, None] - c[None, :, i]
            total += d * d
        # one whole distance a row bounds the others: that of the centroid that is nearest so far
        guess = c[total.argmin(axis=1)]
        bound = ((part - guess) ** 2).sum(axis=1)
        row, centroid = np.nonzero(total <= bound[:, None])
        total = total[row, centroid]
        for i in range(STEP, DIMENSIONS, STEP):
            d = part[row, i:i + STEP] - c[centroid, i:i + STEP]
            total = total + (d * d).sum(axis=1)
            if i + STEP < DIMENSIONS:
                stay = total <= bound[row]
                row, centroid, total = row[stay], centroid[stay], total[stay]
        starts = np.flatnonzero(np.diff(row, prepend=-1))  # every row is left, ordered by row, then by number
        least = np.minimum.reduceat(total, starts)
        best = np.flatnonzero(total == least[row])
        winner = best[np.flatnonzero(np.diff(row[best], prepend=-1))]
        number[at:at + n], distance[at:at + n] = centroid[winner], least // DIMENSIONS
    return number, distance


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        if batch.num_rows:
            yield batch, integers(batch.column("_v").flatten().to_numpy(zero_copy_only=False))


def _sums(vectors: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Rows and exact component sums per cluster. Sums travel as decimal text, added up per task,
    per group of tasks, then per cluster, so no group grows with the rows."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums = np.zeros(len(centroids), np.int64), np.zeros((len(centroids), DIMENSIONS), object)
        for _, x in _blocks(batches):
            number, _ = nearest(x, centroids)
            for k in np.unique(number).tolist():
                mine = x[number == k]
                count[k] += len(mine)
                sums[k] += mine.sum(axis=0).astype(object)
        used = np.flatnonzero(count)
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), pa.array([part % 64] * len(used), pa.int64()), pa.array(count[used], pa.int64()),
             pa.array([[str(s) for s in sums[k]] for k in used], pa.list_(pa.string()))], ["cluster", "fold", "n", "sums"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = [sum(map(int, column)) for column in zip(*pdf["sums"])]
        return pd.DataFrame({"cluster": pdf["cluster"].iloc[:1], "fold": pdf["fold"].iloc[:1], "n": [int(pdf["n"].sum())],
                             "sums": [[str(s) for s in total]]})

    schema = "cluster long, fold long, n long, sums array<string>"
    parts = vectors.mapInArrow(partial, schema)
    for keys in (["cluster", "fold"], ["cluster"]):
        parts = parts.groupBy(*keys).applyInPandas(add, schema)
    return {r["cluster"]: (r["n"], [int(s) for s in r["sums"]]) for r in parts.collect()}  # at most k rows


def _as_array(rows: list[list[int]]) -> np.ndarray:
    big = any(abs(v) >= SMALL for row in rows for v in row)
    return np.array(rows, object if big else np.int64).reshape(len(rows), DIMENSIONS)


def fit(vectors: DataFrame, vec_id: str, vector: str, k: int = CENTROIDS, rounds: int = ROUNDS, seed: str = SEED) -> np.ndarray:
    """The centroids after `rounds` rounds. `vectors` holds valid rows only."""
    mark = F.sha2(F.concat(F.lit(seed), F.col(vec_id).cast("string")).cast("binary"), 256)
    first = (vectors.select(mark.alias("_m"), F.col(vector).alias("_v")).where(F.col("_m").isNotNull())
             .orderBy("_m", F.col("_v")).limit(k).collect())
    if not first:
        return np.zeros((0, DIMENSIONS), np.int64)
    centroids = _as_array([integers(np.array(r["_v"], np.float64))[0].tolist() for r in first])
    values = vectors.select(F.col(vector).alias("_v"))
    for _ in range(rounds):
        sums = _sums(values, centroids)
        centroids = _as_array([[s // sums[i][0] for s in sums[i][1]] if i in sums else row
                               for i, row in enumerate(centroids.tolist())])
    return centroids


def assign(vectors: DataFrame, vec_id: str, vector: str, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster, distance (text of an exact integer) of every row."""
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in _blocks(batches):
            number, distance = nearest(x, centroids)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(number, pa.int32()),
                                              pa.array([str(d) for d in distance])], ["vec_id", "cluster", "distance"])

    return vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("_v")).mapInArrow(
        place, "vec_id long, cluster int, distance string")


def cluster(embeddings: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", k: int = CENTROIDS,
            rounds: int = ROUNDS, seed: str = SEED) -> DataFrame:
    """Per kept vector: its cluster, squared distance, the inertias and its centroid's digest."""
    vectors = embeddings.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector")).where(valid("vector"))
    centroids = fit(vectors, "vec_id", "vector", k, rounds, seed)
    digests = [hashlib.sha256(",".join(str(v) for v in row).encode()).hexdigest() for row in centroids.tolist()]
    if not digests:  # no vector starts a centroid: none can be assigned
        vectors = vectors.limit(0)
    placed = stored(assign(vectors, "vec_id", "vector", centroids), "clusters")
    exact = placed.select("cluster", F.expr("try_cast(distance as decimal(38,0))").alias("_d"))
    total = F.when(F.count("_d") == F.count(F.lit(1)), F.try_sum("_d"))
    inertia = {r["cluster"]: r["s"] for r in exact.groupBy("cluster").agg(total.alias("s")).collect()}  # k rows
    whole = sum(inertia.values()) if all(s is not None for s in inertia.values()) else None

    def fits(n) -> Column:
        return F.lit(int(n) if n is not None and n < 1 << 63 else None).cast("long")

    def by_cluster(values: list[Column]) -> Column:
        return F.get(F.array(*values), F.col("cluster")) if values else F.lit(None)

    return placed.select(
        "vec_id", "cluster", F.expr("try_cast(distance as bigint)").alias("distance"),
        by_cluster([fits(inertia.get(i, 0)) for i in range(len(digests))]).cast("long").alias("cluster_inertia"),
        fits(whole).alias("inertia"), by_cluster([F.lit(d) for d in digests]).cast("string").alias("centroid_sha256"))
