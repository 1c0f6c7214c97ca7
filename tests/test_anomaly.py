"""Isolation forest: leaves, scoring, exact threshold, fit, verdict."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from aspectra.operators import anomaly as AN
from aspectra.plans import fixed_forest as FX


def test_each_point_in_exactly_one_leaf_per_tree():
    rng = np.random.default_rng(0)
    pts = np.column_stack([rng.uniform(0, 55, 2000), rng.uniform(0, 120000, 2000)])
    boxes = FX.leaf_boxes()
    forest = AN.Forest(FX.nodes_frame(), FX.PSI)
    lens = np.zeros(len(pts))
    for t in {b[0] for b in boxes}:
        inside = np.array([[all(lo[d] <= p[d] < hi[d] for d in range(2)) for (tt, lo, hi, _) in boxes if tt == t]
                           for p in pts])
        assert (inside.sum(axis=1) == 1).all()
        paths = np.array([pl for (tt, _, _, pl) in boxes if tt == t])
        lens += paths[inside.argmax(axis=1)]
    assert np.allclose(forest.path_lengths(pts), lens / 3)


@pytest.mark.parametrize("n,q", [(1, 0.01), (7, 0.5), (5000, 0.01), (5000, 0.999)])
def test_threshold_exact(spark, n, q):
    vals = np.random.default_rng(n).normal(size=n).round(3)  # many ties
    df = spark.createDataFrame([(float(v),) for v in vals], "s DOUBLE")
    assert AN.threshold(df, "s", q, cells=7) == pytest.approx(float(np.quantile(vals, q)), abs=1e-12)


def test_fit_and_score(spark):
    pts = AN.training_points(spark, 300, seed=1).withColumn("k", F.col("id").cast("string"))
    nodes = AN.fit(pts, ["x", "y"], "k", trees=10, psi=128)
    assert nodes.select("tree").distinct().count() == 10
    forest = AN.Forest.from_frame(nodes, 128)
    recs = spark.createDataFrame([(1, [[2.0, 2.0], [9.0, -9.0]]), (2, None)], "id INT, data ARRAY<ARRAY<DOUBLE>>")
    out = {r.id: r.s for r in recs.select("id", AN.score_points(spark, forest, F.col("data")).alias("s")).collect()}
    assert out[2] is None and len(out[1]) == 2
    assert out[1][1] < out[1][0]      # the far point is more abnormal (lower score)
    v = recs.filter("id = 1").select(AN.verdict(AN.score_points(spark, forest, F.col("data"))[0], -0.6).alias("v")).first().v
    assert v == 1                     # verdict uses the first (central) point


def test_synthetic_generators(spark):
    tr = AN.training_points(spark, 500)
    assert tr.count() == 1000
    ids = spark.range(200).withColumnRenamed("id", "i")
    txs = AN.synthetic_transactions(ids, "i")
    assert txs.count() == 200 and txs.filter(F.size("data") != 1).count() == 0
