"""Rows-only queries checked against a brute-force NumPy computation on sf0.001."""
import re

import numpy as np
from pyspark.sql import functions as F

from aspectra.config import ASPECTS, SENTIMENTS
from aspectra.functions import text as tx
from aspectra.operators import anomaly as AN
from aspectra.operators.scoring import CnnScorer, cnn_forward, random_cnn_weights, widen
from conftest import SF0001


def test_cnn_scores_equal_numpy(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    vocab_df = tx.build_vocabulary(docs, "text", size=500)
    vocab = {r.token: r.id for r in vocab_df.collect()}
    weights = random_cnn_weights(max(vocab.values()) + 1, seed=11)
    got = {r.doc_id: [getattr(r, a) for a in ASPECTS]
           for r in widen(CnnScorer(spark, dict(vocab), weights).score(docs.select("doc_id", "text"), "text")).collect()}
    rows = docs.select("doc_id", "text").collect()
    ids = np.zeros((len(rows), 64), np.int64)
    for i, r in enumerate(rows):
        seq = [vocab.get(t, 1) for t in re.findall(r"\w+", r.text.lower())][:64]
        ids[i, :len(seq)] = seq
    probs = cnn_forward(ids, weights)
    for i, r in enumerate(rows):
        assert got[r.doc_id] == [SENTIMENTS[k] for k in probs[i].argmax(axis=1)]


def test_fitted_forest_scores_equal_numpy(spark):
    li = spark.read.parquet(f"{SF0001}/lineitem.parquet").withColumn(
        "k", F.concat_ws("|", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    nodes = AN.fit(li, ["l_quantity", "l_extendedprice"], "k", trees=8, psi=128)
    forest = AN.Forest.from_frame(nodes, 128)
    scored = li.select("l_quantity", "l_extendedprice",
                       AN.score_points(spark, forest, F.array(F.array("l_quantity", "l_extendedprice")))[0].alias("s"))
    rows = scored.collect()
    x = np.array([[r.l_quantity, r.l_extendedprice] for r in rows])
    assert np.allclose([r.s for r in rows], forest.scores(x))
    # brute force over leaf boxes: every point lands in exactly one leaf of every tree
    pdf = nodes.toPandas()
    for t, g in pdf.groupby("tree"):
        by = {int(r.node): r for r in g.itertuples()}
        for p in x[:50]:
            nid = 0
            while by[nid].feature >= 0:
                nid = int(by[nid].left) if p[int(by[nid].feature)] < by[nid].threshold else int(by[nid].right)
            assert by[nid].leaf_len >= 0


def test_hash_sample_is_uniform_without_replacement(spark):
    pts = AN.training_points(spark, 500).withColumn("k", F.col("id").cast("string"))
    nodes = AN.fit(pts, ["x", "y"], "k", trees=5, psi=200)
    # root of each tree splits inside the sampled data range of the 1000 points
    roots = nodes.filter("node = 0").collect()
    assert len(roots) == 5 and all(r.feature in (0, 1) for r in roots)


def test_stream_cnn_to_table_equals_batch_cnn(spark):
    import __spark_entry__ as E

    qs = E.queries()
    stream = qs["stream_cnn_to_table"](spark, SF0001).select(F.col("src_offset").alias("doc_id"), *ASPECTS)
    batch = qs["cnn_probabilities"](spark, SF0001)
    assert stream.count() == batch.count()
    assert stream.exceptAll(batch.select("doc_id", *ASPECTS)).count() == 0
