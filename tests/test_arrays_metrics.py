"""Argmax/decode expressions and dashboard / evaluation aggregates."""
import math
import random

import pytest
from pyspark.sql import functions as F

from aspectra.config import ASPECTS, DASHBOARD_SENTIMENTS
from aspectra.functions import arrays as arr
from aspectra.operators import metrics as M


def test_argmax_first_of_ties_and_nan(spark):
    df = spark.createDataFrame([([0.1, 0.4, 0.4, 0.1],), ([0.2, float("nan"), 0.9, 0.0],), ([0.25] * 4,)],
                               "p ARRAY<FLOAT>")
    assert [r.i for r in df.select(arr.argmax("p").alias("i")).collect()] == [1, 1, 0]


def test_label_maps(spark):
    df = spark.createDataFrame([(i,) for i in [0, 1, 2, 3, 7]], "i INT")
    out = df.select(arr.index_to_label(F.col("i")).alias("l"), arr.index_to_sentiment(F.col("i")).alias("s")).collect()
    assert [r.l for r in out] == [-1, 0, 1, 2, -99]
    assert [r.s for r in out] == ["NONE", "NEG", "POS", "NEU", None]
    s = spark.createDataFrame([("NONE",), ("NEG",), ("POS",), ("NEU",), (None,), ("X",)], "s STRING")
    assert [r.l for r in s.select(arr.sentiment_to_label(F.col("s")).alias("l")).collect()] == [-1, 0, 1, 2, None, None]


@pytest.mark.parametrize("include_none", [False, True])
def test_counts_zero_filled_grid(spark, include_none):
    rows = [("POS", None, "NEG"), ("POS", "NEU", None)]
    df = spark.createDataFrame(rows, "Price STRING, Size STRING, Others STRING")
    stats = M.sentiment_counts(df, include_none=include_none).collect()
    sents = DASHBOARD_SENTIMENTS + (["NONE"] if include_none else [])
    assert len(stats) == 3 * len(sents)            # only aspect columns present
    got = {(r.Aspect, r.Sentiment): r.Count for r in stats}
    assert got[("Price", "POS")] == 2 and got[("Price", "NEG")] == 0
    assert got[("Size", "NEU")] == 1
    if include_none:
        assert got[("Size", "NONE")] == 1 and got[("Others", "NONE")] == 1


def test_shares_sum_to_one_and_zero_total(spark):
    df = spark.createDataFrame([("POS",), ("NEG",), ("NEG",)], "Price STRING")
    share = M.sentiment_share(M.sentiment_totals(M.sentiment_counts(df))).collect()
    assert abs(sum(r.Share for r in share) - 1.0) < 1e-9
    empty = spark.createDataFrame([], "Price STRING")
    assert all(r.Share == 0.0 for r in M.sentiment_share(M.sentiment_totals(M.sentiment_counts(empty))).collect())


def test_weighted_f1_equals_mllib(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    rnd = random.Random(3)
    rows = [(float(rnd.choice([-1, 0, 1, 2])), float(rnd.choice([-1, 0, 1, 2])), None) for _ in range(400)]
    df = spark.createDataFrame(rows, "t DOUBLE, p DOUBLE, empty DOUBLE")
    pairs = [("A", "t", "p"), ("B", "empty", "p")]
    res = {r.Aspect: r for r in M.eval_metrics(df, pairs, digits=12).collect()}
    ev = df.select(F.col("t").alias("label"), F.col("p").alias("prediction"))
    f1 = MulticlassClassificationEvaluator(metricName="f1").evaluate(ev)
    acc = MulticlassClassificationEvaluator(metricName="accuracy").evaluate(ev)
    assert math.isclose(res["A"].f1, f1, abs_tol=1e-9) and math.isclose(res["A"].accuracy, acc, abs_tol=1e-9)
    assert res["B"].n == 0 and res["B"].f1 is None
    macro = M.eval_macro(M.eval_metrics(df, pairs)).first()
    assert macro.n_aspects == 1 and math.isclose(macro.avg_f1, round(f1, 6), abs_tol=1e-6)


def test_lexicon_scorer_rules(spark):
    from aspectra.operators.scoring import LexiconScorer, widen

    df = spark.createDataFrame([(1, "Great price but bad delivery, not good, never again"), (2, "the size is perfect"), (3, None)],
                               "k INT, t STRING")
    out = {r.k: r for r in widen(LexiconScorer().score(df, "t")).collect()}
    assert out[1].Price == "NEG" and out[1].Shipping == "NEG" and out[1].General == "NEG"
    assert out[2].Size == "POS" and out[2].Price == "NONE"
    assert all(getattr(out[3], a) is None for a in ASPECTS)


def test_counts_without_aspect_columns(spark):
    df = spark.createDataFrame([("x",)], "other STRING")
    out = M.sentiment_counts(df)
    assert out.columns == ["Aspect", "Sentiment", "Count"] and out.count() == 0


def test_nullable_label(spark):
    df = spark.createDataFrame([(2.0,), (float("nan"),), (None,), (-1.0,)], "v DOUBLE")
    assert [r.l for r in df.select(arr.nullable_label(F.col("v")).alias("l")).collect()] == [2, None, None, -1]
