"""Odd records in the anomaly path: no error, a null score, a null verdict."""

from pyspark.sql import functions as F

from aspectra.operators import anomaly
from aspectra.plans import fixed_forest


def test_odd_points_have_no_score(spark):
    rows = [(1, [[0.1, 0.2]]), (2, []), (3, [[0.1]]), (4, [None]), (5, None), (6, [[None, 0.1], [0.3, 0.1]]), (7, [[0.1, 0.2, 9.0]])]
    forest = anomaly.Forest(fixed_forest.nodes_frame(), fixed_forest.PSI)
    df = spark.createDataFrame(rows, "id int, data array<array<double>>").coalesce(1)
    scored = df.select("id", anomaly.score_points(spark, forest, F.col("data")).alias("s"))
    got = {r["id"]: (r["s"], r["v"]) for r in scored.withColumn("v", anomaly.verdict(F.get("s", F.lit(0)), 0.0)).collect()}
    assert got[1][0][0] is not None and got[1][1] in (1, -1) and got[7][0] == got[1][0]
    assert got[2] == ([], None) and got[3] == ([None], None) and got[4] == ([None], None) and got[5] == (None, None)
    assert got[6][0][0] is None and got[6][0][1] is not None


def test_any_point_may_raise_the_alert(spark):
    from aspectra.plans.queries import alert_records

    rows = [(1, [[0.0]], "t", [-0.2, -0.9]), (2, [[0.0]], "t", [-0.9]), (3, [[0.0]], "t", [-0.1, None]), (4, [[0.0]], "t", []), (5, None, "t", None)]
    df = spark.createDataFrame(rows, "id int, data array<array<double>>, current_time string, scores array<double>")
    assert [r["id"] for r in alert_records(df, -0.5).collect()] == [2]
    assert sorted(r["id"] for r in alert_records(df, -0.5, any_point=True).collect()) == [1, 2]


def test_nulled_fields_are_counted(spark):
    from aspectra.functions.json import LABELLED_DDL, nulled_fields, parse_envelope

    values = ['{"review_text": "a", "Price": 1}', '{"review_text": "a", "Price": 1.5, "Size": "x"}', '{"review_text": null, "Price": null}', "{bad", None]
    env = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "value string, offset long").selectExpr("cast(value as binary) value", "offset")
    parsed = parse_envelope(env, LABELLED_DDL, keep=("offset",))
    got = {r["offset"]: r["n"] for r in parsed.select("offset", nulled_fields(parsed).alias("n")).collect()}
    assert got == {0: 0, 1: 2, 2: 0, 3: 0, 4: 0}
