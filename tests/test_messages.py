"""Message parsing, dead letters and the number topic edge rows."""
from pyspark.sql import functions as F

from aspectra.functions.json import LABELLED_DDL, REVIEW_DDL, parse_envelope, split_dead_letter
from aspectra.sources.envelope import number_messages


def _env(spark, values):
    rows = [(None if v is None else bytearray(v.encode()), "t", 0, i, None) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP")


def test_review_edge_rows(spark):
    env = _env(spark, ['{"id": 3, "review": "Good price"}', "{bad", "null", None, '{"id": 1}',
                       '{"id": 1, "review": null}', '{"id":1,"review":NaN}', "[1]"])
    good, bad = split_dead_letter(parse_envelope(env, REVIEW_DDL))
    g = {r.offset: (r.id, r.review) for r in good.collect()}
    assert g[0] == ("3", "Good price")          # JSON int read as text
    assert g[4] == ("1", None) and g[5] == ("1", None)
    assert g[6] == ("1", '"NaN"')                # bare NaN comes back quoted
    b = {r.offset: r.reason for r in bad.collect()}
    assert b == {1: "malformed_json", 2: "malformed_json", 3: "empty_payload", 7: "malformed_json"}


def test_labelled_bad_labels_are_null(spark):
    env = _env(spark, ['{"review_text": "ok", "Price": 2, "Size": null, "Quality": 1.5, "General": "2"}'])
    good, _ = split_dead_letter(parse_envelope(env, LABELLED_DDL))
    r = good.first()
    assert r.review_text == "ok" and r.Price == 2 and r.Size is None
    assert r.Quality is None and r.General is None


def test_number_substring_and_parity(spark):
    ev = spark.createDataFrame([(-3,), (7,), (12,), (40,)], "event_id BIGINT").withColumn("ts", F.current_timestamp())
    env = number_messages(ev)
    out = env.select(F.col("value").cast("string").substr(12, 1).alias("d")) \
        .withColumn("even", F.expr("try_cast(d AS INT)") % 2 == 0).collect()
    assert [r.d for r in out] == ["-", "7", "1", "4"]
    assert [r.even for r in out] == [None, False, False, True]
