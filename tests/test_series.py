"""Series parse and replay gaps: bucketed form equals the plain window."""
from pyspark.sql import Window
from pyspark.sql import functions as F

from aspectra.operators import series as SR
from conftest import SF001


def test_gap_edges(spark):
    pts = spark.createDataFrame(
        [("a", 1, "2024-01-01 00:00:10"), ("a", 2, "2024-01-01 00:00:00"), ("a", 3, "2024-01-01 00:00:10"),
         ("a", 4, "junk"), ("b", 5, "2024-01-01T05:00:00")], "series STRING, offset BIGINT, t STRING"
    ).withColumn("ts", SR.parse_timestamp(F.col("t")))
    out = {r.offset: (r.gap_s, r.offset_s) for r in SR.replay_gaps(pts, speed=10.0).collect()}
    assert out[2] == (0.0, 0.0)         # first after sorting
    assert out[1] == (1.0, 1.0)          # 10 s / speed 10
    assert out[3] == (0.0, 1.0)          # equal timestamps
    assert out[4] == (None, None)        # unparsable
    assert out[5] == (0.0, 0.0)


def test_bucketed_equals_plain_window(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    pts = ev.select(F.col("event_type").alias("series"), F.col("event_id").alias("offset"), "ts")
    got = SR.replay_gaps(pts, chunks=13).select("offset", "gap_s", "offset_s")
    us = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts"))
    w = Window.partitionBy("series").orderBy("ts", "offset")
    ref = pts.withColumn("u", us).select(
        "offset",
        F.coalesce((F.col("u") - F.lag("u").over(w)) / 1e7, F.lit(0.0)).alias("gap_s"),
        ((F.col("u") - F.min("u").over(Window.partitionBy("series"))) / 1e7).alias("offset_s"))
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0


def test_series_message_round_trip(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    env = SR.series_messages(ev, key="event_type", ts="ts", value="value", position="event_id")
    back = SR.parse_series(env).select("series", "offset", "ts", "value")
    ref = ev.select(F.col("event_type").alias("series"), F.col("event_id").alias("offset"), "ts", "value")
    assert back.exceptAll(ref).count() == 0 and back.count() == ref.count()


def test_hot_series_with_ties_split_into_chunks(spark):
    """One series holds most points (and a burst of equal timestamps): chunks
    stay balanced and the gaps equal the single-window answer."""
    import datetime as dt
    import random

    rnd = random.Random(5)
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(3000):
        series = "hot" if i < 2400 else f"s{i % 3}"
        if series == "hot" and i < 600:
            ts = t0 + dt.timedelta(seconds=100)            # burst: 600 equal timestamps
        else:
            ts = t0 + dt.timedelta(seconds=rnd.randint(0, 86_400), microseconds=rnd.randint(0, 999_999))
        rows.append((series, i, ts))
    pts = spark.createDataFrame(rows, "series STRING, offset BIGINT, ts TIMESTAMP_NTZ")
    sizes = [r.c for r in SR.chunked(pts, chunks=16).groupBy("series", "_b").count().withColumnRenamed("count", "c").collect()]
    assert max(sizes) <= 2400 / 16 * 1.5          # the 600-point burst is split too
    got = SR.replay_gaps(pts, chunks=16)
    us = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts"))
    w = Window.partitionBy("series").orderBy("ts", "offset")
    ref = pts.withColumn("u", us).select(
        "series", "offset", "ts",
        F.coalesce((F.col("u") - F.lag("u").over(w)) / 1e7, F.lit(0.0)).alias("gap_s"),
        ((F.col("u") - F.min("u").over(Window.partitionBy("series"))) / 1e7).alias("offset_s"))
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0
