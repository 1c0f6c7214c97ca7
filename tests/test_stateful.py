"""Streams with state that ends: windows with late rows, replay gaps, de-duplication, evaluation."""
import os
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from aspectra.operators import metrics as M
from aspectra.operators import series as SR
from aspectra.plans import stateful as SF
from aspectra.plans import streams as ST
from aspectra.plans.queries import EVAL_PAIRS
from aspectra.plans.reviews import labelled_predictions
from aspectra.sources.envelope import labelled_messages, stream_envelope_files, to_envelope, write_in_turn
from aspectra.streaming import runner
from aspectra.streaming import windows as W
from aspectra.streaming.sinks import lake_writer
from conftest import SF0001

T0 = datetime(2024, 1, 1)


def progress(query):
    return [p for p in query.recentProgress if p["numInputRows"]]


def events_in_turns(spark, rows, path):
    """rows: (turn, hours since T0, key)."""
    df = spark.createDataFrame([(i, t, T0 + timedelta(hours=h), k, 1.0) for i, (t, h, k) in enumerate(rows)],
                               "event_id LONG, turn INT, ts TIMESTAMP, event_type STRING, value DOUBLE")
    env = SF.event_messages(df).join(df.select(F.col("event_id").alias("offset"), "turn"), "offset")
    return write_in_turn(env, path, F.col("turn"), range(max(t for t, _, _ in rows) + 1), 1)


def test_state_ends_and_late_rows_are_kept_apart(spark, scratch):
    rows = [(turn, 24 * turn + i / 4, "ab"[i % 2]) for turn in range(8) for i in range(96)]
    rows += [(5, 24 * 4 + 1.5, "a"), (5, 24 * 2 + 0.5, "a"), (6, 3.5, "b"), (6, 24 * 6 + 0.5, "b")]
    src = SF.events_of(stream_envelope_files(spark, events_in_turns(spark, rows, os.path.join(scratch, "t")), max_files_per_trigger=1))
    counts, late = os.path.join(scratch, "w"), os.path.join(scratch, "late")
    q = runner.run_available(W.windows_query(src, counts, os.path.join(scratch, "c1"), "ts", "1 hour", "6 hours", ["event_type"], "value"))
    runner.run_available(runner.foreach_batch(src, W.late_rows_sink(late, "ts", "1 hour", "6 hours"), os.path.join(scratch, "c2")))
    assert len(progress(q)) == 8
    held = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress]
    assert max(held) <= 2 * (48 + 6 + 2) and held[-1] <= 2 * 8  # of 2 * 192 windows
    assert all(p["sink"]["description"].startswith("ForeachBatch") for p in progress(q))
    out = {(r["window_start"], r["event_type"]): r["n"] for r in W.latest_windows(spark.read.parquet(counts), ["event_type"]).collect()}
    dropped = W.read_late_rows(spark, late, src.schema).collect()
    assert sorted((r["ts"] - T0).total_seconds() / 3600 for r in dropped) == [3.5, 48.5]
    assert sum(out.values()) + len(dropped) == len(rows)
    assert sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in q.recentProgress) == 2
    assert out[(T0 + timedelta(hours=97), "a")] == 3 and out[(T0 + timedelta(hours=48), "a")] == 2


def test_replayed_windows_replace_their_versions(spark, scratch):
    sink = W.versions_sink(os.path.join(scratch, "v"))
    batch = spark.createDataFrame([(T0, T0, "a", 1), (T0 + timedelta(days=1), T0, "a", 2)],
                                  "window_start TIMESTAMP, window_end TIMESTAMP, event_type STRING, n LONG")
    sink(batch, 0)
    sink(batch, 0)
    sink(batch.limit(1).withColumn("n", F.lit(9).cast("long")), 1)
    versions = spark.read.parquet(os.path.join(scratch, "v"))
    assert versions.count() == 3
    assert sorted(r["n"] for r in W.latest_windows(versions, ["event_type"]).collect()) == [2, 9]


def test_gaps_of_a_shuffled_stream(spark, scratch):
    """Ties, a hot series, a burst, points without a time, buckets without points."""
    hours = [0, 0, 0.5, 1, 30, 30, 30, 31, 200, 200.25] + [55.0] * 200 + [60 + i / 50 for i in range(300)]
    points = [("hot" if i % 5 else "cold", i, T0 + timedelta(hours=h), float(i)) for i, h in enumerate(hours)]
    points += [("hot", 1000, None, 1.0), ("cold", 1001, None, 2.0)]
    df = spark.createDataFrame(points, "series STRING, offset LONG, ts TIMESTAMP_NTZ, value DOUBLE")
    env = to_envelope(df, F.to_json(F.struct("series", "value")), "s", F.col("offset"), timestamp=F.col("ts"))
    path = write_in_turn(env, os.path.join(scratch, "t"), F.pmod(F.xxhash64("offset"), F.lit(4)).cast("int"), range(4), 1)
    beat = to_envelope(spark.range(1), F.lit("{}"), "s", F.lit(-1), timestamp=F.lit(T0 + timedelta(days=60)))
    write_in_turn(beat, path, F.lit(9), range(9, 10), 1)
    parsed = F.from_json(F.col("value").cast("string"), "series STRING, value DOUBLE").alias("p")
    src = stream_envelope_files(spark, path, max_files_per_trigger=1).select("offset", F.col("timestamp").alias("ts"), parsed)
    stream = SR.stream_gaps(src.select("p.series", "offset", "ts", "p.value"), "30 days")
    out = os.path.join(scratch, "out")
    q = runner.run_available(lake_writer(stream, out, os.path.join(scratch, "c")))
    assert len(progress(q)) == 5
    got = SR.stitched_gaps(spark.read.parquet(out).where("offset >= 0")).select("series", "offset", "ts", "value", "gap_s", "offset_s")
    want = SR.replay_gaps(df).select(*got.columns)
    assert got.count() == len(points) and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_a_topic_is_computed_once_for_all_turns(spark, scratch):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def turn(offset):
        seen.add(1)
        return offset % 5 if offset < 50 else None

    env = to_envelope(spark.range(60), F.col("id").cast("string"), "t", F.col("id"))
    path = write_in_turn(env, os.path.join(scratch, "t"), turn.asNondeterministic()("offset"), range(1, 5), 1)
    assert seen.value == 60
    for i in range(1, 5):
        got = sorted(r["offset"] for r in spark.read.parquet(f"{path}/turn{i:04d}").collect())
        assert got == list(range(i, 50, 5))
    assert not os.path.exists(f"{path}/turn0000")


def test_points_without_a_time_spread(spark):
    df = spark.range(4000).select(F.lit("s").alias("series"), F.col("id").alias("offset"),
                                  F.lit(None).cast("timestamp_ntz").alias("ts"), F.lit(1.0).alias("value"))
    chunks = SR.chunked(df).groupBy("_b").count()
    assert chunks.count() > 3000 and chunks.where("_b >= 0").count() == 0
    assert SR.replay_gaps(df).where("gap_s is not null or offset_s is not null").count() == 0


def test_copies_within_the_watermark_go_and_state_ends(spark, scratch):
    df = spark.range(1000).select("id", (F.lit(T0).cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), "id")).alias("ts"))
    env = to_envelope(df, F.col("id").cast("string"), "t", F.col("id"), timestamp=F.col("ts"))
    turn = F.floor(F.col("offset") / 100).cast("int")
    twice = env.unionByName(env).withColumn("_n", F.explode(F.array(F.lit(0), F.lit(1))))
    path = write_in_turn(twice, os.path.join(scratch, "t"), turn + F.col("_n"), range(11), 1)
    once = SF.once_each(stream_envelope_files(spark, path, max_files_per_trigger=1), "timestamp", "4 hours")
    out = os.path.join(scratch, "o")
    q = runner.run_available(lake_writer(once, out, os.path.join(scratch, "c")))
    got = spark.read.parquet(out)
    assert got.count() == 1000 and got.select("offset").distinct().count() == 1000
    assert len(progress(q)) == 11
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress) < 700  # four hours and two turns of 1,000


def test_evaluation_in_the_stream_equals_the_batch(spark):
    docs, labels = (spark.read.parquet(f"{SF0001}/{t}.parquet") for t in ("documents", "labels"))
    env = labelled_messages(docs.repartition(8), labels)
    counts = ST.confusion_stream(spark, env, "test_confusion", EVAL_PAIRS)
    got = {r["Aspect"]: tuple(r) for r in M.metrics_of(counts, [a for a, _, _ in EVAL_PAIRS]).collect()}
    want = {r["Aspect"]: tuple(r) for r in M.eval_metrics(labelled_predictions(spark, SF0001), EVAL_PAIRS).collect()}
    assert got == want
