"""Batch = stream, restart from checkpoint, memory sink, idempotent JDBC sink, failure replay."""
import os

import pytest
from pyspark.sql import functions as F

from aspectra.config import ASPECTS, RESULT_TABLE
from aspectra.plans import streams as ST
from aspectra.plans.reviews import scored_reviews
from aspectra.sources.envelope import review_messages, stream_envelope_files, write_envelope_files
from aspectra.streaming import runner
from aspectra.streaming.sinks import (jdbc_batch_sink, jdbc_reader, lake_writer, memory_writer, snapshot,
                                      with_source_key)
from conftest import SF0001


def _docs(spark):
    return spark.read.parquet(f"{SF0001}/documents.parquet")


def test_batch_equals_stream(spark, scratch):
    batch = scored_reviews(spark, SF0001).select("id", *ASPECTS)
    path = write_envelope_files(review_messages(_docs(spark)), os.path.join(scratch, "topic"))
    stream = ST.score_stream(stream_envelope_files(spark, path, max_files_per_trigger=1)).select("id", *ASPECTS)
    out = os.path.join(scratch, "out")
    runner.run_available(lake_writer(stream, out, os.path.join(scratch, "ckpt")))
    got = spark.read.parquet(out)
    assert got.count() == batch.count()
    assert got.exceptAll(batch).count() == 0


def test_restart_resumes_without_loss_or_duplicates(spark, scratch):
    docs = _docs(spark)
    topic, out, ckpt = (os.path.join(scratch, x) for x in ("topic", "out", "ckpt"))
    env = review_messages(docs)
    env.filter("offset < 100").write.parquet(os.path.join(topic, "part1"))

    def run():
        src = spark.readStream.schema("key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP") \
            .option("recursiveFileLookup", "true").parquet(topic)
        runner.run_available(lake_writer(ST.score_stream(src).select("offset", "id"), out, ckpt))

    run()
    first = spark.read.parquet(out).count()
    env.filter("offset >= 100").write.parquet(os.path.join(topic, "part2"))   # new input between runs
    run()
    back = spark.read.parquet(out)
    assert first == 100
    assert back.count() == docs.count() and back.select("offset").distinct().count() == docs.count()


def test_memory_sink_snapshot_across_batches(spark, scratch):
    topic = os.path.join(scratch, "topic")
    env = review_messages(_docs(spark))
    env.filter("offset < 50").write.parquet(os.path.join(topic, "a"))
    src = stream_envelope_files(spark, topic + "/*")
    q = memory_writer(src.select("offset"), "mem_snapshot_test").start()
    try:
        q.processAllAvailable()
        n1 = snapshot(spark, "mem_snapshot_test").count()
        env.filter("offset >= 50").write.parquet(os.path.join(topic, "b"))
        q.processAllAvailable()
        n2 = snapshot(spark, "mem_snapshot_test").count()
    finally:
        q.stop()
    assert n1 == 50 and n2 == env.count()


def test_jdbc_sink_is_idempotent_per_batch(spark):
    url = ST.derby_url(spark, "unit")
    sink = jdbc_batch_sink(url, RESULT_TABLE, ["review", *ASPECTS], ST.DERBY_PROPS,
                           rename={"review": "ReviewText"}, column_types=ST.RESULT_TYPES)
    batch = with_source_key(scored_reviews(spark, SF0001))
    sink(batch, 0)
    sink(batch, 0)      # replay of the same batch
    sink(batch.limit(0), 1)  # empty batch is skipped
    back = jdbc_reader(spark, url, RESULT_TABLE, ST.DERBY_PROPS)
    assert back.count() == batch.count()
    assert back.select("src_offset").distinct().count() == batch.count()


@pytest.mark.parametrize("replay", [False, True])
def test_jdbc_stream_stores_reviews_without_text(spark, replay):
    docs = spark.createDataFrame([(1, "great quality"), (2, None), (3, ""), (4, "x" * 40000)], "doc_id long, text string")
    rows = ST.jdbc_stream(spark, review_messages(docs), "no_text", replay_batches=replay).collect()
    back = {r.src_offset: r.asDict() for r in rows}
    assert len(rows) == 4 and {k: r["ReviewText"] for k, r in back.items()} == {1: "great quality", 2: None, 3: "", 4: "x" * 40000}
    assert {back[2][a] for a in ASPECTS} == {None} and back[1]["Quality"] == "POS"
    assert {back[k][a] for k in (3, 4) for a in ASPECTS} == {"NONE"}


def test_sink_error_is_raised_so_batch_is_replayed(spark, scratch):
    topic = write_envelope_files(review_messages(_docs(spark)), os.path.join(scratch, "topic"))
    ckpt, out = os.path.join(scratch, "ckpt"), os.path.join(scratch, "docs")
    calls = {"n": 0}

    def flaky(df, batch_id):
        calls["n"] += 1
        if calls["n"] == 1:
            raise IOError("database down")
        df.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    src = stream_envelope_files(spark, topic).select("offset")
    from pyspark.errors import StreamingQueryException

    with pytest.raises(StreamingQueryException, match="database down"):
        runner.run_available(runner.foreach_batch(src, flaky, ckpt, trigger="available"))
    runner.run_available(runner.foreach_batch(stream_envelope_files(spark, topic).select("offset"), flaky, ckpt,
                                              trigger="available"))
    assert spark.read.parquet(out).count() == _docs(spark).count()


def test_windowed_stream_with_watermark(spark, scratch):
    from aspectra.operators.trend import stream_tumbling

    ev = spark.read.parquet(f"{SF0001}/events.parquet")
    path = os.path.join(scratch, "events")
    ev.write.parquet(path)
    src = spark.readStream.schema(ev.schema).parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))
    agg = stream_tumbling(src, "ts", "1 hour", "2 hours", ["event_type"])
    out = os.path.join(scratch, "agg")
    runner.run_available(lake_writer(agg, out, os.path.join(scratch, "ckpt")))
    got = spark.read.parquet(out)
    # append mode withholds windows that the watermark has not passed yet
    assert 0 < got.count() <= ev.groupBy(F.window("ts", "1 hour"), "event_type").count().count()


def test_rate_number_stream(spark):
    import time

    from aspectra.sources.envelope import number_sequence, number_stream

    q = memory_writer(number_stream(spark, rows_per_second=20).select(F.col("value").cast("string").alias("v")),
                      "rate_numbers_test").start()
    try:
        time.sleep(3)
        q.processAllAvailable()
        rows = [r.v for r in snapshot(spark, "rate_numbers_test").collect()]
    finally:
        q.stop()
    assert rows and all(v.startswith('{"number": ') for v in rows)
    assert number_sequence(spark, 1000).count() == 1000
