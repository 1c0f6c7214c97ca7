"""File sources, option maps, CNN scorer, and the driver contract."""
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from aspectra.operators.scoring import CnnScorer, cnn_forward, random_cnn_weights, widen
from aspectra.sources import files as FS
from aspectra.streaming.sinks import consumer_options, producer_options
from conftest import SF0001


def test_required_columns_and_text_fallback(spark):
    df = spark.createDataFrame([("a", 1)], "Review STRING, Price INT")
    with pytest.raises(FS.MissingColumns, match="Shipping, Size"):
        FS.require_columns(df, ["Review", "Price", "Shipping", "Size"])
    assert df.select(FS.text_column(df).alias("t")).first().t == "a"
    df2 = spark.createDataFrame([(1, "b")], "id INT, text STRING")
    assert df2.select(FS.text_column(df2).alias("t")).first().t == "b"


def test_csv_round_trip_keeps_text(spark, scratch):
    rows = [(1, ' lead and trail ', 'x'), (2, 'line\nbreak, "quoted"', 'y'), (3, '', 'z'), (4, None, 'w')]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING")
    back = FS.read_csv(spark, FS.write_csv(df, scratch + "/csv"), "doc_id BIGINT, text STRING, lang STRING")
    assert sorted(back.collect()) == sorted(df.collect())


def test_option_maps():
    p = producer_options("b:9092", "anomalies")
    assert p["kafka.acks"] == "all" and p["kafka.enable.idempotence"] == "true"
    assert int(p["kafka.delivery.timeout.ms"]) >= int(p["kafka.linger.ms"]) + int(p["kafka.request.timeout.ms"])
    c = consumer_options("b:9092", "transactions", starting="latest", committed_only=True, max_offsets_per_trigger=100)
    assert c["kafka.isolation.level"] == "read_committed" and c["maxOffsetsPerTrigger"] == "100"
    assert consumer_options("b", "t", starting="smallest")["startingOffsets"] == "earliest"


def test_cnn_forward_shapes_and_padding():
    w = random_cnn_weights(50, seed=1)
    ids = np.zeros((3, 64), np.int64)
    ids[1, :5] = [5, 6, 7, 8, 9]
    p = cnn_forward(ids, w, sub_batch=2)
    assert p.shape == (3, 8, 4) and np.allclose(p.sum(axis=2), 1.0, atol=1e-5)
    assert np.allclose(p[0], p[2])      # all-padding rows agree


def test_cnn_scorer_null_text(spark):
    vocab = spark.createDataFrame([("good", 2), ("price", 3)], "token STRING, id INT")
    scorer = CnnScorer.from_vocabulary_df(spark, vocab, seed=3)
    df = spark.createDataFrame([(1, "good price"), (2, None)], "k INT, t STRING")
    out = {r.k: r for r in widen(scorer.score(df, "t")).collect()}
    assert out[2].Price is None and out[1].Price in {"NONE", "NEG", "POS", "NEU"}


def test_entry_and_registry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["Aspect", "Sentiment", "Count"] and len(rows) == 24
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs) and len(qs) >= 45


@pytest.mark.parametrize("name", ["sentiment_counts_with_none", "eval_metrics", "text_to_ids", "dead_letter",
                                  "replay_gaps", "anomaly_alerts"])
def test_oracle_small(spark, name):
    import duckdb

    from aspectra.plans.catalog import TABLES

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    sdf = E.queries()[name](spark, SF0001)
    cols = sorted(sdf.columns)
    got = sorted(tuple(r[c] for c in cols) for r in sdf.collect())
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    want = sorted(tuple(r[i] for i in idx) for r in res.fetchall())
    assert len(got) == len(want)
    for a, b in zip(got, want):
        for x, y in zip(a, b):
            if isinstance(x, float) and isinstance(y, float):
                assert x == pytest.approx(y, abs=1e-6)
            else:
                assert x == y


def test_cnn_from_files_and_failed_load(spark, scratch):
    import json as _json

    from aspectra.operators.scoring import load_artefacts, save_weights

    vocab = {"<pad>": 0, "<unk>": 1, "good": 2, "price": 3}
    vp, wp = scratch + "/vocab.json", scratch + "/w.npz"
    with open(vp, "w") as fh:
        _json.dump(vocab, fh)
    save_weights(random_cnn_weights(4, seed=5), wp)
    df = spark.createDataFrame([(1, "good price"), (2, None)], "k INT, t STRING")
    a = {r.k: r.Price for r in widen(CnnScorer.from_files(spark, vp, wp).score(df, "t")).collect()}
    b = {r.k: r.Price for r in widen(CnnScorer(spark, vocab, random_cnn_weights(4, seed=5)).score(df, "t")).collect()}
    assert a == b
    bad = scratch + "/bad.npz"
    np.savez(bad, embedding=np.zeros((4, 128), np.float32))
    for _ in range(2):  # the failure is not cached
        with pytest.raises(ValueError, match="lacks"):
            load_artefacts(vp, bad)


def test_forest_save_load(spark, scratch):
    from aspectra.operators import anomaly as AN

    pts = AN.training_points(spark, 200).withColumn("k", F.col("id").cast("string"))
    nodes = AN.fit(pts, ["x", "y"], "k", trees=4, psi=64)
    AN.save(nodes, scratch + "/forest", 64, ["x", "y"], -0.625)
    back, meta = AN.load(spark, scratch + "/forest")
    assert meta["psi"] == 64 and meta["threshold"] == -0.625 and back.count() == nodes.count()
    x = np.array([[2.0, 2.0], [-4.0, 4.0]])
    assert np.allclose(AN.Forest.from_frame(back, 64).scores(x), AN.Forest.from_frame(nodes, 64).scores(x))


def test_constant_payload_and_utc_now(spark):
    from aspectra.functions.timefn import utc_now_iso
    from aspectra.sources.envelope import constant_messages

    env = constant_messages(spark.range(100), b"Hello Kafka Python!!!")
    assert env.select("value").distinct().count() == 1 and env.count() == 100
    t = spark.range(1).select(utc_now_iso().alias("t")).first().t
    assert len(t) == 26 and t[10] == "T"


def test_bounded_run_and_console(spark, scratch):
    from aspectra.sources.envelope import review_messages, stream_envelope_files, write_envelope_files
    from aspectra.streaming import runner
    from aspectra.streaming.sinks import console_writer

    docs = spark.read.parquet(f"{SF0001}/documents.parquet").limit(3)
    path = write_envelope_files(review_messages(docs), scratch + "/t")
    src = stream_envelope_files(spark, path).select("offset")
    q = console_writer(src, truncate=False, with_arrival=True).option("checkpointLocation", scratch + "/c") \
        .trigger(processingTime="1 second").start()
    assert runner.bounded_run(q, 3) is False and not q.isActive   # stopped by the time limit
    calls = []

    def start():
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("first attempt fails")
        return runner.with_trigger(console_writer(src).option("checkpointLocation", scratch + "/c2"), "available").start()

    assert runner.retrying(start, attempts=3, limit_s=60) == 2


def test_spread_only_when_scan_is_narrow(spark, scratch):
    from aspectra.session import spread

    def exchanges(df):
        return df._jdf.queryExecution().executedPlan().toString().count("RoundRobinPartitioning")

    narrow = spark.read.parquet(f"{SF0001}/documents.parquet")      # one row group -> one task
    assert exchanges(spread(narrow, 4)) == 1
    spark.range(4000).repartition(8).write.parquet(scratch + "/wide")
    wide = spark.read.parquet(scratch + "/wide")
    assert wide.rdd.getNumPartitions() >= 4 and exchanges(spread(wide, 4)) == 0


def test_a_stored_topic_is_cut_into_small_row_groups(spark, scratch):
    """Short messages first, long ones after: however the sizes change, a task gets a few of the messages."""
    import glob

    import pyarrow.parquet as pq

    from aspectra.sources.envelope import to_envelope, write_envelope_files

    words = F.array_join(F.transform(F.sequence(F.lit(1), F.when(F.col("id") < 300, 1).otherwise(120)),
                                     lambda i: F.sha2(F.concat_ws(" ", F.col("id"), i), 256)), " ")
    write_envelope_files(to_envelope(spark.range(0, 2500, 1, 1), words, "t", F.col("id")), scratch)
    files = [pq.ParquetFile(f).metadata for f in glob.glob(f"{scratch}/*.parquet")]
    groups = [m.row_group(i) for m in files for i in range(m.num_row_groups)]
    assert sum(g.num_rows for g in groups) == 2500
    assert max(g.total_byte_size for g in groups) < 4 << 20
