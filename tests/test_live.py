"""The live view after every batch equals a full recount of the latest row per id."""
import os
from collections import Counter

from pyspark.sql import functions as F

from aspectra.sources.envelope import stream_envelope_files, to_envelope, write_envelope_files, write_in_turn
from aspectra.streaming import live, runner


def test_view_after_each_batch_equals_a_recount(spark, scratch):
    rows = []  # (turn, id, position, a, b)
    for turn in range(4):
        for i in range(60):
            if (i * 7 + turn) % (turn + 1) == 0 or turn == 0:
                rows.append((turn, f"id {i}", turn * 1000 + i, "xyz"[(i + turn) % 3], None if i % 5 == turn else "k"))
    rows += [(2, "id 3", 1, "old", "old"), (1, None, 1500, "x", "k"), (3, "id 4", 9001, "x", "k"), (3, "id 4", 9000, "z", "z")]
    df = spark.createDataFrame([(t, i, p, a, b) for t, i, p, a, b in rows], "turn int, id string, position long, a string, b string")
    env = to_envelope(df.withColumn("n", F.monotonically_increasing_id()), F.to_json(F.struct("turn", "id", "position", "a", "b")), "t", F.col("n"))
    turn = F.get_json_object(F.col("value").cast("string"), "$.turn").cast("int")
    path = write_in_turn(env, os.path.join(scratch, "t"), turn, range(4), 1)
    parsed = F.from_json(F.col("value").cast("string"), "id string, position long, a string, b string").alias("p")
    src = stream_envelope_files(spark, path, max_files_per_trigger=1).select(parsed).select("p.*")
    out = os.path.join(scratch, "deltas")
    q = runner.run_available(runner.foreach_batch(live.signed_changes(src, "id", "position", ["a", "b"], buckets=7), live.deltas_sink(out),
                                                  os.path.join(scratch, "c")))
    assert q.lastProgress["batchId"] >= 3
    for batch in range(4):
        latest = {}
        for t, i, p, a, b in rows:
            if t <= batch and i is not None and (i not in latest or p > latest[i][0]):
                latest[i] = (p, a, b or "NONE")
        want = Counter(("a", v[1]) for v in latest.values()) + Counter(("b", v[2]) for v in latest.values())
        got = {(r["name"], r["value"]): r["count"] for r in live.live_counts(spark, out, batch).collect()}
        assert got == dict(want), batch


def test_a_replayed_batch_counts_once(spark, scratch):
    sink = live.deltas_sink(os.path.join(scratch, "d"))
    batch = spark.createDataFrame([("a", "x", 1), ("a", "x", 1), ("a", "y", -1)], "name string, value string, delta long")
    for batch_id in (0, 0, 1):
        sink(batch, batch_id)
    got = {(r["name"], r["value"]): r["count"] for r in live.live_counts(spark, os.path.join(scratch, "d")).collect()}
    assert got == {("a", "x"): 4, ("a", "y"): -2}


def test_state_names_every_combination_once(spark, scratch):
    columns = [f"c{i}" for i in range(8)]
    df = spark.range(4000).select(F.col("id").alias("position"), F.concat(F.lit("id "), F.col("id")).alias("id"),
                                  *[F.lit("NONE").alias(c) for c in columns])
    path = os.path.join(scratch, "rows")
    df.repartition(2).write.parquet(path)
    src = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", "1").parquet(path)
    out = os.path.join(scratch, "deltas")
    q = runner.run_available(runner.foreach_batch(live.signed_changes(src, "id", "position", columns, buckets=4), live.deltas_sink(out),
                                                  os.path.join(scratch, "c")))
    assert {(r["name"], r["value"]): r["count"] for r in live.live_counts(spark, out).collect()} == {(c, "NONE"): 4000 for c in columns}
    # of the last version, and of the one before, about 20 bytes an id; 8 values and an id as an array take over 150
    assert max(p["stateOperators"][0]["memoryUsedBytes"] for p in q.recentProgress) < 4000 * 100


def test_a_stored_topic_has_small_row_groups(spark, scratch):
    """A batch of few files keeps many tasks busy only if the files can be split."""
    import glob

    import pyarrow.parquet as pq

    text = F.concat(*[F.sha2(F.concat_ws("-", "id", F.lit(i)), 256) for i in range(16)])
    env = to_envelope(spark.range(30_000), text, "t", F.col("id")).coalesce(1)
    path = write_envelope_files(env, os.path.join(scratch, "topic"))
    write_in_turn(env, os.path.join(scratch, "turns"), F.lit(0), range(1), 1)
    for file in glob.glob(f"{path}/*.parquet") + glob.glob(f"{scratch}/turns/*/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        assert meta.num_rows == 30_000 and meta.num_row_groups >= 3
