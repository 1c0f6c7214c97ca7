"""Results table: stored once whatever is replayed; kept reviews; recovery over several batches."""
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aspectra.config import ASPECTS
from aspectra.plans import streams as ST
from aspectra.plans.reviews import scored_reviews
from aspectra.sources.envelope import review_messages
from aspectra.streaming import results as R
from conftest import SF0001

SCHEMA = T.StructType([T.StructField("v", T.StringType()), T.StructField("src_topic", T.StringType()),
                       T.StructField("src_partition", T.IntegerType()), T.StructField("src_offset", T.LongType())])


def rows(spark, offsets, partition=0, v="a"):
    return spark.createDataFrame([(v if o is None or o % 3 else None, "t", partition, o) for o in offsets], SCHEMA)


def offsets(table, spark):
    return sorted(r["src_offset"] for r in table.read(spark).collect())


@pytest.fixture()
def table(spark, scratch):
    return R.ResultTable(os.path.join(scratch, "results"), SCHEMA).create(spark)


def test_replays_and_other_checkpoints_store_once(spark, table):
    first, second = table.sink("first"), table.sink("second")
    first(rows(spark, range(0, 10)), 0)
    first(rows(spark, range(10, 20)), 1)
    first(rows(spark, range(10, 20)), 1)  # the same batch again
    second(rows(spark, range(5, 30)), 0)  # another checkpoint, other batch ends
    assert offsets(table, spark) == list(range(30))
    first(rows(spark, range(20, 25)), 2)  # nothing new
    assert offsets(table, spark) == list(range(30))
    assert {(r["writer"], r["batch_id"]): r["n_rows"] for r in table.batches(spark).collect()} == {
        ("first", 0): 10, ("first", 1): 10, ("second", 0): 10, ("first", 2): 0}
    runs = R.merged_runs(table.spans(spark)).collect()
    assert [(r["src_partition"], [tuple(x) for x in r["runs"]]) for r in runs] == [(0, [(0, 29)])]


def test_offsets_with_holes_and_partitions(spark, table):
    sink = table.sink("w")
    sink(rows(spark, [0, 2, 4, 1 << 21, (1 << 21) + 1]), 0)
    sink(rows(spark, [1, 2, 3, 5], partition=0), 1)
    sink(rows(spark, [2, 4], partition=1), 2)  # another topic partition has its own offsets
    other = table.sink("x")
    other(rows(spark, [0, 1, 2, 3, 4, 5, 6, (1 << 20) - 1, 1 << 20]), 0)
    got = sorted((r["src_partition"], r["src_offset"]) for r in table.read(spark).collect())
    assert got == [(0, o) for o in [0, 1, 2, 3, 4, 5, 6, (1 << 20) - 1, 1 << 20, 1 << 21, (1 << 21) + 1]] + [(1, 2), (1, 4)]


def test_a_batch_without_its_record_is_invisible(spark, table, monkeypatch):
    real = R.overwrite_partitions

    def dies(df, path, partitions):
        if path.endswith("batches"):
            raise ST.Stopped("before the record")
        real(df, path, partitions)

    monkeypatch.setattr(R, "overwrite_partitions", dies)
    with pytest.raises(ST.Stopped):
        table.sink("w")(rows(spark, range(5)), 0)
    monkeypatch.undo()
    assert offsets(table, spark) == [] and table.spans(spark).count() == 0
    table.sink("other")(rows(spark, range(5)), 0)  # another consumer stores them meanwhile
    table.sink("w")(rows(spark, range(5)), 0)  # its replay finds nothing left to store
    assert offsets(table, spark) == list(range(5))


def test_metrics_are_observed(spark, table):
    sink = table.sink("w", lambda df: df.withColumn("v", F.upper("v")))
    sink(rows(spark, range(6)), 0)
    sink(rows(spark, []), 1)
    sink(rows(spark, [None, None]), 2)  # rows without a position are stored as they come
    got = {r["batch_id"]: (r["n_rows"], r["nulls"]) for r in table.batches(spark).collect()}
    assert got[0][0] == 6 and got[0][1]["v"] == 2 and got[1][0] == 0 and got[2] == (2, {"v": 0, "src_topic": 0, "src_partition": 0, "src_offset": 2})
    assert table.batches(spark).agg(*R.null_totals(None, ["v"])).first()["null_v"] == 2
    assert sorted(str(r["v"]) for r in table.read(spark).collect()) == ["A"] * 6 + ["None"] * 2


def test_schema_must_carry_the_source_position():
    with pytest.raises(ValueError):
        R.ResultTable("x", T.StructType([T.StructField("v", T.StringType())]))


def test_recovery_over_several_batches(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").repartition(8)
    table = ST.recovery_drill(spark, review_messages(docs), "test_recovery")
    want = scored_reviews(spark, SF0001).select("id", *ASPECTS)
    got = table.read(spark).select("id", *ASPECTS)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    batches = {(r["writer"], r["batch_id"]): r["n_rows"] for r in table.batches(spark).collect()}
    assert sum(n > 0 for (w, _), n in batches.items() if w == "first") > 2
    assert all(n == 0 for (w, _), n in batches.items() if w == "second")


def test_kept_reviews_take_only_new_files(spark, scratch):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    folder = os.path.join(scratch, "documents.parquet")
    docs.where("doc_id < 100").coalesce(1).write.parquet(folder)
    assert ST.kept_reviews(spark, scratch).read(spark).count() == docs.where("doc_id < 100").count()
    docs.where("doc_id >= 100").coalesce(1).write.mode("append").parquet(folder)
    table = ST.kept_reviews(spark, scratch)
    assert table.read(spark).count() == docs.count()
    assert sorted(r["n_rows"] for r in table.batches(spark).collect()) == sorted(
        [docs.where("doc_id < 100").count(), docs.where("doc_id >= 100").count()])
