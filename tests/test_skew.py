"""Split joins: equal to a plain left join, few heavy keys, scattered rows."""
from pyspark.sql import functions as F

from aspectra.operators.skew import heavy_keys, rows_of, split_join


def test_split_join_equals_left_join(spark):
    rows = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, None)
        .otherwise(F.concat(F.lit("k"), F.col("id") % 400)).alias("key"), F.lit(1).alias("_mark_x"))
    table = spark.createDataFrame([("hot", 1, "a"), *[(f"k{i}", i, None) for i in range(0, 400, 2)]], "key string, n int, s string")
    counts = rows.groupBy("key").agg(F.count(F.lit(1)).alias("c"))
    heavy = heavy_keys(counts, ["key"], "c", share=20)
    assert [r["key"] for r in heavy.collect()] == ["hot"]
    got = split_join(rows, table, ["key"], heavy, ["n", "s"], ["id"])
    assert got.columns == ["id", "key", "_mark_x", "n", "s"]
    want = rows.join(table, "key", "left").select(*got.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_heavy_rows_are_scattered(spark):
    rows = spark.range(8000).select("id", F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 997).alias("key"))
    table = spark.range(-1, 997).select(F.col("id").alias("key"), (F.col("id") * 2).alias("v"))
    heavy = heavy_keys(rows.groupBy("key").count(), ["key"], "count", share=100)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = split_join(rows, table, ["key"], heavy, ["v"], ["id"])
        sizes = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
        assert sum(sizes) == 8000 and max(sizes) < 2 * sum(sizes) / len(sizes) or len(sizes) == 1
        assert out.where("v != key * 2").count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_semi_join_of_few_and_of_many_keys(spark):
    rows = spark.range(100).select(F.when(F.col("id") > 0, F.col("id")).alias("k"), F.lit("wide").alias("v"))
    keys = spark.createDataFrame([(3,), (3,), (None,), (500,), (7,)], "k long")
    for held in (10, 1):
        out = rows_of(rows, keys, "k", held)
        assert sorted(r["k"] for r in out.collect()) == [3, 7] and out.columns == ["k", "v"]
