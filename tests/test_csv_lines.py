"""One line a row: odd texts survive, broken lines go to the dead letters, one file is read by many tasks."""
import os

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aspectra.sources import files as FS

ODD = ["", " lead and trail ", 'quote "x" ""', "a,b", "line\nline\r\nline\r", "back\\slash \\n \\\\n \\r \\", "\\N", None, "#c", "é一🙂", '"', "\\\\", "\\\n",
       "\x00\x01", "a\u2028b\u0085c"]


def round_trip(spark, texts, path):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    df.select(FS.csv_lines(df)).write.text(path)
    rows, dead = FS.read_csv_lines(spark, path, "id BIGINT, text STRING")
    assert dead.count() == 0
    return [r["text"] for r in rows.orderBy("id").collect()]


def test_odd_texts_survive(spark, scratch):
    assert round_trip(spark, ODD, os.path.join(scratch, "odd")) == ODD


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.text(alphabet=st.sampled_from('\\nr"\n\r,N a'), max_size=12), min_size=1, max_size=60))
def test_any_text_survives(spark, tmp_path_factory, texts):
    assert round_trip(spark, texts, os.path.join(str(tmp_path_factory.mktemp("csv")), "t")) == texts


def test_broken_lines_go_whole(spark, scratch):
    lines = ["1,fine,2.5", "x,no number,1", "2,too few", "3,too,many,4", '4,"open quote,1', "5,,", "", "6,\\N,7"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(scratch + "/b")
    rows, dead = FS.read_csv_lines(spark, scratch + "/b", "id BIGINT, name STRING, v DOUBLE")
    assert sorted((r["id"], r["name"], r["v"]) for r in rows.collect() if r["id"] != 6) == [(1, "fine", 2.5), (5, "", None)] or \
        sorted((r["id"], r["name"], r["v"]) for r in rows.collect() if r["id"] != 6) == [(1, "fine", 2.5), (5, None, None)]
    assert [(r["id"], r["name"], r["v"]) for r in rows.where("id = 6").collect()] == [(6, None, 7.0)]
    assert {r["payload"] for r in dead.collect()} >= {"x,no number,1", "2,too few", "3,too,many,4"}
    assert all(r["payload_bytes"] == len(r["payload"].encode()) and r["reason"] == "malformed_row" for r in dead.collect())
    assert dead.select("reason").count() == dead.count() and rows.select("name").count() + dead.count() == len([x for x in lines if x])


def test_one_file_many_tasks(spark, scratch):
    df = spark.range(4000).select("id", F.concat(F.lit("text\n"), F.repeat(F.lit("x"), 100)).alias("text"))
    df.select(FS.csv_lines(df)).coalesce(1).write.text(scratch + "/one")
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    spark.conf.set("spark.sql.files.openCostInBytes", "1024")
    try:
        rows, dead = FS.read_csv_lines(spark, scratch + "/one", "id BIGINT, text STRING")
        assert rows.rdd.getNumPartitions() > 4
        assert rows.where("text like 'text\nx%'").count() == 4000 and dead.count() == 0
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
