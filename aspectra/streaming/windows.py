"""Windows that end: streaming counts whose state is dropped behind the watermark, with late rows kept apart.

The aggregate runs in update mode: a batch gives the windows that it changed, and Spark's state store forgets a
window once the watermark has passed its end. Changed windows overwrite the partition (day,
batch_id) of a table of versions; a window's row is its latest version. Nothing is
ever written in complete mode.

A row whose window has already ended for the state store is dropped there. ``late_rows_sink`` finds the same rows in a
query of its own over the same topic and stores them: a row is late if its window's end is not after
the watermark of the batch before its own, that is the newest event time of the batches up
to the last but one, less the delay. (Spark judges late rows by the watermark that the previous batch ended
windows with, so a window is never dropped before its state is.)
Both queries must read with the same limits, so that they see the same batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.trend import stream_tumbling
from .results import observed, overwrite_partitions
from .sinks import BatchFn

VERSION = ["day", "batch_id"]


def versions_sink(path: str) -> BatchFn:
    """``foreachBatch`` writer of changed windows (column ``window_start``); a replayed batch replaces its own versions."""
    def write(batch_df: DataFrame, batch_id: int) -> None:
        overwrite_partitions(batch_df.withColumn("day", F.to_date("window_start"))
                             .withColumn("batch_id", F.lit(batch_id).cast("bigint")), path, VERSION)

    return write


def latest_windows(versions: DataFrame, keys: list[str]) -> DataFrame:
    """The latest version of every (window_start, keys)."""
    values = [c for c in versions.columns if c not in ("window_start", *keys, *VERSION)]
    latest = F.max_by(F.struct(*values), "batch_id").alias("_v")
    return versions.groupBy("window_start", *keys).agg(latest).select("window_start", *keys, *[F.col(f"_v.{c}").alias(c) for c in values])


def windows_query(stream: DataFrame, path: str, checkpoint: str, ts: str, width: str, delay: str, keys: list[str],
                  value: str | None = None):
    """Writer of the windowed counts of ``stream`` in update mode; start it with a trigger."""
    agg = stream_tumbling(stream, ts, width, delay, keys, value)
    return agg.writeStream.outputMode("update").foreachBatch(versions_sink(path)).option("checkpointLocation", checkpoint)


def late_rows_sink(path: str, ts: str, width: str, delay: str) -> BatchFn:
    """``foreachBatch`` writer: the rows of a batch whose window has ended go to ``path``/rows. The newest event time of each
    batch is kept under ``path``/marks, so a restart or a replay judges by the same watermark."""
    marks = f"{path}/marks"

    def write(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        number = F.lit(batch_id).cast("bigint").alias("batch_id")
        before = newest_before(spark, marks, batch_id - 1)
        top = F.max(ts).alias("newest")
        if before is None:  # no watermark yet, so no row is late
            newest = batch_df.agg(top).first()["newest"]
            overwrite_partitions(batch_df.limit(0).select("*", number), f"{path}/rows", ["batch_id"])
        else:
            late = F.window(F.col(ts), width)["end"] <= before - F.expr(f"INTERVAL {delay}")
            seen = Observation()  # the newest event time comes with the write: one pass over the batch
            overwrite_partitions(batch_df.observe(seen, top).where(late).select("*", number), f"{path}/rows", ["batch_id"])
            newest = observed(seen).get("newest")
        newest = F.lit(newest).cast("timestamp").alias("newest")
        overwrite_partitions(spark.range(1).select(newest, number), marks, ["batch_id"])

    return write


def newest_before(spark: SparkSession, marks: str, batch_id: int):
    """Newest event time of the batches before ``batch_id``, as a literal; None where there is none."""
    if batch_id <= 0:
        return None
    top = (spark.read.schema("newest TIMESTAMP, batch_id BIGINT").parquet(marks)
           .where(F.col("batch_id") < batch_id).agg(F.max("newest").alias("m")).first()["m"])
    return None if top is None else F.lit(top).cast("timestamp")


def read_late_rows(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The late rows with the batch they came in; empty where there are none."""
    return spark.read.schema(StructType(list(schema.fields)).add("batch_id", "long")).parquet(f"{path}/rows")
