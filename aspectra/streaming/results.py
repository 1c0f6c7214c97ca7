"""Results of a stream as a table of files, stored once whatever is replayed.

A batch is stored in three steps, each by the executors and each repeatable: its rows overwrite
the partition (writer, batch_id) of ``rows``; the source offsets that those rows hold overwrite the same
partition of ``spans`` as runs (first, last); a record of the batch (rows, nulls per column) overwrites
it in ``batches`` and commits it. Only committed batches are read, so a batch that was stopped half-way is
invisible until its replay has overwritten it (or, where nothing of it is left to store, for good).
One writer at a time; a table may have any number of them one after the other.

A row whose offset lies in a committed run of another batch is not stored again. So a topic read again
from its start under a new checkpoint adds nothing, without a join to the rows already stored: there are
few runs per topic partition, as consecutive offsets merge.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .sinks import SOURCE_KEY, BatchFn

log = logging.getLogger(__name__)

SPANS_DDL = "src_topic STRING, src_partition INT, first BIGINT, last BIGINT, writer STRING, batch_id BIGINT"
BATCHES_DDL = "n_rows BIGINT, nulls MAP<STRING, BIGINT>, writer STRING, batch_id BIGINT"
PARTITIONS = ["writer", "batch_id"]
#: Runs are found within stretches of this many offsets, so no task sorts a whole topic partition.
STRETCH_BITS = 20
#: Runs that are broadcast to the rows of a batch; more are joined by shuffle.
HELD_SPANS = 100_000


def overwrite_partitions(df: DataFrame, path: str, partitions: list[str]) -> None:
    """Replace only the partitions that occur in ``df``."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def observed(seen: Observation) -> dict:
    """The metrics of a finished action; empty where the planner found that there are no rows at all
    and so never ran the observed step."""
    from py4j.protocol import Py4JJavaError

    try:
        return dict(seen.get)
    except Py4JJavaError as e:
        if "assertion failed" not in str(e):
            raise
        return {}


def offset_runs(rows: DataFrame) -> DataFrame:
    """Runs (first, last) of consecutive offsets per topic partition; equal offsets count once."""
    stretch = F.shiftright("src_offset", STRETCH_BITS)
    place = F.dense_rank().over(Window.partitionBy("src_topic", "src_partition", "_s").orderBy("src_offset"))
    runs = rows.where(F.col("src_offset").isNotNull()).withColumn("_s", stretch).withColumn("_run", F.col("src_offset") - place)
    return runs.groupBy("src_topic", "src_partition", "_s", "_run").agg(
        F.min("src_offset").alias("first"), F.max("src_offset").alias("last")).drop("_s", "_run")


def merged_runs(spans: DataFrame) -> DataFrame:
    """One row per topic partition: its runs, joined where they touch, as a sorted array."""
    key = Window.partitionBy("src_topic", "src_partition").orderBy("first", "last")
    before = F.max("last").over(key.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.when(F.col("first") <= before + 1, 0).otherwise(1)
    joined = spans.withColumn("_new", starts).withColumn("_run", F.sum("_new").over(key.rowsBetween(Window.unboundedPreceding, 0)))
    return (joined.groupBy("src_topic", "src_partition", "_run").agg(F.min("first").alias("first"), F.max("last").alias("last"))
            .groupBy("src_topic", "src_partition").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("runs")))


class ResultTable:
    """``schema``: the stored columns, ``SOURCE_KEY`` (see ``with_source_key``) among them."""

    def __init__(self, path: str, schema: StructType):
        missing = set(SOURCE_KEY) - set(schema.names)
        if missing or set(PARTITIONS) & set(schema.names):
            raise ValueError(f"schema must hold {SOURCE_KEY} and neither of {PARTITIONS}: {schema.names}")
        self.path, self.schema = path, schema
        self.stored = StructType(list(schema.fields)).add("writer", "string").add("batch_id", "long")

    def create(self, spark: SparkSession) -> ResultTable:
        """Make the empty table; what is there already stays."""
        for part, schema in (("rows", self.stored), ("spans", SPANS_DDL), ("batches", BATCHES_DDL)):
            spark.createDataFrame([], schema).write.mode("append").partitionBy(*PARTITIONS).parquet(f"{self.path}/{part}")
        return self

    def _part(self, spark: SparkSession, part: str, schema) -> DataFrame:
        return spark.read.schema(schema).parquet(f"{self.path}/{part}")

    def batches(self, spark: SparkSession) -> DataFrame:
        """n_rows, nulls (per column), writer, batch_id of every committed batch."""
        return self._part(spark, "batches", BATCHES_DDL)

    def spans(self, spark: SparkSession) -> DataFrame:
        """Offset runs of the committed batches."""
        return self._part(spark, "spans", SPANS_DDL).join(self._filled(spark), PARTITIONS, "left_semi")

    def _filled(self, spark: SparkSession) -> DataFrame:
        return self.batches(spark).where("n_rows > 0").select(*PARTITIONS)

    def read(self, spark: SparkSession) -> DataFrame:
        """The rows of the committed batches."""
        return self._part(spark, "rows", self.stored).join(self._filled(spark), PARTITIONS, "left_semi")

    def _unstored(self, rows: DataFrame, writer: str, batch_id: int) -> DataFrame:
        """Rows whose offset no other committed batch holds."""
        spark = rows.sparkSession
        others = self.spans(spark).where(~((F.col("writer") == writer) & (F.col("batch_id") == batch_id)))
        runs = merged_runs(others).select(F.col("src_topic").alias("_t"), F.col("src_partition").alias("_p"), "runs")
        held = runs.agg(F.sum(F.size("runs")).alias("n")).first()["n"] or 0
        if not held:
            return rows
        side = F.broadcast(runs) if held <= HELD_SPANS else runs
        inside = F.exists("runs", lambda r: F.col("src_offset").between(r["first"], r["last"]))
        known = rows.join(side, (F.col("src_topic") == F.col("_t")) & (F.col("src_partition") == F.col("_p")), "left")
        return known.where(~F.coalesce(inside, F.lit(False))).drop("_t", "_p", "runs")

    def sink(self, writer: str, transform: Callable[[DataFrame], DataFrame] | None = None) -> BatchFn:
        """``foreachBatch`` writer of rows with the columns ``SOURCE_KEY``. ``writer`` names the checkpoint that the batch
        ids belong to: the same name after a restart from it, another one for another checkpoint.
        ``transform`` makes the stored columns; only rows that are not stored yet go through it."""
        mark = [F.lit(writer).alias("writer")]

        def write(batch_df: DataFrame, batch_id: int) -> None:
            spark = batch_df.sparkSession
            mark_batch = [*mark, F.lit(batch_id).cast("bigint").alias("batch_id")]
            fresh = self._unstored(batch_df, writer, batch_id)
            fresh = (transform(fresh) if transform else fresh).select(*self.schema.names)
            seen = Observation()  # counts come with the write: one pass over the batch
            nulls = [F.count_if(F.col(c).isNull()).alias(c) for c in self.schema.names]
            out = fresh.observe(seen, F.count(F.lit(1)).alias("_n"), *nulls).select("*", *mark_batch)
            overwrite_partitions(out, f"{self.path}/rows", PARTITIONS)
            found = observed(seen)
            n = found.pop("_n", 0)
            if n:
                mine = self._part(spark, "rows", self.stored).where(
                    (F.col("writer") == writer) & (F.col("batch_id") == batch_id)).select(*SOURCE_KEY)
                overwrite_partitions(offset_runs(mine).select("*", *mark_batch), f"{self.path}/spans", PARTITIONS)
            record = spark.range(1).select(
                F.lit(n).cast("bigint").alias("n_rows"),
                F.create_map(*[v for c in self.schema.names for v in (F.lit(c), F.lit(found.get(c, 0)).cast("bigint"))]).alias("nulls"),
                *mark_batch)
            overwrite_partitions(record, f"{self.path}/batches", PARTITIONS)
            log.info("%s batch %s: %s rows, nulls %s", writer, batch_id, n, {c: v for c, v in found.items() if v})

        return write


def null_totals(batches: DataFrame, columns: list[str]) -> list[Column]:
    """Aggregates over ``ResultTable.batches``: nulls stored per column."""
    return [F.coalesce(F.sum(F.col("nulls")[F.lit(c)]), F.lit(0)).cast("bigint").alias(f"null_{c}") for c in columns]
