"""Sinks (K1-K12): relational table, documents, lake files, topics, memory, console.

Restart safety: every ``foreachBatch`` sink here is idempotent per batch id,
because Spark re-offers the last uncommitted batch after a failure.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..functions.json import encode_json

log = logging.getLogger(__name__)

BatchFn = Callable[[DataFrame, int], None]
SOURCE_KEY = ["src_topic", "src_partition", "src_offset"]


def with_source_key(df: DataFrame) -> DataFrame:
    """Envelope position under names that are not reserved words in SQL databases."""
    return df.withColumnRenamed("topic", "src_topic").withColumnRenamed("partition", "src_partition") \
        .withColumnRenamed("offset", "src_offset")


# ---------------------------------------------------------------- relational (K1)

def jdbc_reader(spark: SparkSession, url: str, table: str, props: dict[str, str] | None = None,
                predicates: list[str] | None = None) -> DataFrame:
    props = dict(props or {})
    if predicates:
        return spark.read.jdbc(url, table, predicates=predicates, properties=props)
    return spark.read.jdbc(url, table, properties=props)


def jdbc_batch_sink(url: str, table: str, columns: list[str], props: dict[str, str] | None = None,
                    rename: dict[str, str] | None = None, preview_rows: int = 5,
                    column_types: str | None = None) -> BatchFn:
    """``foreachBatch`` writer: append the batch to ``table`` exactly once.

    The batch is persisted for its several actions and always unpersisted. Rows
    of this batch id already in the table (a replay after a half-written or
    uncommitted batch) are removed by a left-anti join on the source position;
    the ``batch_id = n`` filter is pushed down to the database. Write errors are
    raised, so Spark does not commit the batch and offers it again.
    """
    props = dict(props or {})
    rename = dict(rename or {})
    write_props = dict(props, **({"createTableColumnTypes": column_types} if column_types else {}))

    def write(batch_df: DataFrame, batch_id: int) -> None:
        batch_df.persist()
        try:
            n = batch_df.count()
            if n == 0:
                log.info("batch %s: no new rows", batch_id)
                return
            shown = [rename.get(c, c) for c in columns]
            out = batch_df.select(*[F.col(c).alias(rename.get(c, c)) for c in columns], *SOURCE_KEY,
                                  F.lit(batch_id).cast("bigint").alias("batch_id"))
            preview = out.orderBy(*SOURCE_KEY).limit(preview_rows).select(encode_json(*shown).alias("j")).collect()
            log.info("batch %s: %s rows, first %s: %s", batch_id, n, len(preview), json.dumps([r.j for r in preview]))
            spark = batch_df.sparkSession
            try:
                stored = jdbc_reader(spark, url, table, props).filter(F.col("batch_id") == batch_id).select(*SOURCE_KEY)
                out = out.join(stored, SOURCE_KEY, "left_anti")
            except Exception as e:  # table not created yet: nothing stored  # noqa: BLE001
                if not any(table.lower() in line and "does not exist" in line for line in str(e).lower().split("\n")):
                    raise
            out.write.jdbc(url, table, mode="append", properties=write_props)
        finally:
            batch_df.unpersist()

    return write


# ---------------------------------------------------------------- documents (K8)

def document_batch_sink(path: str) -> BatchFn:
    """One JSON document per message, written per batch id with overwrite, so a
    replayed batch replaces its own output instead of duplicating it."""

    def write(batch_df: DataFrame, batch_id: int) -> None:
        batch_df.write.mode("overwrite").json(f"{path}/batch_id={batch_id}")

    return write


def read_documents(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read
    if schema:
        reader = reader.schema(schema)
    return reader.json(path)


# ---------------------------------------------------------------- lake files

def lake_writer(df: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None) -> DataStreamWriter:
    """Exactly-once parquet sink (Spark's file sink keeps a commit log)."""
    w = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    return w


# ---------------------------------------------------------------- topics (K4-K7)

def topic_frame(df: DataFrame, value_cols: list[str], key_col: str | None = None) -> DataFrame:
    """Rows -> (key, value) JSON records ready for the Kafka sink."""
    cols = [encode_json(*value_cols).alias("value")]
    if key_col:
        cols.insert(0, F.col(key_col).cast("string").alias("key"))
    return df.select(*cols)


def kafka_batch_write(records: DataFrame, options: dict[str, str]) -> None:
    """Publish (key?, value) records with the Kafka sink (needs the connector)."""
    records.write.format("kafka").options(**options).save()


def kafka_stream_writer(records: DataFrame, options: dict[str, str], checkpoint: str) -> DataStreamWriter:
    """Streaming publish; the checkpoint records which offsets were produced."""
    return records.writeStream.format("kafka").options(**options).option("checkpointLocation", checkpoint)


# --- fixed values: settings of the durable and of the plain producer ---
DURABLE_PRODUCER = {
    "kafka.enable.idempotence": "true",
    "kafka.compression.type": "lz4",
    "kafka.batch.size": "64000",
    "kafka.linger.ms": "10",
    "kafka.acks": "all",
    "kafka.retries": "5",
    "kafka.request.timeout.ms": "990",
    "kafka.delivery.timeout.ms": "1000",
}
PLAIN_PRODUCER = {"kafka.acks": "all", "kafka.linger.ms": "10", "kafka.retries": "3"}
# --- end of fixed values ---


def producer_options(servers: str, topic: str, durable: bool = True) -> dict[str, str]:
    """Kafka sink options. ``durable`` mirrors the idempotent producer settings
    (acks=all, lz4, 64 KB batches, 10 ms linger, 5 retries, 1 s delivery timeout);
    the Java client requires delivery timeout >= linger + request timeout, so the
    request timeout is set to fit. Spark's Kafka sink is at-least-once."""
    return {"kafka.bootstrap.servers": servers, "topic": topic, **(DURABLE_PRODUCER if durable else PLAIN_PRODUCER)}


def consumer_options(servers: str, topic: str, starting: str = "earliest", committed_only: bool = False,
                     max_offsets_per_trigger: int | None = None, min_partitions: int | None = None) -> dict[str, str]:
    """Kafka source options; the query checkpoint replaces group commits, and
    ``startingOffsets`` plays the role of the reset policy (smallest = earliest)."""
    starting = {"smallest": "earliest", "largest": "latest"}.get(starting, starting)
    opts = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    if committed_only:
        opts["kafka.isolation.level"] = "read_committed"
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    return opts


# ---------------------------------------------------------------- memory / console

def memory_writer(df: DataFrame, name: str) -> DataStreamWriter:
    """Memory sink: rows are kept on the driver — for tests and small demos only."""
    return df.writeStream.format("memory").queryName(name).outputMode("append")


def snapshot(spark: SparkSession, name: str) -> DataFrame:
    """Current contents of a named memory-sink table (re-run for a live view)."""
    return spark.sql(f"SELECT * FROM {name}")


def console_writer(df: DataFrame, truncate: bool = False, with_arrival: bool = False) -> DataStreamWriter:
    if with_arrival:
        df = df.withColumn("arrived_at", F.current_timestamp())
    return df.writeStream.format("console").option("truncate", str(truncate).lower()).outputMode("append")
