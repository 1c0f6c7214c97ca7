"""The topic envelope: one schema for every message source.

Live sources are Kafka topics (batch ``spark.read`` or ``spark.readStream``).
Offline, a table becomes a topic by encoding each row as one JSON value with
a (partition, offset) position; stored envelope files replay as a stream.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ASPECTS, ENVELOPE_DDL
from ..functions.arrays import nullable_label
from ..functions.json import encode_json

ENVELOPE_COLUMNS = ["key", "value", "topic", "partition", "offset", "timestamp"]


def to_envelope(
    df: DataFrame,
    value: Column,
    topic: str,
    position: Column,
    key: Column | None = None,
    timestamp: Column | None = None,
    partitions: int = 1,
) -> DataFrame:
    """Rows -> envelope. ``position`` is a dense unique id, spread over ``partitions``
    so each topic partition gets its own dense offset sequence."""
    pos = position.cast("bigint")
    ts = timestamp.cast("timestamp") if timestamp is not None else F.lit(None).cast("timestamp")
    return df.select(
        (key.cast("binary") if key is not None else F.lit(None).cast("binary")).alias("key"),
        value.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.pmod(pos, F.lit(partitions)).cast("int").alias("partition"),
        F.floor(pos / F.lit(partitions)).cast("bigint").alias("offset"),
        ts.alias("timestamp"),
    )


def number_messages(events: DataFrame, topic: str = "numbers", partitions: int = 1) -> DataFrame:
    """``{"number": n}`` per event, written the way a Python ``json.dumps`` producer
    writes it (``": "`` separator), so a character position maps to the same digit."""
    value = F.format_string('{"number": %d}', F.col("event_id"))
    return to_envelope(events, value, topic, F.col("event_id"), timestamp=F.col("ts"), partitions=partitions)


def review_messages(documents: DataFrame, topic: str = "reviews") -> DataFrame:
    """``{"id": doc_id, "review": text}`` per document; offset = doc_id."""
    value = encode_json(F.col("doc_id").alias("id"), F.col("text").alias("review"))
    return to_envelope(documents, value, topic, F.col("doc_id"))


def labelled_messages(documents: DataFrame, labels: DataFrame, topic: str = "labelled-reviews") -> DataFrame:
    """``{"review_text": ..., <8 aspects>: int|null}``; documents without text are skipped.

    The truth labels cover two aspects: ``Quality`` <- ``quality`` and
    ``General`` <- ``1 - toxic`` (non-toxic reads as a positive review). The other
    aspects are sent as explicit nulls.
    """
    truth = {
        "Quality": F.col("quality"),
        "General": (F.lit(1) - F.col("toxic")),
    }
    joined = documents.filter(F.col("text").isNotNull()).join(labels, "doc_id", "left")
    fields = [F.col("text").alias("review_text")] + [
        nullable_label(truth[a]).alias(a) if a in truth else F.lit(None).cast("int").alias(a) for a in ASPECTS
    ]
    return to_envelope(joined, encode_json(*fields, keep_nulls=True), topic, F.col("doc_id"))


def payload_messages(pages: DataFrame, topic: str = "pages") -> DataFrame:
    """Raw bytes payloads (no JSON): page html as the value, url as the key."""
    return to_envelope(pages, F.col("html").cast("binary"), topic, F.col("page_id"), key=F.col("url"))


def constant_messages(df: DataFrame, payload: bytes, topic: str = "items", position: str | None = None) -> DataFrame:
    """The same raw payload once per input row (a hello-world producer)."""
    pos = F.col(position) if position else F.monotonically_increasing_id()
    return to_envelope(df, F.lit(bytearray(payload)), topic, pos)


def number_stream(spark: SparkSession, rows_per_second: int = 2, topic: str = "numbers") -> DataFrame:
    """Unbounded increasing numbers (the rate source), as ``{"number": n}`` messages."""
    rate = spark.readStream.format("rate").option("rowsPerSecond", str(rows_per_second)).load()
    value = F.format_string('{"number": %d}', F.col("value"))
    return to_envelope(rate, value, topic, F.col("value"), timestamp=F.col("timestamp"))


def number_sequence(spark: SparkSession, n: int, topic: str = "numbers") -> DataFrame:
    """Bounded numbers 0..n-1 as ``{"number": n}`` messages."""
    return number_messages(spark.range(n).select(F.col("id").alias("event_id"), F.current_timestamp().alias("ts")), topic)


# ---------------------------------------------------------------- readers

def kafka_options(servers: str, topic: str, starting: str = "earliest", **extra: str) -> dict[str, str]:
    opts = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def read_topic(spark: SparkSession, servers: str, topic: str, **extra: str) -> DataFrame:
    """Batch scan of a topic from the earliest offset to the end (needs the Kafka connector)."""
    return spark.read.format("kafka").options(**kafka_options(servers, topic, "earliest", **extra)).load()


def stream_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "earliest",
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
    **extra: str,
) -> DataFrame:
    """Unbounded topic scan; the query's checkpoint replaces consumer-group commits.
    ``min_partitions`` splits large topic partitions into more Spark tasks, so a
    one-partition topic does not make scoring a one-task stage."""
    opts = kafka_options(servers, topic, starting, **extra)
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    return spark.readStream.format("kafka").options(**opts).load()


#: Row groups of a stored topic: tasks read whole ones, so a batch of few files still keeps many tasks busy. They are well
#: below the least split of a scan (4 MB), so that splits have work in proportion to their bytes. The writer guesses after how
#: many rows to look at their size again, up to 10,000 by default, which may be a whole file of texts.
TOPIC_FILES = {"parquet.block.size": 1 << 20, "parquet.page.size.row.check.max": 100}


def write_envelope_files(env: DataFrame, path: str) -> str:
    """Persist envelope rows as parquet so a file stream can replay them."""
    env.select(*ENVELOPE_COLUMNS).write.mode("overwrite").options(**TOPIC_FILES).parquet(path)
    return path


def stream_envelope_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                          max_bytes_per_trigger: int | None = None) -> DataFrame:
    """Offline stand-in for a topic stream: envelope parquet files under ``path`` and its folders, oldest first.
    A limit on files or bytes (one of them) cuts a backlog into batches."""
    reader = spark.readStream.schema(ENVELOPE_DDL).format("parquet").option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    return reader.load(path)


def write_in_turn(env: DataFrame, path: str, turn: Column, turns: range, files: int = 4) -> str:
    """Write the envelope as it arrives: the rows of each of ``turns`` after those of the one before, each as ``files`` files (as
    far as it has rows), so that a stream limited to ``files`` a batch reads one turn a batch. ``env`` is computed once: its rows
    are first dealt into a folder per turn beside ``path``."""
    numbered = env.select(*ENVELOPE_COLUMNS, turn.cast("int").alias("_turn"))
    if len(turns) > 1:
        dealt = f"{path.rstrip('/')}-dealt-{uuid.uuid4().hex}"
        numbered.write.partitionBy("_turn").parquet(dealt)
        numbered = env.sparkSession.read.schema(f"{ENVELOPE_DDL}, _turn INT").parquet(dealt)
    for i in turns:
        own = numbered.where(F.col("_turn") == i).select(*ENVELOPE_COLUMNS)
        own.repartition(files).write.options(**TOPIC_FILES).parquet(f"{path}/turn{i:04d}")
    return path
