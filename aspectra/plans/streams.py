"""Registered queries that run as Structured Streaming jobs.

Each one stores its input topic as envelope files in the shared folder,
drains it with the available-now trigger into a restart-safe sink, and
returns the sink's contents as a batch DataFrame.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import ASPECTS, RESULT_TABLE
from ..functions.json import LABELLED_DDL, REVIEW_DDL, parse_envelope, split_dead_letter
from ..operators.metrics import confusion_counts
from ..operators.scoring import LexiconScorer, widen
from ..session import fresh_path, spread
from ..sources.envelope import review_messages, stream_envelope_files, write_envelope_files
from ..streaming import runner
from ..streaming.live import deltas_sink, signed_changes
from ..streaming.results import ResultTable, overwrite_partitions
from ..streaming.sinks import (SOURCE_KEY, document_batch_sink, jdbc_batch_sink, jdbc_reader, lake_writer, read_documents,
                               with_source_key)
from ..streaming.windows import latest_windows, windows_query
from .reviews import with_predictions


def topic_files(spark: SparkSession, env: DataFrame, name: str) -> str:
    return write_envelope_files(env, fresh_path(spark, name, "topic"))


def drain_to_lake(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    out, ckpt = fresh_path(spark, name, "out"), fresh_path(spark, name, "checkpoint")
    runner.run_available(lake_writer(stream, out, ckpt).queryName(f"{name}_{uuid.uuid4().hex[:8]}"))
    return spark.read.parquet(out)


def score_stream(stream_env: DataFrame, scorer=None) -> DataFrame:
    """Stateless scoring: parse -> drop dead letters -> score -> one column per aspect."""
    good, _ = split_dead_letter(parse_envelope(stream_env, REVIEW_DDL))
    return widen((scorer or LexiconScorer()).score(good, "review"))


def cnn_artefacts(spark: SparkSession, docs: DataFrame, seed: int = 42):
    """A CNN scorer with seeded weights; its vocabulary, all tokens of ``docs``, is
    stored in the shared folder."""
    from ..functions.text import build_vocabulary
    from ..operators.scoring import WholeVocabularyCnn

    return WholeVocabularyCnn(spark, build_vocabulary(docs, "text"), seed=seed)


def derby_url(spark: SparkSession, name: str) -> str:
    """Embedded Derby database in the driver JVM (no server, no port). It is
    visible to this JVM only: local-mode runs and tests. A cluster points the
    same sink at a database server URL instead."""
    return f"jdbc:derby:memory:{name}_{uuid.uuid4().hex[:8]};create=true"


DERBY_PROPS = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
RESULT_COLUMNS = ["review", *ASPECTS]
RESULT_RENAME = {"review": "ReviewText"}
# Only the topic, which is never null, is a VARCHAR: Spark binds a null string as CLOB (its default type for
# strings in Derby), which Derby refuses for a VARCHAR, and a review without text has no aspects.
RESULT_TYPES = "src_topic VARCHAR(256)"


def jdbc_stream(spark: SparkSession, env: DataFrame, name: str, replay_batches: bool, scorer=None) -> DataFrame:
    """Stream scored reviews into a relational table, then read the table back.
    With ``replay_batches`` every batch is written twice, as after a crash
    between the write and the commit; the idempotent sink must store it once."""
    path = topic_files(spark, env, name)
    url = derby_url(spark, name)
    sink = jdbc_batch_sink(url, RESULT_TABLE, RESULT_COLUMNS, DERBY_PROPS, rename=RESULT_RENAME,
                           column_types=RESULT_TYPES)

    def batch(df, batch_id):
        df = with_source_key(score_stream(df, scorer))  # per batch: a large vocabulary is joined by shuffle
        sink(df, batch_id)
        if replay_batches:
            sink(df, batch_id)

    runner.run_available(runner.foreach_batch(stream_envelope_files(spark, path), batch, fresh_path(spark, name, "checkpoint"),
                                              trigger="available", name=f"{name}_{uuid.uuid4().hex[:8]}"))
    # Read the table back, keep the copy in the shared folder, and drop the
    # in-memory database so repeated runs do not hold every copy in the JVM.
    copy = fresh_path(spark, name, "table_copy")
    jdbc_reader(spark, url, RESULT_TABLE, DERBY_PROPS).write.parquet(copy)
    drop_derby(spark, url)
    return spark.read.parquet(copy)


def drop_derby(spark: SparkSession, url: str) -> None:
    """Release an in-memory Derby database (Derby signals success with an error)."""
    target = url.split(";")[0] + ";drop=true"
    try:
        spark.sparkContext._jvm.java.sql.DriverManager.getConnection(target)
    except Exception:  # noqa: BLE001 - "Database ... dropped" is raised on success
        pass


def document_stream(spark: SparkSession, env: DataFrame, name: str, ddl: str) -> DataFrame:
    """Topic -> one JSON document per message (parsed payload + position) -> read back."""
    path = topic_files(spark, env, name)
    good, _ = split_dead_letter(parse_envelope(stream_envelope_files(spark, path), ddl))
    out = fresh_path(spark, name, "documents")
    runner.run_available(runner.foreach_batch(good.drop("timestamp"), document_batch_sink(out),
                                              fresh_path(spark, name, "checkpoint"), trigger="available"))
    return read_documents(spark, out)


def two_queries(spark: SparkSession, env: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Two queries over one source, each with its own checkpoint, running at once."""
    path = topic_files(spark, env, name)
    src = stream_envelope_files(spark, path)
    numbers = src.select("topic", "offset", F.col("value").cast("string").substr(12, 1).alias("rand_number"))
    parity = numbers.withColumn("Is_Even", F.expr("try_cast(rand_number AS INT)") % 2 == 0)
    outs = [fresh_path(spark, name, label) for label in ("numbers", "parity")]
    runner.run_all([runner.with_trigger(lake_writer(df, out, fresh_path(spark, name, "checkpoint")), "available")
                    for df, out in zip((numbers, parity), outs, strict=True)])
    return spark.read.parquet(outs[0]), spark.read.parquet(outs[1])


def table_stream(spark: SparkSession, sf_dir: str, name: str, max_files_per_trigger: int | None = None,
                 max_bytes_per_trigger: int | None = None) -> DataFrame:
    """A driver table, one file or a folder of files, read as a file stream."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    known = spark.read.parquet(path)
    reader = spark.readStream.schema(known.schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    if any(f.endswith(f"/{name}.parquet") for f in known.inputFiles()):  # one file: its folder and a name filter
        return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)
    return reader.parquet(path)


def topic_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files under ``path``."""
    files = spark.read.option("recursiveFileLookup", "true").parquet(path).select("_metadata.file_path", "_metadata.file_size").distinct()
    return files.agg(F.sum("file_size").alias("n")).first()["n"] or 0


#: A drain takes a backlog in at least DRAIN_BATCHES batches of at most DRAIN_BYTES.
DRAIN_BATCHES, DRAIN_BYTES = 4, 256 << 20
STORED_REVIEW = ["id", "review", *ASPECTS]


def results_table(path: str) -> ResultTable:
    """The table that dashboards read: scored reviews with their source position."""
    fields = [T.StructField(c, T.StringType()) for c in STORED_REVIEW]
    return ResultTable(path, T.StructType([*fields, T.StructField("src_topic", T.StringType()),
                                           T.StructField("src_partition", T.IntegerType()), T.StructField("src_offset", T.LongType())]))


def scored_batch(scorer=None):
    """Batch of envelope rows under ``SOURCE_KEY`` names -> scored reviews."""
    def transform(batch_df: DataFrame) -> DataFrame:
        good, _ = split_dead_letter(parse_envelope(batch_df, REVIEW_DDL, keep=tuple(SOURCE_KEY)))
        return widen((scorer or LexiconScorer()).score(good, "review"))

    return transform


class Stopped(RuntimeError):
    """Raised by a recovery drill in place of a crash."""


def recovery_drill(spark: SparkSession, env: DataFrame, name: str) -> ResultTable:
    """Topic -> scores -> results table over several batches, with what goes wrong in practice: the consumer dies
    between the write and the commit of its second batch and is started again from its checkpoint;
    later another consumer reads the topic from the start under a checkpoint of its own."""
    topic = topic_files(spark, env, name)
    table = results_table(fresh_path(spark, name, "results")).create(spark)
    limit = max(1, min(DRAIN_BYTES, topic_bytes(spark, topic) // DRAIN_BATCHES))
    dies_in = {1}

    def run(writer: str, checkpoint: str):
        sink = table.sink(writer, scored_batch())

        def batch(df: DataFrame, batch_id: int) -> None:
            sink(df, batch_id)
            if batch_id in dies_in:
                dies_in.discard(batch_id)
                raise Stopped(f"after the write of batch {batch_id}")

        src = with_source_key(stream_envelope_files(spark, topic, max_bytes_per_trigger=limit))
        return runner.foreach_batch(src, batch, checkpoint, "available").start()

    for writer in ("first", "second"):
        checkpoint = fresh_path(spark, name, "checkpoint")
        runner.retrying(lambda w=writer, c=checkpoint: run(w, c), attempts=2)
    return table


_KEPT: dict[tuple[str, str], str] = {}


def kept_reviews(spark: SparkSession, sf_dir: str) -> ResultTable:
    """The results table of the documents as a review topic, kept up to date: the first call of an application
    scores all documents, later ones only files that have come since."""
    path = _KEPT.setdefault((spark.sparkContext.applicationId, sf_dir), fresh_path(spark, "kept_reviews"))
    table = results_table(f"{path}/results").create(spark)
    src = with_source_key(review_messages(table_stream(spark, sf_dir, "documents", max_bytes_per_trigger=DRAIN_BYTES)))
    spreading = scored_batch()
    runner.run_available(runner.foreach_batch(src, table.sink("reviews", lambda df: spreading(spread(df))), f"{path}/checkpoint"))
    return table


def changed_windows(spark: SparkSession, stream: DataFrame, name: str, width: str, delay: str, keys: list[str],
                    value: str | None = None) -> DataFrame:
    """Drain a windowed count in update mode (event time ``ts``); the latest version of every window."""
    out = fresh_path(spark, name, "windows")
    runner.run_available(windows_query(stream, out, fresh_path(spark, name, "checkpoint"), "ts", width, delay, keys, value))
    return latest_windows(spark.read.parquet(out), keys)


def confusion_stream(spark: SparkSession, env: DataFrame, name: str, pairs: list[tuple[str, str, str]], scorer=None) -> DataFrame:
    """Labelled topic -> predictions -> confusion counts as streaming state in update mode (at most aspects x labels x
    predictions rows), over several batches. A batch stores the counts that it changed under its id; the
    latest of each cell is the current one."""
    topic = topic_files(spark, env, name)
    limit = max(1, min(DRAIN_BYTES, topic_bytes(spark, topic) // DRAIN_BATCHES))
    good, _ = split_dead_letter(parse_envelope(stream_envelope_files(spark, topic, max_bytes_per_trigger=limit), LABELLED_DDL))
    counts = confusion_counts(with_predictions(good, scorer), pairs)
    out = fresh_path(spark, name, "confusion")

    def write(changed: DataFrame, batch_id: int) -> None:
        overwrite_partitions(changed.withColumn("batch_id", F.lit(batch_id).cast("bigint")), out, ["batch_id"])

    runner.run_available(counts.writeStream.outputMode("update").foreachBatch(write)
                         .option("checkpointLocation", fresh_path(spark, name, "checkpoint")))
    schema = counts.schema.add("batch_id", "long")
    return spark.read.schema(schema).parquet(out).groupBy("Aspect", "label", "prediction").agg(F.max_by("n", "batch_id").alias("n"))


def live_view(spark: SparkSession, env: DataFrame, name: str, scorer=None) -> tuple[str, int]:
    """Review topic -> scores -> signed deltas of the latest review per id, over several batches. Gives the
    deltas' folder and the number of batches."""
    topic = topic_files(spark, env, name)
    limit = max(1, min(DRAIN_BYTES, topic_bytes(spark, topic) // DRAIN_BATCHES))
    scored = score_stream(stream_envelope_files(spark, topic, max_bytes_per_trigger=limit), scorer)
    out = fresh_path(spark, name, "deltas")
    changes = signed_changes(scored.where(F.col("review").isNotNull()), "id", "offset", ASPECTS)
    q = runner.run_available(runner.foreach_batch(changes, deltas_sink(out), fresh_path(spark, name, "checkpoint")))
    return out, q.lastProgress["batchId"] + 1
