"""Registered streams with state and several batches: windows that end, replay gaps, de-duplication,
recovery. Each stores its topic as envelope files in the order of arrival, so that a batch limit cuts it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ENVELOPE_DDL
from ..operators import series as SR
from ..session import fresh_path
from ..sources.envelope import number_messages, stream_envelope_files, to_envelope, write_envelope_files, write_in_turn
from ..streaming import runner
from ..streaming import windows as W
from ..streaming.sinks import lake_writer
from .catalog import table

#: Turns in which a topic arrives; each is one batch of a stream limited to FILES files.
TURNS = 10
FILES = 4
WIDTH, DELAY = "1 hour", "1 day"
#: Delay of the shuffled series: no point comes later than this behind a newer one.
SERIES_DELAY = "12 days"
EVENT_DDL = "event_id BIGINT, event_type STRING, value DOUBLE"



def lag_seconds(id_col: str) -> Column:
    """Seconds by which an event arrives after it happened, from a hash of its id: mostly hours, at most 10 days."""
    h = F.conv(F.substring(F.md5(F.col(id_col).cast("string").cast("binary")), 1, 2), 16, 10).cast("bigint")
    return F.floor(h * h * h * h / 5000).cast("bigint")


def arrival_turn(events: DataFrame, ts: str = "timestamp", position: str = "offset") -> Column:
    """The turn in which an envelope row arrives: equal spans of arrival time, which is event time plus lag."""
    arrival = F.unix_micros(ts) + lag_seconds(position) * 1_000_000
    ends = events.agg(F.min(arrival).alias("lo"), F.max(arrival).alias("hi")).first()
    lo, span = ends["lo"] or 0, (ends["hi"] or 0) - (ends["lo"] or 0) + 1
    return F.floor((arrival - lo) * TURNS / F.lit(span)).cast("int")


ARRIVALS_SQL = """
    a AS (SELECT *, epoch_us(ts) + lag * 1000000 AS arrival FROM (
        SELECT *, (h * h * h * h) // 5000 AS lag FROM (
            SELECT *, CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 2) AS BIGINT) AS h FROM events))),
    t AS (SELECT *, (arrival - (SELECT min(arrival) FROM a)) * 10 // ((SELECT max(arrival) - min(arrival) + 1 FROM a)) AS turn FROM a)"""


def event_messages(events: DataFrame, topic: str = "events") -> DataFrame:
    """Events as JSON messages; the envelope's timestamp is the event time, its offset the event id."""
    value = F.to_json(F.struct("event_id", "event_type", "value"))
    return to_envelope(events, value, topic, F.col("event_id"), timestamp=F.col("ts"))


def late_topic(spark: SparkSession, sf_dir: str, name: str) -> str:
    env = event_messages(table(spark, sf_dir, "events"))
    return write_in_turn(env, fresh_path(spark, name, "topic"), arrival_turn(env), range(TURNS), FILES)


def events_of(stream: DataFrame) -> DataFrame:
    e = F.from_json(F.col("value").cast("string"), EVENT_DDL).alias("e")
    return stream.select(e, F.col("timestamp").alias("ts")).select("ts", "e.event_type", "e.value", "e.event_id")


def windows_with_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly counts per event type from a topic whose rows arrive up to ten days late, over ``TURNS``
    batches, and per window how many rows came after its end. Two queries read the topic, one batch a turn."""
    name = "events_windows_late"
    path = late_topic(spark, sf_dir, name)
    counts, late = fresh_path(spark, name, "windows"), fresh_path(spark, name, "late")

    def source() -> DataFrame:
        return events_of(stream_envelope_files(spark, path, max_files_per_trigger=FILES))

    stream = source()
    started = [
        runner.with_trigger(W.windows_query(stream, counts, fresh_path(spark, name, "ck_windows"), "ts", WIDTH, DELAY,
                                            ["event_type"], "value"), "available"),
        runner.foreach_batch(source(), W.late_rows_sink(late, "ts", WIDTH, DELAY), fresh_path(spark, name, "ck_late"), "available"),
    ]
    runner.run_all(started)
    windows = W.latest_windows(spark.read.parquet(counts), ["event_type"])
    w = F.window("ts", WIDTH)
    after = (W.read_late_rows(spark, late, stream.schema).groupBy(w["start"].alias("window_start"), "event_type")
             .agg(F.count(F.lit(1)).alias("n_late")))
    both = windows.join(after, ["window_start", "event_type"], "full")
    return both.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type",
                       F.coalesce("n", F.lit(0)).cast("bigint").alias("n"), F.col("total"),
                       F.coalesce("n_late", F.lit(0)).cast("bigint").alias("n_late"))


WINDOWS_LATE_SQL = f"""
    WITH {ARRIVALS_SQL},
    newest AS (SELECT turn, max(ts) AS ts FROM t GROUP BY turn),
    marks AS (SELECT a.turn, max(b.ts) - INTERVAL 1 DAY AS mark FROM newest a LEFT JOIN newest b ON b.turn < a.turn - 1 GROUP BY a.turn),
    j AS (SELECT t.*, time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
                 coalesce(time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR <= mark, false) AS late FROM t JOIN marks USING (turn))
    SELECT window_start, event_type, count(*) FILTER (NOT late) AS n, round(sum(value) FILTER (NOT late), 6) AS total,
           count(*) FILTER (late) AS n_late
    FROM j GROUP BY 1, 2"""


def series_topic(spark: SparkSession, sf_dir: str, name: str) -> str:
    """The series topic in shuffled order of arrival, then a heartbeat without a point a month
    after the last, so that the watermark passes every point."""
    events = table(spark, sf_dir, "events")
    env = SR.series_messages(events, key="event_type", ts="ts", value="value", position="event_id")
    timed = env.withColumn("timestamp", SR.parse_timestamp(F.map_keys(F.from_json(F.col("value").cast("string"), "MAP<STRING, DOUBLE>"))[0]).cast("timestamp"))
    timed = spark.read.schema(ENVELOPE_DDL).parquet(write_envelope_files(timed, fresh_path(spark, name, "timed")))  # parsed once
    path = write_in_turn(timed, fresh_path(spark, name, "topic"), arrival_turn(timed), range(TURNS), FILES)
    last = timed.agg((F.max("timestamp") + F.expr("INTERVAL 31 DAYS")).alias("timestamp"))
    beat = to_envelope(last, F.lit(None).cast("binary"), "series", F.lit(-1), timestamp=F.col("timestamp"))
    write_in_turn(beat, path, F.lit(TURNS), range(TURNS, TURNS + 1), FILES)
    return path


def gaps_from_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replay gaps of a topic that arrives shuffled, by state per (series, time bucket) and timers."""
    name = "replay_gaps_stream"
    src = stream_envelope_files(spark, series_topic(spark, sf_dir, name), max_files_per_trigger=FILES)
    point = F.explode_outer(F.from_json(F.col("value").cast("string"), "MAP<STRING, DOUBLE>")).alias("ts_text", "value")
    points = src.select(F.col("key").cast("string").alias("series"), "offset", F.col("timestamp").alias("ts"), point)
    out = fresh_path(spark, name, "out")
    runner.run_available(lake_writer(SR.stream_gaps(points, SERIES_DELAY), out, fresh_path(spark, name, "checkpoint")))
    rows = spark.read.parquet(out).where("offset >= 0")
    return SR.stitched_gaps(rows, speed=10.0).select("series", "offset", "ts", "gap_s", "offset_s")


def redelivered_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number topic as an at-least-once producer leaves it: every message comes twice, the second time one turn later."""
    name = "stream_dedup"
    env = number_messages(table(spark, sf_dir, "events"))
    at = F.unix_micros("timestamp")
    ends = env.agg(F.min(at).alias("lo"), F.max(at).alias("hi")).first()
    lo, span = ends["lo"] or 0, (ends["hi"] or 0) - (ends["lo"] or 0) + 1
    first = F.floor((at - lo) * TURNS / F.lit(span)).cast("int")
    twice = env.withColumn("_again", F.explode(F.array(F.lit(0), F.lit(1))))
    path = write_in_turn(twice, fresh_path(spark, name, "topic"), first + F.col("_again"), range(TURNS + 1), FILES)
    # a message is remembered for as long as a second copy may take to come: two turns
    delay = f"{2 * -(-span // (TURNS * 1_000_000)) + 1} seconds"
    src = stream_envelope_files(spark, path, max_files_per_trigger=FILES)
    once = once_each(src, "timestamp", delay)
    out = fresh_path(spark, name, "out")
    runner.run_available(lake_writer(once, out, fresh_path(spark, name, "checkpoint")))
    return spark.read.parquet(out).select(
        "topic", "partition", "offset", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
        F.col("value").cast("string").alias("value"))


def once_each(env: DataFrame, ts: str, delay: str) -> DataFrame:
    """Drop copies of a message (same source position) that come within ``delay`` of event time; the
    state store forgets a position once the watermark has passed it."""
    return env.withWatermark(ts, delay).dropDuplicatesWithinWatermark(["topic", "partition", "offset"])
