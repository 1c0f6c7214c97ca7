"""Time series messages, parsing and replay gaps.

A series point travels as a one-key JSON map ``{"<timestamp text>": value}``
keyed by the series name. Replay gaps are the time between consecutive points
of a series divided by a speed factor.

Gaps never window over a whole series (a hot series would land in one task,
and so would a burst inside a fixed time bucket). Each series is cut into
chunks at its own time quantiles (``percentile_approx`` per series: a mergeable
partial aggregate, one small row per series), so a series holding a third of
all points spans many chunks of similar size; a heavy timestamp value (a burst
of equal times) is split again at quantiles of the tie-break column. A point's
chunk is a function of its own values, so every branch of the plan agrees on
it. The small per-series tables are broadcast only after their size is counted. Gaps are windowed
per (series, chunk); the first point of each chunk takes its predecessor from a
small per-chunk aggregate. The offset since the series start is
``(ts - min(ts)) / speed`` — the running sum of gaps telescopes — so it needs
only the per-chunk minimum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.json import parse_map
from ..sources.envelope import to_envelope

TS_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
# --- fixed values: accepted free-form timestamp layouts, tried in order ---
TS_FORMATS = [
    "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy/MM/dd HH:mm:ss",
    "dd/MM/yyyy HH:mm:ss",
    "yyyy-MM-dd",
]
# --- end of fixed values ---


def ts_text(ts: Column) -> Column:
    return F.date_format(ts, TS_TEXT_FORMAT)


def parse_timestamp(text: Column) -> Column:
    """Free-form text -> TIMESTAMP_NTZ; unparsable text -> null (never an error)."""
    # ISO-8601 text takes the cheap cast; only other layouts try the patterns.
    fast = text.try_cast("timestamp_ntz")
    slow = F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in TS_FORMATS]).cast("timestamp_ntz")
    return F.coalesce(fast, slow)


def series_messages(df: DataFrame, key: str, ts: str, value: str, topic: str = "series", position: str | None = None) -> DataFrame:
    """One-key map messages keyed by the series name."""
    msg = F.to_json(F.create_map(ts_text(F.col(ts)), F.col(value).cast("double")))
    pos = F.col(position) if position else F.monotonically_increasing_id()
    return to_envelope(df, msg, topic, pos, key=F.col(key))


def parse_series(env: DataFrame) -> DataFrame:
    """Envelope of one-key maps -> (series, ts, value, offset); every map entry is a point."""
    m = parse_map(F.col("value").cast("string"))
    return env.select(
        F.col("key").cast("string").alias("series"), "offset", F.explode(m).alias("ts_text", "value")
    ).select("series", "offset", parse_timestamp(F.col("ts_text")).alias("ts"), "ts_text", "value")


def _small_table(df: DataFrame, name: str) -> DataFrame:
    """Write a small derived table once to the shared folder and read it back,
    so size checks and later plan branches do not recompute it."""
    from ..session import fresh_path

    path = fresh_path(df.sparkSession, "series", name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def _lookup(df: DataFrame, table: DataFrame, keys: list[str], rows: int, row_bytes: int, limit_bytes: int) -> DataFrame:
    """Left join of a per-key lookup table: broadcast when its measured size is
    under ``limit_bytes``, otherwise a shuffle join (AQE splits skewed keys)."""
    side = F.broadcast(table) if rows * row_bytes <= limit_bytes else table
    return df.join(side, keys, "left")


def chunked(points: DataFrame, key: str = "series", ts: str = "ts", tiebreak: str = "offset",
            chunks: int | None = None, broadcast_limit: int = 64 << 20) -> DataFrame:
    """Points + ``_us`` (event time in microseconds) + ``_b`` (chunk id).

    Chunk = (number of the series' time quantiles below the point's time) * n +
    sub-chunk. A heavy time value — one that fills two or more quantile slots,
    i.e. holds over 1/n of its series — is split again at quantiles of the
    tie-break column (only computed when such a value exists). Chunks therefore
    hold about 1/n of a series each, even for a burst of equal timestamps, and
    chunk order is (time, tie-break) order. A chunk id depends only on the
    row's values, so every plan branch agrees on it."""
    spark = points.sparkSession
    n = chunks or max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(ts))
    pts = points.withColumn("_us", micros)
    qs = [i / n for i in range(1, n)]
    empty = F.array().cast("array<bigint>")
    bounds = _small_table(
        pts.groupBy(key).agg((F.percentile_approx("_us", qs, 10_000) if qs else empty).alias("_bounds")), "time_bounds")
    info = bounds.agg(F.count(F.lit(1)).alias("rows"),
                      F.max(F.size("_bounds") - F.size(F.array_distinct("_bounds"))).alias("dups")).first()
    based = _lookup(pts, bounds, [key], info["rows"], 8 * n + 64, broadcast_limit)
    us = F.col("_us")
    lo = F.size(F.filter("_bounds", lambda b: b < us))
    if not info["dups"]:
        return based.withColumn("_b", F.when(us.isNotNull(), lo.cast("long") * n).otherwise(_apart(tiebreak))).drop("_bounds")

    heavy = us.isNotNull() & (F.size(F.filter("_bounds", lambda b: b == us)) >= 2)
    based = based.withColumn("_lo", lo).withColumn("_heavy", heavy).drop("_bounds")
    ties = _small_table(based.filter("_heavy").groupBy(key, "_us").agg(
        F.percentile_approx(F.col(tiebreak), qs, 10_000).alias("_tb")), "tie_bounds")
    based = _lookup(based, ties, [key, "_us"], ties.count(), 8 * n + 72, broadcast_limit)
    sub = F.when(F.col("_heavy"), F.size(F.filter("_tb", lambda b: b < F.col(tiebreak)))).otherwise(F.lit(0))
    return based.withColumn("_b", F.when(us.isNotNull(), F.col("_lo").cast("long") * n + sub).otherwise(_apart(tiebreak))) \
        .drop("_lo", "_heavy", "_tb")


def _apart(tiebreak: str) -> Column:
    """Points without a time have no order: negative chunks spread them over the tasks."""
    return -1 - F.pmod(F.xxhash64(tiebreak), F.lit(1 << 20))


def replay_gaps(points: DataFrame, key: str = "series", ts: str = "ts", tiebreak: str = "offset",
                speed: float = 10.0, chunks: int | None = None, broadcast_limit: int = 64 << 20) -> DataFrame:
    """Adds ``gap_s`` (seconds since the previous point of the series, / speed; 0 for
    the first point) and ``offset_s`` (seconds since the series' first point, / speed).
    Points with a null timestamp get null for both."""
    base = chunked(points, key, ts, tiebreak, chunks, broadcast_limit)
    us = F.col("_us")
    per_chunk = base.filter(us.isNotNull()).groupBy(key, "_b").agg(
        F.max("_us").alias("_last_us"), F.min("_us").alias("_first_us"))
    w_b = Window.partitionBy(key).orderBy("_b")   # one row per (series, chunk): small
    carry = per_chunk.select(
        key, "_b",
        F.lag("_last_us").over(w_b).alias("_prev_chunk_us"),
        F.min("_first_us").over(w_b.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("_start_us"),
    )
    w = Window.partitionBy(key, "_b").orderBy("_us", tiebreak)
    with_prev = base.withColumn("_prev_in_chunk", F.lag("_us").over(w))
    joined = with_prev.join(carry, [key, "_b"], "left")
    prev = F.coalesce(F.col("_prev_in_chunk"), F.col("_prev_chunk_us"))
    gap = F.when(us.isNull(), F.lit(None)).otherwise(
        F.coalesce((us - prev) / F.lit(1e6 * speed), F.lit(0.0)))
    offset = (us - F.col("_start_us")) / F.lit(1e6 * speed)
    return joined.withColumn("gap_s", gap).withColumn("offset_s", offset).drop(
        "_us", "_b", "_prev_in_chunk", "_prev_chunk_us", "_start_us")


# ------------------------------------------------------------ the same gaps as a stream

STREAM_STATE = "us BINARY, tie BINARY, value BINARY"


def stream_gaps(points: DataFrame, delay: str, bucket: str = "6 hours", key: str = "series", ts: str = "ts",
                tiebreak: str = "offset", value: str = "value") -> DataFrame:
    """Gaps within time buckets from a stream of points in any order of arrival (append mode).

    State is kept per (series, bucket), so a series that holds most points is many groups: the points of a
    bucket wait there until a timer fires, that is when the watermark (``delay`` behind the newest event time)
    has passed the bucket's end; then they leave in order with the gap to the point before, and the
    state goes. Points behind the watermark are dropped. Points without a time pass through without state.
    Event time is a TIMESTAMP column. Gives series, offset, value, us, bucket, gap_us (null for a bucket's first point);
    ``stitched_gaps`` joins the buckets."""
    width = F.expr(f"(unix_micros(timestamp'1970-01-01 00:00:00' + INTERVAL {bucket}))")
    us = F.unix_micros(ts)
    timed = (points.where(F.col(ts).isNotNull()).withWatermark(ts, delay)
             .select(F.col(key).alias("series"), F.floor(us / width).cast("long").alias("bucket"),
                     ((F.floor(us / width) + 1) * width / 1000).cast("long").alias("end_ms"),
                     us.alias("us"), F.col(tiebreak).cast("long").alias("tie"), F.col(value).cast("double").alias("value"), ts))
    schema = "series STRING, bucket LONG, offset LONG, us LONG, value DOUBLE, gap_us LONG"
    out = timed.groupBy("series", "bucket", "end_ms").applyInPandasWithState(
        _bucket_points, schema, STREAM_STATE, "append", "EventTimeTimeout")
    untimed = points.where(F.col(ts).isNull()).select(
        F.col(key).alias("series"), F.lit(None).cast("long").alias("bucket"), F.col(tiebreak).cast("long").alias("offset"),
        F.lit(None).cast("long").alias("us"), F.col(value).cast("double").alias("value"), F.lit(None).cast("long").alias("gap_us"))
    return out.unionByName(untimed)


def _bucket_points(key, frames, state):
    """One bucket of one series: keep what comes, and give it in order when its timer fires."""
    import numpy as np
    import pandas as pd

    kinds = (np.int64, np.int64, np.float64)
    held = [np.frombuffer(bytes(b), k) for b, k in zip(state.get, kinds, strict=True)] if state.exists else None
    if state.hasTimedOut:
        us, tie, value = held
        order = np.lexsort((tie, us))
        us = us[order]
        gap = pd.array(np.diff(us, prepend=us[:1]), dtype="Int64")
        gap[0] = pd.NA
        state.remove()
        yield pd.DataFrame({"series": key[0], "bucket": key[1], "offset": tie[order], "us": us, "value": value[order], "gap_us": gap})
        return
    parts = [held] if held else []
    for pdf in frames:
        parts.append([pdf[c].to_numpy(k) for c, k in zip(("us", "tie", "value"), kinds, strict=True)])
    state.update(tuple(np.concatenate(column).tobytes() for column in zip(*parts, strict=True)))
    state.setTimeoutTimestamp(max(int(key[2]), state.getCurrentWatermarkMs() + 1))


def stitched_gaps(rows: DataFrame, speed: float = 10.0) -> DataFrame:
    """Rows of ``stream_gaps`` -> series, offset, ts, value, gap_s, offset_s as ``replay_gaps`` gives them. A bucket's
    first point takes its gap from a table with one row per (series, bucket)."""
    ends = rows.where("us is not null").groupBy("series", "bucket").agg(F.min("us").alias("_first"), F.max("us").alias("_last"))
    w = Window.partitionBy("series").orderBy("bucket")
    carry = ends.select("series", "bucket", "_first", F.lag("_last").over(w).alias("_before"),
                        F.min("_first").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("_start"))
    # the first point of a bucket is the one without a gap of its own
    joined = rows.join(carry, ["series", "bucket"], "left")
    gap = F.coalesce(F.col("gap_us"), F.col("_first") - F.col("_before"), F.lit(0))
    timed = F.col("us").isNotNull()
    return joined.select("series", "offset", F.timestamp_micros("us").cast("timestamp_ntz").alias("ts"), "value",
                         F.when(timed, gap / F.lit(1e6 * speed)).alias("gap_s"),
                         F.when(timed, (F.col("us") - F.col("_start")) / F.lit(1e6 * speed)).alias("offset_s"))
