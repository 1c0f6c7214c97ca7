"""Windowed aggregates over event time (W13): batch and streaming forms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ASPECTS


def tumbling(df: DataFrame, ts: str, width: str, keys: list[str], value: str | None = None) -> DataFrame:
    """Count (and sum of ``value``) per tumbling window and key; partial aggregation
    keeps the shuffle to one row per (window, key) per partition."""
    aggs = [F.count(F.lit(1)).alias("n")]
    if value:
        aggs.append(F.round(F.sum(value), 6).alias("total"))
    w = F.window(F.col(ts), width)
    return df.groupBy(w.alias("w"), *keys).agg(*aggs).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, *[a for a in ["n", "total"] if a == "n" or value])


def stream_tumbling(df: DataFrame, ts: str, width: str, delay: str, keys: list[str], value: str | None = None) -> DataFrame:
    """Streaming form: rows later than ``delay`` behind the newest event time are
    dropped; append output emits a window once the watermark passes its end.
    Event time must be a TIMESTAMP (LTZ) column for the watermark."""
    return tumbling(df.withWatermark(ts, delay), ts, width, keys, value)


def sentiment_over_time(wide: DataFrame, ts: str, width: str = "1 hour", aspects: list[str] = ASPECTS) -> DataFrame:
    """(window_start, Aspect, Sentiment, Count) for every non-empty cell; null -> NONE."""
    cells = F.array(*[F.struct(F.lit(a).alias("Aspect"), F.coalesce(F.col(a), F.lit("NONE")).alias("Sentiment"))
                      for a in aspects if a in wide.columns])
    long = wide.select(F.window(F.col(ts), width).start.alias("window_start"), F.inline(cells))
    return long.groupBy("window_start", "Aspect", "Sentiment").agg(F.count(F.lit(1)).alias("Count"))
