"""Starting, draining and bounding streaming queries."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from .sinks import BatchFn

log = logging.getLogger(__name__)


def with_trigger(writer: DataStreamWriter, trigger: str | None) -> DataStreamWriter:
    """``None`` = default trigger (next batch as soon as the last ends);
    ``"available"`` = drain what is there, then stop; otherwise a processing-time interval."""
    if trigger is None:
        return writer
    if trigger == "available":
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def foreach_batch(df: DataFrame, fn: BatchFn, checkpoint: str, trigger: str | None = "5 seconds",
                  name: str | None = None) -> DataStreamWriter:
    w = df.writeStream.foreachBatch(fn).outputMode("append").option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    return with_trigger(w, trigger)


def run_available(writer: DataStreamWriter) -> StreamingQuery:
    """Run a query with the available-now trigger until everything there is done, however
    long that takes; a failure raises and leaves the failed batch uncommitted."""
    q = with_trigger(writer, "available").start()
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(f"stream failed: {q.exception()}")
    return q


def run_all(writers: list[DataStreamWriter]) -> None:
    """Start several writers (triggers set) and wait for all; a failure of one stops the others."""
    started = [w.start() for w in writers]
    try:
        for q in started:
            q.awaitTermination()
            if q.exception():
                raise RuntimeError(f"stream failed: {q.exception()}")
    finally:
        for q in started:
            if q.isActive:
                q.stop()


def bounded_run(q: StreamingQuery, limit_s: float | None) -> bool:
    """Let a running query work for at most ``limit_s`` seconds (None: until it ends), then stop it.
    Returns True when it ended by itself. Checkpoints are never deleted here:
    a restart resumes from them."""
    ended = q.awaitTermination(limit_s) if limit_s is not None else (q.awaitTermination() or True)
    if not ended:
        log.info("stopping %s after %ss", q.name or q.id, limit_s)
        q.stop()
    if q.exception():
        raise RuntimeError(f"stream failed: {q.exception()}")
    return bool(ended)


def retrying(start, attempts: int = 5, limit_s: float | None = None) -> int:
    """Restart a query (``start()`` -> StreamingQuery) after failures, up to ``attempts``
    times; each attempt resumes from the same checkpoint. Returns attempts used."""
    for i in range(1, attempts + 1):
        try:
            bounded_run(start(), limit_s)
            return i
        except Exception as e:  # StreamingQueryException or a sink error  # noqa: BLE001
            log.warning("attempt %s failed: %s", i, e)
            if i == attempts:
                raise
    return attempts
