"""Time helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def utc_now_iso() -> Column:
    """Current time as UTC ISO-8601 text with microseconds, whatever the session zone."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), ISO_MICROS)


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, ISO_MICROS)
