"""Array and map helpers for model outputs (F8-F12), all native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import ASPECTS, LABEL_VALUES, SENTIMENTS, UNKNOWN_LABEL


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def argmax(probs: Column | str) -> Column:
    """0-based index of the largest value; the first of tied maxima wins.
    A NaN counts as the largest value (Spark orders NaN above every number)."""
    p = _c(probs)
    return (F.array_position(p, F.array_max(p)) - 1).cast("int")


def head(probs: Column | str, i: int) -> Column:
    """Probabilities of head ``i`` from an ``ARRAY<ARRAY<FLOAT>>``."""
    return _c(probs)[i]


def group_flat(flat: Column | str, groups: int = len(ASPECTS), width: int = len(SENTIMENTS)) -> Column:
    """First ``groups * width`` values of a flat array as ``groups`` arrays of ``width``."""
    f = _c(flat)
    return F.array(*[F.slice(f, g * width + 1, width) for g in range(groups)])


def index_to_sentiment(idx: Column) -> Column:
    """Class index 0..3 -> NONE/NEG/POS/NEU (null outside the domain)."""
    return F.try_element_at(F.array(*[F.lit(s) for s in SENTIMENTS]), idx + 1)


def index_to_label(idx: Column, default: int = UNKNOWN_LABEL) -> Column:
    """Class index 0..3 -> label -1/0/1/2, anything else -> ``default``."""
    labels = F.create_map(*[x for i, v in enumerate(LABEL_VALUES) for x in (F.lit(i), F.lit(v))])
    return F.coalesce(F.try_element_at(labels, idx), F.lit(default)).cast("int")


def sentiment_to_label(sent: Column) -> Column:
    """NONE/NEG/POS/NEU -> -1/0/1/2 (null stays null)."""
    pos = F.array_position(F.array(*[F.lit(s) for s in SENTIMENTS]), sent)
    return F.when(pos > 0, pos - 2).cast("int")


def aspect_map(values: Column, aspects: list[str] = ASPECTS) -> Column:
    """Aspect names zipped with per-aspect values -> ``MAP<STRING, value>``."""
    return F.map_from_arrays(F.array(*[F.lit(a) for a in aspects]), values)


def nullable_label(value: Column) -> Column:
    """A label read as a number -> INT; NaN (a missing CSV cell) -> null."""
    d = value.cast("double")
    return F.when(F.isnan(d), F.lit(None)).otherwise(d.cast("int")).cast("int")
