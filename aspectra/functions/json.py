"""JSON message encoding and parsing (all JVM-side expressions)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ASPECTS

CORRUPT = "_corrupt_record"

# Declared message schemas (one JSON object per topic value).
REVIEW_DDL = "id STRING, review STRING"
LABELLED_DDL = "review_text STRING, " + ", ".join(f"{a} INT" for a in ASPECTS)
NUMBER_DDL = "number BIGINT"
TRANSACTION_DDL = "id BIGINT, data ARRAY<ARRAY<DOUBLE>>, current_time STRING"
ANOMALY_DDL = TRANSACTION_DDL + ", score ARRAY<DOUBLE>"
SERIES_DDL = "MAP<STRING, DOUBLE>"


def encode_json(*cols: Column | str, keep_nulls: bool = True) -> Column:
    """Row -> JSON text. ``keep_nulls`` writes explicit ``null`` fields."""
    opts = {"ignoreNullFields": "false"} if keep_nulls else {}
    return F.to_json(F.struct(*cols), opts)


def value_text(col: Column | str = "value") -> Column:
    """Topic value bytes -> UTF-8 text."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("string")


def parse_json(text: Column, ddl: str) -> Column:
    """JSON text -> struct with the declared schema plus ``_corrupt_record``.

    Malformed text yields a struct whose fields are null and whose
    ``_corrupt_record`` holds the raw text; JSON ``null`` yields a null struct.
    """
    return F.from_json(
        text,
        f"{ddl}, {CORRUPT} STRING",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )


def parse_map(text: Column, ddl: str = SERIES_DDL) -> Column:
    """JSON text -> MAP (schemaless one-key messages)."""
    return F.from_json(text, ddl)


def parse_envelope(env: DataFrame, ddl: str, keep: tuple[str, ...] = ("topic", "partition", "offset", "timestamp")) -> DataFrame:
    """Envelope -> envelope metadata + ``data`` struct (+ the raw text for dead letters)."""
    text = value_text("value")
    # The parse sits in a one-element Generate: a later filter on ``data`` (the
    # dead-letter split) cannot be pushed below a generator's output, so the JSON
    # is parsed once, after any repartition, instead of once in the pushed-down
    # filter and again in the projection.
    one = F.array(F.struct(text.alias("raw"), parse_json(text, ddl).alias("data")))
    return env.select(*keep, F.inline(one))


def is_dead(parsed: DataFrame) -> Column:
    """A message is dead when its payload is missing, not JSON, or not an object.

    A JSON object whose fields only partly fit the schema (a label ``1.5`` or
    ``"2"`` for an INT) keeps the fields that fit; the others read as null, as a
    plain ``from_json`` gives them."""
    fields = [f.name for f in parsed.schema["data"].dataType.fields if f.name != CORRUPT]
    nothing_parsed = F.lit(True)
    for f in fields:
        nothing_parsed = nothing_parsed & F.col(f"data.{f}").isNull()
    return (
        F.col("raw").isNull()
        | F.col("data").isNull()
        | (F.col(f"data.{CORRUPT}").isNotNull() & nothing_parsed)
    )


def nulled_fields(parsed: DataFrame) -> Column:
    """How many fields of a message were given but did not fit the schema, and so read as null."""
    fields = [f.name for f in parsed.schema["data"].dataType.fields if f.name != CORRUPT]
    lost = [(F.col(f"data.{f}").isNull() & F.get_json_object("raw", f"$.{f}").isNotNull()).cast("int") for f in fields]
    out = F.lit(0)
    for one in lost:
        out = out + F.coalesce(one, F.lit(0))
    return out


def split_dead_letter(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows with ``data.*`` flattened, dead-letter rows with a reason)."""
    dead = is_dead(parsed)
    fields = [f.name for f in parsed.schema["data"].dataType.fields if f.name != CORRUPT]
    meta = [c for c in parsed.columns if c not in ("raw", "data")]
    good = parsed.filter(~dead).select(*meta, *[F.col(f"data.{f}").alias(f) for f in fields])
    reason = (
        F.when(F.col("raw").isNull(), F.lit("empty_payload"))
        .when(F.col("data").isNull(), F.lit("not_an_object"))
        .otherwise(F.lit("malformed_json"))
    )
    bad = parsed.filter(dead).select(
        *meta,
        reason.alias("reason"),
        F.coalesce(F.octet_length("raw"), F.lit(0)).cast("bigint").alias("payload_bytes"),
        F.col("raw").alias("payload"),
    )
    return good, bad
