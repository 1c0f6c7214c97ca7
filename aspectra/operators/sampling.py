"""Sample, preview, latest rows and batch counts.

All row limits here are the feature itself (a dashboard sample, a preview, a
"latest" list) and run as TakeOrderedAndProject: each partition keeps its own
top ``n`` and only ``n`` rows per partition reach the final merge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.json import encode_json


def sample_rows(df: DataFrame, n: int, key_cols: list[str], seed: str = "") -> DataFrame:
    """A repeatable pseudo-random sample of ``n`` rows: order by md5(seed|key)."""
    key = F.concat_ws("|", F.lit(seed), *[F.col(c).cast("string") for c in key_cols]) if seed else \
        F.concat_ws("|", *[F.col(c).cast("string") for c in key_cols])
    return df.orderBy(F.md5(key)).limit(n)


def preview(df: DataFrame, n: int, order: list[Column], cols: list[str], json_cols: list[str] | None = None) -> DataFrame:
    """First ``n`` rows in a stable order, with a JSON rendering (of ``json_cols``) for logs."""
    shown = json_cols or cols
    return df.orderBy(*order).limit(n).select(*cols, encode_json(*shown).alias("preview_json"))


def latest_rows(df: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """The true latest rows (not the tail of a random sample)."""
    return df.orderBy(*order).limit(n)


def batch_counts(df: DataFrame, text_col: str) -> DataFrame:
    """Rows per topic partition with offset range and missing-text count."""
    return df.groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(text_col).isNull()).cast("bigint").alias("n_null_text"),
        F.min("offset").alias("min_offset"),
        F.max("offset").alias("max_offset"),
    )
