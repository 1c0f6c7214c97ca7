"""Table access for the registered queries.

Tables are plain parquet; reading through ``spark.read.parquet`` lets Catalyst
prune columns and push filters into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import pin_utc, spread

# Tables whose rows carry heavy per-row work (text, payloads, scoring).
HEAVY = {"documents", "pages", "lineitem", "conversations"}

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    pin_utc(spark)
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df) if name in HEAVY else df


def register_views(spark: SparkSession, sf_dir: str) -> None:
    """Expose every table as a temp view (for SQL users and the memory-table examples)."""
    for name in TABLES:
        table(spark, sf_dir, name).createOrReplaceTempView(name)
