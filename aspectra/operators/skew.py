"""Equi-joins against a lookup table when a few keys hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is heavy if it holds more than one in HEAVY_SHARE rows, so fewer than HEAVY_SHARE keys are.
HEAVY_SHARE = 1000


def heavy_keys(counts: DataFrame, keys: list[str], n: str, share: int = HEAVY_SHARE) -> DataFrame:
    """The keys of `counts` (one row per key, `n` rows each) with more than 1/share of all rows:
    by construction fewer than `share` rows, whatever the table holds."""
    total = counts.agg(F.sum(n).alias("n")).first()["n"] or 0
    return counts.where(F.col(n) * share > total).select(*keys)


def split_join(rows: DataFrame, table: DataFrame, keys: list[str], heavy: DataFrame, values: list[str],
               spread_by: list[str]) -> DataFrame:
    """Left join of `table` (one row per key; columns `values`) that no key can overload.

    Rows of the `heavy` keys (see `heavy_keys`) take their values from a broadcast of those few table
    rows; in the shuffle join of the others they are scattered by a hash of `spread_by` under
    marks that match nothing. Null keys get null values and are scattered alike."""
    held = F.broadcast(table.join(F.broadcast(heavy), keys, "left_semi")
                       .select(*keys, *[F.col(v).alias(f"_hot_{v}") for v in values], F.lit(True).alias("_hot")))
    some_null = F.lit(False)
    for k in keys:
        some_null = some_null | F.col(k).isNull()
    apart = F.col("_hot").isNotNull() | some_null
    marked = rows.join(held, keys, "left").withColumn(
        "_mark", F.when(apart, F.pmod(F.xxhash64(*spread_by), F.lit(1 << 30)).cast("int") + 1).otherwise(0))
    rest = table.select(*keys, *[F.col(v).alias(f"_cold_{v}") for v in values], F.lit(0).alias("_mark"))
    out = marked.join(rest, [*keys, "_mark"], "left")
    return out.select(*rows.columns, *[F.coalesce(f"_hot_{v}", f"_cold_{v}").alias(v) for v in values])


#: Keys that a semi-join sends to every task (about 64 MB of longs); more are joined by shuffle.
HELD_KEYS = 4_000_000


def rows_of(rows: DataFrame, keys: DataFrame, key: str, held: int = HELD_KEYS) -> DataFrame:
    """The rows whose ``key`` is in ``keys`` (repeats allowed). A set of keys that was counted as small enough is broadcast, so
    wide rows stay where they are."""
    known = keys.select(key).where(F.col(key).isNotNull()).distinct()
    return rows.join(F.broadcast(known) if known.count() <= held else known, key, "left_semi")
