"""A live count of the latest row per id, kept as signed deltas per batch.

State holds, for every id, the position and the values of its latest row: a newer row takes the older one's values out of the
counts and puts its own in. Every batch stores the sums of those changes, one row per (column, value) that changed,
under its id; a replayed batch replaces them. The view is the sum of the deltas, so a read costs the number of batches times
the few cells, never the rows, and nothing is kept on the driver.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .results import overwrite_partitions
from .sinks import BatchFn

DELTAS_DDL = "name STRING, value STRING, delta BIGINT, batch_id BIGINT"


#: State groups that the ids are dealt into by their hash: a batch calls Python at most this often.
BUCKETS = 1 << 13


def signed_changes(rows: DataFrame, id_col: str, position: str, values: list[str], buckets: int = BUCKETS) -> DataFrame:
    """(name, value, delta) for the changes that a batch's rows make to the counts of the latest row per id (append mode).
    Of rows of one id the greatest position is the latest, in whatever order they come; rows without an id are not counted.
    Null values count as ``NONE``. State: position and values of one row per id, held in ``buckets`` groups, each as one
    JSON text that names every combination of values once; choose ``buckets`` so that a group's ids fit a task easily."""
    kept = rows.where(F.col(id_col).isNotNull()).select(
        F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(buckets)).cast("int").alias("bucket"),
        F.col(id_col).cast("string").alias("id"), F.col(position).cast("long").alias("position"),
        F.array(*[F.coalesce(F.col(v).cast("string"), F.lit("NONE")) for v in values]).alias("cells"))

    def change(key, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        ids, positions, kinds, cells = json.loads(state.get[0]) if state.exists else ([], [], [], [])
        cells = [tuple(c) for c in cells]
        latest = dict(zip(ids, zip(positions, [cells[k] for k in kinds], strict=True), strict=True))
        before: dict[str, tuple | None] = {}
        for pdf in frames:
            for i, p, c in zip(pdf["id"], pdf["position"].tolist(), pdf["cells"], strict=True):
                old = latest.get(i)
                if old is None or p > old[0]:
                    before.setdefault(i, old and old[1])
                    latest[i] = (p, tuple(c))
        sums: Counter = Counter()
        for i, old in before.items():
            sums.update(zip(values, latest[i][1], strict=True))
            if old is not None:
                sums.subtract(zip(values, old, strict=True))
        if before:
            place: dict[tuple, int] = {}
            kinds = [place.setdefault(c, len(place)) for _, c in latest.values()]
            state.update((json.dumps([list(latest), [p for p, _ in latest.values()], kinds, list(place)], separators=(",", ":")),))
            yield pd.DataFrame([(n, v, d) for (n, v), d in sums.items() if d], columns=["name", "value", "delta"])

    return kept.groupBy("bucket").applyInPandasWithState(
        change, "name STRING, value STRING, delta LONG", "held STRING", "append", "NoTimeout")


def deltas_sink(path: str) -> BatchFn:
    """``foreachBatch`` writer of ``signed_changes``: their sums, under the batch's id."""
    def write(batch_df: DataFrame, batch_id: int) -> None:
        sums = batch_df.groupBy("name", "value").agg(F.sum("delta").alias("delta"))
        overwrite_partitions(sums.withColumn("batch_id", F.lit(batch_id).cast("bigint")), path, ["batch_id"])

    return write


def live_counts(spark: SparkSession, path: str, until: int | None = None) -> DataFrame:
    """(name, value, count) after the last stored batch, or after batch ``until``; cells that went back to zero are left out."""
    deltas = spark.read.schema(DELTAS_DDL).parquet(path)
    if until is not None:
        deltas = deltas.where(F.col("batch_id") <= until)
    return deltas.groupBy("name", "value").agg(F.sum("delta").alias("count")).where("count <> 0")
