"""Helpers shared by the training-data operators: stored intermediates, the
crc32 learning split, bounded labelled samples and vectorised word hashing."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import pin_utc, shared_dir

#: Bytes that separate words: space and the ASCII control white space.
BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_MULT = 0x9E3779B97F4A7C15


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    pin_utc(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, label: str) -> str:
    """A new location under the folder that ``spark.checkpoint.dir`` names, scheme kept."""
    return f"{shared_dir(spark)}/llm-{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write the rows to the shared folder and read them back: later jobs start
    from files that outlive any executor, and a lazy plan runs once."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body) -> Column:
    """`body(value)` with the value computed once per row, also where a lambda
    inside the body uses it for every element."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))


def remainder(doc_id: str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; null for a null id."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(mod))


def hash_share(*cols: Column | str) -> Column:
    """A number in [0, 1) that depends on the values alone."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 30)) / F.lit(float(1 << 30))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, per_class: int,
                    max_chars: int, features) -> tuple[list[tuple[int, float, np.ndarray]], dict[int, int]]:
    """Features of a bounded sample of labelled documents: at most about
    ``per_class`` documents of each class (drawn by a hash of the id), each of
    at most ``max_chars`` characters, so at most ``2 * per_class`` short texts
    are ever joined, and only their feature arrays reach the driver.

    Ids labelled both ways, null ids and null labels are not learned from;
    repeated rows of one id count once. Returns the rows (label, hash share,
    features) and how many ids each class has in all.
    """
    marks = (labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_y"))
             .where(F.col("_id").isNotNull() & F.col("_y").isin(0, 1))
             .groupBy("_id").agg(F.min("_y").alias("_y"), F.max("_y").alias("_top"))
             .where((F.col("_y") == F.col("_top")) & learn).drop("_top")
             .withColumn("_share", hash_share(F.lit(label), F.col("_id"))))
    counts = {r["_y"]: r["n"] for r in marks.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    keep = F.lit(False)
    for y, n in counts.items():
        keep = keep | ((F.col("_y") == y) & (F.col("_share") < min(1.0, per_class / n)))
    drawn = marks.where(keep)  # about 2 * per_class rows whatever the table holds
    texts = (docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
             .where(F.col("_text").isNotNull() & (F.length("_text") <= max_chars))
             .join(F.broadcast(drawn), "_id")
             .groupBy("_id", "_y", "_share").agg(F.min("_text").alias("_text")))

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"y": pdf["_y"], "share": pdf["_share"],
                                "f": [features(t).astype(np.int32).tobytes() for t in pdf["_text"]]})

    rows = texts.mapInPandas(extract, "y int, share double, f binary").collect()
    out = [(r["y"], r["share"], np.frombuffer(bytes(r["f"]), np.int32)) for r in rows]
    return sorted(out, key=lambda r: r[1]), counts


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_spans(buf: np.ndarray, blank: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that are not separators."""
    if not len(buf):
        empty = np.zeros(0, np.int64)
        return empty, empty
    word = np.empty(len(buf) + 2, np.int8)
    word[0] = word[-1] = 0
    word[1:-1] = ~blank[buf]
    edge = np.diff(word)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


#: Random values per (place in the word, byte) for the first places; later ones are mixed when needed.
_PLACES = 64
_VALUES = mix(np.arange(_PLACES * 256, dtype=np.uint64) + np.uint64(_MULT))


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One 64-bit hash per span: the sum of random values that depend on each byte and on its place in
    the span, so equal words hash equally wherever they stand and no pattern of bytes cancels out."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    length = ends - starts
    stop = np.cumsum(length)
    total = int(stop[-1])
    letters = buf
    if total != len(buf):
        edge = np.zeros(len(buf) + 1, np.int8)
        solid = slice(None) if length.all() else length > 0  # then no place begins or ends two spans
        edge[starts[solid]] += 1
        edge[ends[solid]] -= 1
        letters = buf[np.cumsum(edge[:-1], dtype=np.int8).view(bool)]
    kind = np.int32 if total < 1 << 31 else np.int64
    place = np.arange(total, dtype=kind)
    place -= np.repeat((stop - length).astype(kind), length)
    far = np.flatnonzero(place >= _PLACES)
    late = mix((place[far].astype(np.uint64) << np.uint64(8)) + letters[far] + np.uint64(_MULT)) if len(far) else None
    if late is not None:
        place[far] = 0
    place <<= 8
    place += letters
    value = _VALUES[place]
    if late is not None:
        value[far] = late
    run = np.zeros(total + 1, np.uint64)
    np.cumsum(value, out=run[1:])
    return mix(run[stop] - run[stop - length] + length.astype(np.uint64))


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """One hash per run of k consecutive words; a shorter text is one run."""
    if len(words) == 0:
        return words
    if len(words) < k:
        k = len(words)
    n = len(words) - k + 1
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out = mix(out * np.uint64(_MULT) + words[i:i + n])
    return out
