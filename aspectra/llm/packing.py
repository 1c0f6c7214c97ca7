"""Sequence packing by non-negative least squares over length patterns.

Documents become token pieces of at most `MAX_LEN` (only longer documents are cut).
Only the histogram of piece lengths (at most MAX_LEN numbers) reaches the driver. There,
lengths are grouped into `BINS` bins, patterns of up to three bins that fill a sequence
are enumerated, their repeat counts are fitted to the histogram by non-negative
least squares and rounded down, and what is left is packed by best fit on exact
lengths. The plan is a table of intervals (length, ranks, sequences) whose size depends on
MAX_LEN alone; pieces look their sequence up by their rank within their length, and
offsets are running sums within a sequence. Pieces are ranked by (stored partition,
length), so a length that a third of all pieces share is ranked by many tasks.

Rules: null text counts as empty (a piece of the end id alone); every row gives its own pieces,
repeated rows and ids included; a null id keeps its pieces. Pieces never overlap and a
sequence's offsets run without gaps from 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored
from .tokens import checksums, closed, encoder

MAX_LEN = 2048
BINS = 256


def pieces(docs: DataFrame, tokenizer_path: str, max_len: int = MAX_LEN, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids, little-endian uint32 bytes) per piece."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path).encode
        for batch in batches:
            for at, ids, size in encode(batch.column("text")):
                ids, first, size = closed(ids, size, end_id)
                many = -(-size // max_len)
                doc = np.repeat(np.arange(len(size)), many)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
                start = piece * max_len
                length = np.minimum(max_len, size[doc] - start)
                begin = first[doc] + start
                columns = [batch.column("doc_id").take(pa.array(at + doc)), pa.array(piece, pa.int32()), pa.array(start),
                           pa.array(length), pa.array(checksums(ids, begin, length), pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    raw = ids.tobytes()
                    columns.append(pa.array([raw[4 * a:4 * (a + n)] for a, n in zip(begin.tolist(), length.tolist(), strict=True)],
                                            pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, schema)


def patterns(bins: int) -> list[tuple[int, ...]]:
    """All multisets of one to three bin sizes (1..bins) that add up to `bins`."""
    out: list[tuple[int, ...]] = [(bins,)]
    out += [(a, bins - a) for a in range(1, bins // 2 + 1)]
    out += [(a, b, bins - a - b) for a in range(1, bins // 3 + 1) for b in range(a, (bins - a) // 2 + 1)]
    return out


def nnls(columns: np.ndarray, target: np.ndarray, rounds: int | None = None) -> np.ndarray:
    """min |A x - target|, x >= 0, by active sets. `columns` holds each column's row
    numbers, padded with len(target); a repeated row counts as often as it stands."""
    n, m = len(target), len(columns)
    x, active = np.zeros(m), np.zeros(m, bool)
    dense = lambda js: np.stack([np.bincount(columns[j], minlength=n + 1)[:n] for j in js], axis=1).astype(float)
    scale = max(1.0, float(np.abs(target).max()))
    for _ in range(rounds or 3 * n):
        left = np.append(target - (np.bincount(columns.ravel(), np.repeat(x, columns.shape[1]), n + 1)[:n]), 0.0)
        gain = np.where(active, -np.inf, left[columns].sum(axis=1))
        j = int(gain.argmax())
        if gain[j] <= 1e-7 * scale:
            break
        active[j] = True
        while True:
            js = np.flatnonzero(active)
            a = dense(js)
            z = np.linalg.solve(a.T @ a + 1e-9 * np.eye(len(js)), a.T @ target)
            if z.min() > 0:
                x[:] = 0
                x[js] = z
                break
            low = z <= 0
            ratio = x[js][low] / np.maximum(x[js][low] - z[low], 1e-12)
            x[js] += ratio.min() * (z - x[js])
            x[js[low & (x[js] <= 1e-9 * scale)]] = 0
            drop = js[(x[js] <= 1e-9 * scale)]
            x[drop] = 0
            active[drop] = False
            if not active.any():
                break
    return x


def plan(histogram: np.ndarray, max_len: int = MAX_LEN, bins: int = BINS) -> list[tuple[int, int, int, int, int]]:
    """Intervals (length, first rank, how many, first sequence, slot): pieces of that length
    and those ranks go to consecutive sequences, in that slot. histogram[l]: pieces of length l."""
    bins = min(bins, max_len)
    left = histogram.astype(np.int64).copy()
    rank = np.zeros(len(left), np.int64)
    out: list[tuple[int, int, int, int, int]] = []
    made = 0

    def put(length: int, many: int, sequence: int, slot: int) -> None:
        out.append((length, int(rank[length]), many, sequence, slot))
        rank[length] += many
        left[length] -= many

    full = int(left[max_len])
    if full:
        put(max_len, full, 0, 0)
        made = full

    # a bin holds the lengths that round up to the same share of a sequence
    of_bin = [[] for _ in range(bins + 1)]
    for length in range(max_len, 0, -1):
        of_bin[-(-length * bins // max_len)].append(length)
    have = np.array([0] + [int(left[of_bin[b]].sum()) if of_bin[b] else 0 for b in range(1, bins + 1)])
    usable = [p for p in patterns(bins) if all(have[b] for b in p)]
    if usable:
        columns = np.array([[b - 1 for b in p] + [bins] * (3 - len(p)) for p in usable])
        repeats = np.floor(nnls(columns, have[1:].astype(float)) + 1e-6).astype(np.int64)
        for j in np.argsort(-repeats, kind="stable"):
            p = usable[j]
            many = min([int(repeats[j]), *(int(have[b]) // p.count(b) for b in p)])
            if many <= 0:
                continue
            for slot, b in enumerate(p):
                at, need = made, many
                for length in of_bin[b]:
                    take = min(need, int(left[length]))
                    if take:
                        put(length, take, at, slot)
                        at, need = at + take, need - take
                have[b] -= many
            made += many

    # best fit, longest first; open sequences of equal room form runs (first, how many, next slot)
    room: list[list[tuple[int, int, int]]] = [[] for _ in range(max_len + 1)]
    for length in range(max_len, 0, -1):
        while left[length] > 0:
            fit = next((r for r in range(length, max_len + 1) if room[r]), 0)
            if fit:
                first, many, slot = room[fit].pop()
                use = min(many, int(left[length]))
                if use < many:
                    room[fit].append((first + use, many - use, slot))
            else:
                fit, slot, first = max_len, 0, made
                use = max(1, int(left[length]) // (max_len // length))
                made += use
            put(length, use, first, slot)
            if fit > length:
                room[fit - length].append((first, use, slot + 1))
    return out


def assign(cut: DataFrame, max_len: int = MAX_LEN, bins: int = BINS) -> DataFrame:
    """The pieces with sequence_id and offset; `cut` needs a column length."""
    names = cut.columns
    held = stored(cut.withColumn("_part", F.spark_partition_id()), "pieces")
    counts = stored(held.groupBy("_part", "length").agg(F.count(F.lit(1)).alias("_n")), "lengths")
    histogram = np.zeros(max_len + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect():  # at most max_len rows
        histogram[r["length"]] = r["n"]
    intervals = sorted(plan(histogram, max_len, bins))
    keys = np.array([(i[0] << 44) + i[1] for i in intervals], np.int64)
    many, first, slot = (np.array([i[k] for i in intervals], np.int64) for k in (2, 3, 4))

    before = F.sum("_n").over(Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    base = counts.select("_part", "length", F.coalesce(before, F.lit(0)).alias("_before"))
    order = [F.col(c) for c in names if c in ("doc_id", "piece", "ids_crc32")]
    place = F.row_number().over(Window.partitionBy("_part", "length").orderBy(*order))
    ranked = (held.withColumn("_place", place).join(base, ["_part", "length"])
              .withColumn("_rank", F.col("_before") + F.col("_place") - 1))

    @F.pandas_udf("sequence long, slot long")
    def look_up(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        i = np.searchsorted(keys, (length.to_numpy() << 44) + rank.to_numpy(), side="right") - 1
        past = rank.to_numpy() - (keys[i] & ((1 << 44) - 1))
        return pd.DataFrame({"sequence": first[i] + past, "slot": slot[i]})

    placed = ranked.withColumn("_at", look_up("length", "_rank"))
    run = Window.partitionBy("_at.sequence").orderBy("_at.slot").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select(*names, F.col("_at.sequence").alias("sequence_id"),
                         F.coalesce(F.sum("length").over(run), F.lit(0)).alias("offset"))


def pack(docs: DataFrame, tokenizer_path: str, max_len: int = MAX_LEN, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their sequence and offset; with_ids keeps the token ids."""
    return assign(pieces(docs, tokenizer_path, max_len, end_id, with_ids), max_len)
