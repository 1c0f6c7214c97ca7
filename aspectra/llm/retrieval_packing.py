"""Sequence packing by lexical retrieval: a document shares its window with its nearest texts.

Documents become token ids, stored once. The terms of the index are token ids, so the document
frequencies of the whole corpus are one table of at most the vocabulary's size; with the number of
documents and their mean length they make BM25 weights that are the same in every shard. A shard
is a run of stored documents of at most `SHARD_DOCS` documents or `SHARD_TOKENS` tokens, held by one task: its
inverted index lists, per term, the documents and their BM25 weights. Windows of a shard are filled one
by one: a seed, the first unused document, asks the index with all its terms, and of its `NEIGHBOURS` best unused
neighbours those that fit whole follow in order of score; then the best one that did not fit closes the
window and its rest is the next seed (while all fit, the next best follow). Documents that share no
term with the seed come last.

A document of more than a window fills whole windows first; its rest is retrieved like any other text.
Only the last window of a shard stays short; it is cut into sequences whose lengths are powers of two,
so no sequence needs padding. Every id lies in exactly one piece.

Rules: null text counts as empty (the end id alone); every row gives its own pieces, repeated
rows and ids included; a null id keeps its pieces. Ties in score go to the earlier stored row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .tokens import checksums, closed, encoder, gather

WINDOW = 4096
END_ID = 2
SHARD_DOCS = 1024
SHARD_TOKENS = 4 << 20
#: Neighbours looked at before one is cut.
NEIGHBOURS = 64
#: BM25 parameters: saturation of repeats, and weight of the length.
K1, B = 1.2, 0.75


def tokenized(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """doc_id, ids (little-endian uint32 bytes, the end id last) per row."""
    def ids_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path).encode
        for batch in batches:
            for at, ids, size in encode(batch.column("text")):
                ids, _, size = closed(ids, size, end_id)
                bounds = np.append(0, np.cumsum(size * 4)).astype(np.int64)
                raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(bounds), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(size)), raw.cast(pa.binary())],
                                                 ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(ids_of, "doc_id long, ids binary")


def _texts(ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the rows, one after the other, and how many each row has."""
    size = pc.binary_length(ids).to_numpy(zero_copy_only=False).astype(np.int64) // 4
    return np.frombuffer(b"".join(ids.to_pylist()), "<u4"), size


def _terms(ids: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, term, repeats) of every distinct term of every document, by document then term."""
    width = int(ids.max()) + 1 if len(ids) else 1
    kind = np.uint32 if len(size) * width < 1 << 32 else np.uint64  # short keys sort faster
    key, repeats = np.unique(np.repeat(np.arange(len(size), dtype=kind) * kind(width), size) + ids.astype(kind), return_counts=True)
    return (key // kind(width)).astype(np.int64), (key % kind(width)).astype(np.int64), repeats


def frequencies(tokens: DataFrame) -> DataFrame:
    """term, n: how many documents hold it. One partial row per term and task."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(0, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                _, term, _ = _terms(*_texts(batch.column("ids").slice(at, 4096)))
                some = np.bincount(term, minlength=len(held))
                some[:len(held)] += held
                held = some
        term = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(term, pa.int64()), pa.array(held[term], pa.int64())], ["term", "n"])

    return tokens.select("ids").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))


class Index:
    """Inverted index of one shard: per term, its documents and their BM25 weights."""

    def __init__(self, ids: np.ndarray, size: np.ndarray, idf: np.ndarray, mean: float):
        doc, term, repeats = _terms(ids, size)
        weight = idf[term] * repeats * (K1 + 1) / (repeats + K1 * (1 - B + B * size[doc] / mean))
        self.bounds = np.append(0, np.cumsum(np.bincount(doc, minlength=len(size))))  # a document's own terms
        self.terms = term
        order = np.argsort(term, kind="stable")
        self.documents, self.vocabulary = len(size), len(idf)
        self._post(term[order], doc[order], weight[order])

    def _post(self, term: np.ndarray, doc: np.ndarray, weight: np.ndarray) -> None:
        """Postings in order of their terms."""
        self.posted, self.docs, self.weights = term, doc, weight
        self.many = np.bincount(term, minlength=self.vocabulary)
        self.first = np.cumsum(self.many) - self.many

    def keep(self, wanted: np.ndarray) -> None:
        """Drop the postings of the documents that are not wanted any more."""
        stay = wanted[self.docs]
        self._post(self.posted[stay], self.docs[stay], self.weights[stay])

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every document of the shard for all terms of the seed."""
        asked = self.terms[self.bounds[seed]:self.bounds[seed + 1]]
        first, many = self.first[asked], self.many[asked]
        ends = np.cumsum(many)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - many), many)
        return np.bincount(self.docs[at], self.weights[at], self.documents)


def fill(size: np.ndarray, index: Index, window: int = WINDOW) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length) that use up documents of these sizes."""
    out: list[list[tuple[int, int, int]]] = []
    used = (size // window) * window
    for d in np.flatnonzero(used):
        out += [[(int(d), s, window)] for s in range(0, int(used[d]), window)]
    left = size - used
    open_docs = left > 0
    seed, earliest = -1, 0
    indexed = int(open_docs.sum())
    while True:
        unused = int(open_docs.sum())
        if unused < indexed // 2:  # searches then cost what the unused documents cost
            index.keep(open_docs)
            indexed = unused
        if seed < 0:
            while earliest < len(size) and not open_docs[earliest]:
                earliest += 1
            if earliest == len(size):
                break
            seed = earliest
        room = window
        sequence: list[tuple[int, int, int]] = []

        def put(d: int, many: int) -> None:
            sequence.append((d, int(used[d]), many))
            used[d] += many
            left[d] -= many
            open_docs[d] = left[d] > 0

        score = index.scores(seed) if left[seed] < room else None
        many = int(min(left[seed], room))
        put(seed, many)
        room -= many
        seed = -1
        if room and open_docs.any():
            others = np.flatnonzero(open_docs)
            others = others[np.argsort(-score[others], kind="stable")]  # no shared term: score 0, last
            for at in range(0, len(others), NEIGHBOURS):
                near = others[at:at + NEIGHBOURS]
                for d in near[left[near] <= room].tolist():
                    if left[d] <= room:
                        put(d, int(left[d]))
                        room -= sequence[-1][2]
                near = near[open_docs[near]]
                if room and len(near):  # the best that did not fit is cut; its rest begins the next window
                    seed = int(near[0])
                    put(seed, room)
                    room = 0
                if not room:
                    break
        if room:  # nothing is left in the shard
            out += _powers_of_two(sequence)
        else:
            out.append(sequence)
    return out


def _powers_of_two(sequence: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """The pieces as sequences whose lengths are the binary digits of their sum."""
    total = sum(p[2] for p in sequence)
    out, left = [], list(sequence)
    for bit in reversed(range(total.bit_length())):
        need = total & (1 << bit)
        part = []
        while need:
            d, start, many = left.pop(0)
            take = min(many, need)
            part.append((d, start, take))
            need -= take
            if take < many:
                left.insert(0, (d, start + take, many - take))
        if part:
            out.append(part)
    return out


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID, shard_docs: int = SHARD_DOCS,
         shard_tokens: int = SHARD_TOKENS, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids)."""
    tokens = stored(tokenized(docs, tokenizer_path, end_id), "tokens")
    totals = tokens.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("ids") / 4).alias("size")).first()
    documents, mean = totals["n"], (totals["size"] or 1) / max(totals["n"], 1)
    counted = frequencies(tokens).collect()  # at most one row per id of the vocabulary
    idf = np.zeros(max((r["term"] for r in counted), default=0) + 1)
    for r in counted:
        idf[r["term"]] = np.log1p((documents - r["n"] + 0.5) / (r["n"] + 0.5))

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[pa.RecordBatch], np.ndarray, np.ndarray]]:
        held, rows, many = [], 0, 0
        for batch in batches:
            size = np.cumsum(pc.binary_length(batch.column("ids")).to_numpy(zero_copy_only=False).astype(np.int64) // 4)
            at = 0
            while at < batch.num_rows:
                before = size[at - 1] if at else 0
                end = int(np.searchsorted(size, before + shard_tokens - many, side="right"))
                end = max(at + (0 if rows else 1), min(end, at + shard_docs - rows))
                held.append(batch.slice(at, end - at))
                rows, many, at = rows + end - at, many + int(size[end - 1] - before if end > at else 0), end
                if at < batch.num_rows:
                    yield held
                    held, rows, many = [], 0, 0
        if rows:
            yield held

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence_id = TaskContext.get().partitionId() << 40
        for held in shards(batches):
            table = pa.Table.from_batches(held).combine_chunks()
            ids, size = _texts(table.column("ids").combine_chunks())
            first = np.cumsum(size) - size
            rest = size % window  # what the index holds: the part behind the whole windows
            index = Index(gather(ids, first + size - rest, rest), rest, idf, mean)
            sequences = fill(size, index, window)
            doc, start, length = np.array([p for s in sequences for p in s], np.int64).reshape(-1, 3).T
            pieces = np.array([len(s) for s in sequences], np.int64)
            offset = np.cumsum(length) - length
            head = np.cumsum(pieces) - pieces
            offset -= np.repeat(offset[head], pieces)
            begin = first[doc] + start
            columns = [table.column("doc_id").combine_chunks().take(pa.array(doc)), pa.array(start), pa.array(length),
                       pa.array(checksums(ids, begin, length), pa.int64()), pa.array(size[doc]),
                       pa.array(np.repeat(sequence_id + np.arange(len(sequences)), pieces)), pa.array(offset)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                raw = ids.tobytes()
                columns.append(pa.array([raw[4 * a:4 * (a + n)] for a, n in zip(begin.tolist(), length.tolist(), strict=True)],
                                        pa.binary()))
                names.append("ids")
            sequence_id += len(sequences)
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return tokens.mapInArrow(place, schema + (", ids binary" if with_ids else ""))
