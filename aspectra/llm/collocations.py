"""Phrase collocations by partitioning: shards are mined with a lowered support, then everything is counted.

Documents are dealt into `SHARDS` shards by a hash of their text. A phrase with `support` occurrences
in its language has, in at least one shard, no fewer than `support` times that shard's share of the
language's words; so the union of what reaches that local support holds every frequent phrase. A
shard is mined by as many tasks as hold its documents: each adds up its phrases block by block, the sums go as packed
arrays to the task that makes their part of the union, and what stays below the local support goes. Words and
pairs are mined first; a longer phrase is only mined if all its pairs are in the union. Last, all phrases
of the union are counted exactly over the whole corpus.

While mining, a phrase is a 64-bit hash and the union is a bit map of `FILTER_BITS` bits (its size
does not depend on the data, the number of its parts does). Two phrases with one hash or one bit only add candidates; the last count is of
exact words, and whatever stays under the support there goes. No phrase is lost.

Rules: words and pieces as `PIECE` and `BLANKS` say, after A-Z became lower case; null text is empty; null lang is
`und`; every row counts, repeated rows and ids included. Ties go as stated at `collocations`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.skew import heavy_keys, split_join
from .common import mix, stored, word_hashes
from .tokens import gather

SUPPORT = 30
TOP = 2000
LONGEST = 4
SHARDS = 8
FILTER_BITS = 1 << 27
#: Bytes that end a piece, and bytes between words.
PIECE = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"
#: Bytes of text that are taken together (one text may be longer).
BLOCK = 6 << 20

#: Words, counted once for each length mined, whose phrases are summed by one task, about.
ENTRIES = 1 << 21
#: Parts of the bit map at least; a power of two.
PARTS = 16
#: Groups (language and shard) whose local support the summing tasks are told.
KNOWN = 1 << 16

_STEP = np.uint64(0x9E3779B97F4A7C15)
_IS_BREAK = bytes(c in PIECE for c in range(256))
_IS_WORD = bytes(c not in PIECE + BLANKS for c in range(256))


class Block:
    """The words of some documents: where each begins and ends, its hash, its `piece`,
    and the group (language, or language and shard) it is in."""

    def __init__(self, texts: pa.Array, group: np.ndarray):
        # lowered as bytes: Arrow's ascii_lower reads a cast slice, whose offsets begin above 0, at wrong places
        text = pc.fill_null(texts.cast(pa.large_binary()), b"")
        raw = b"\n".join(text.to_pylist()).lower()
        size = pc.binary_length(text).to_numpy().astype(np.int64) + 1
        self.raw = np.frombuffer(raw, np.uint8)
        self.start, self.end = _runs(np.frombuffer(raw.translate(_IS_WORD), np.int8))
        breaks = np.flatnonzero(np.frombuffer(raw.translate(_IS_BREAK), bool))
        self.piece = np.searchsorted(breaks, self.start).astype(np.int32)
        self.group = group[np.searchsorted(np.cumsum(size), self.start, side="right")].astype(np.int32)
        self.hash = word_hashes(self.raw, self.start, self.end)

    def __len__(self) -> int:
        return len(self.start)

    def inside(self, k: int) -> np.ndarray:
        """Places at which a phrase of k words lies within one piece."""
        n = len(self) - k + 1
        return np.flatnonzero(self.piece[:n] == self.piece[k - 1:]) if n > 0 else np.zeros(0, np.int64)

    def hashes(self, k: int, at: np.ndarray, language: np.ndarray) -> np.ndarray:
        """Hashes of the phrases of k words that begin at `at`, languages told apart."""
        out = language[self.group[at]]
        for i in range(k):
            out = mix(out * _STEP + self.hash[at + i])
        return out

    def words(self, places: np.ndarray) -> tuple[np.ndarray, pa.Array]:
        """Of the words at these places (true or false for each): their number among the distinct ones, -1 elsewhere, and those."""
        at = np.flatnonzero(places)
        size = self.end[at] - self.start[at]
        letters = np.ascontiguousarray(gather(self.raw, self.start[at], size))
        coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [
            None, pa.py_buffer(np.append(0, np.cumsum(size)).astype(np.int64)), pa.py_buffer(letters)]).dictionary_encode()
        word = np.full(len(self), -1, np.int32)
        word[at] = np.asarray(coded.indices)
        return word, coded.dictionary

    def phrases(self, k: int, at: np.ndarray, word: np.ndarray, distinct: int) -> tuple[np.ndarray, np.ndarray]:
        """Of the exact phrases (with their group) at these places: a place and the number of each."""
        key = self.group[at].astype(np.int64)
        for i in range(k):
            key = pd.factorize(key * distinct + word[at + i])[0]
        many = np.bincount(key)
        first = np.zeros(len(many), np.int64)
        first[key[::-1]] = at[::-1]
        return first, many


def _runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of ones."""
    edge = np.diff(inside, prepend=np.int8(0), append=np.int8(0))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _blocks(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[Block, list[tuple], np.ndarray]]:
    """Blocks with the values of the grouping columns and a hash of each group's language."""
    for batch in batches:
        bytes_to = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(bytes_to, (bytes_to[at - 1] if at else 0) + BLOCK, side="right")))
            part = batch.slice(at, end - at)
            keys = list(zip(*[part.column(c).to_pylist() for c in columns], strict=True))
            number, groups = pd.factorize(pd.Series(keys, dtype=object))
            groups = list(groups)
            yield Block(part.column("text"), number), groups, _language_hashes([g[0] for g in groups])
            pa.default_memory_pool().release_unused()
            at = end


def _language_hashes(languages: list[str]) -> np.ndarray:
    names = [x.encode() for x in languages]
    stop = np.cumsum([len(n) for n in names], dtype=np.int64)
    return word_hashes(np.frombuffer(b"".join(names), np.uint8), np.append(0, stop[:-1])[:len(stop)], stop)


def _group_codes(language: np.ndarray, shards: list[int]) -> np.ndarray:
    return mix(language + np.array(shards, np.int64).astype(np.uint64) * _STEP)


def _held(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes % np.uint64(FILTER_BITS)
    return (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def words(docs: DataFrame) -> DataFrame:
    """lang, shard, n: how many words each shard has of a language."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, groups, _ in _blocks(batches, ["lang", "shard"]):
            many = np.bincount(block.group, minlength=len(groups))
            yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in groups]), pa.array([g[1] for g in groups], pa.int32()),
                                              pa.array(many, pa.int64())], ["lang", "shard", "n"])

    return docs.mapInArrow(count, "lang string, shard int, n long").groupBy("lang", "shard").agg(F.sum("n").alias("n"))


def parts_for(phrases: int) -> int:
    """Into how many parts the bit map is cut so that one sums about ENTRIES of these."""
    return min(FILTER_BITS // 8, max(PARTS, 1 << max(0, -(-phrases // ENTRIES) - 1).bit_length()))


def mined(docs: DataFrame, lengths: tuple[int, ...], pairs=None, parts: int = PARTS) -> DataFrame:
    """Occurrences per shard of the hashes of all phrases of these lengths, summed by block; with `pairs` (a broadcast
    bit map) only of those whose pairs are all in it. A row has what a block holds of one part of the
    bit map: `h` and `f` of each phrase, as 8 and 4 bytes, by group; `g` and `size`, the groups' codes and how many phrases are of each."""
    width = np.uint64(FILTER_BITS // parts)
    whole = np.uint64(FILTER_BITS)

    def mine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if pairs is None else np.frombuffer(pairs.value, np.uint8)
        for block, groups, language in _blocks(batches, ["lang", "shard"]):
            good = None if bits is None else _good_pairs(block, language, bits)
            found = []
            for k in lengths:
                at = block.inside(k)
                if good is not None:
                    at = at[np.logical_and.reduce([good[at + i] for i in range(k - 1)])]
                if not len(at):
                    continue
                # the shard is told apart from the hash: sums are per shard, the union is not
                h = block.hashes(k, at, language)
                key, distinct = pd.factorize(mix(h + block.group[at].astype(np.uint64) * _STEP))
                place = np.zeros(len(distinct), np.int64)
                place[key] = np.arange(len(at))
                found.append((block.group[at[place]], h[place], np.bincount(key, minlength=len(distinct)).astype(np.int32)))
            if not found:
                continue
            group, h, f = (np.concatenate(x) for x in zip(*found, strict=True))
            del block, found
            run = (h % whole // width).astype(np.int64) * len(groups) + group
            order = np.argsort(run.astype(np.uint16) if parts * len(groups) <= 1 << 16 else run, kind="stable")
            run = run[order]
            first = np.flatnonzero(np.diff(run, prepend=-1))
            part = run[first] // len(groups)
            begins = np.flatnonzero(np.diff(part, prepend=-1))
            code = _group_codes(language, [g[1] for g in groups])[run[first] % len(groups)]
            cut = np.append(first[begins], len(run))
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[begins].astype(np.int32)), _packed(code, np.append(begins, len(first))),
                 _packed(np.diff(first, append=len(run)).astype(np.int32), np.append(begins, len(first))),
                 _packed(h[order], cut), _packed(f[order], cut)], ["part", "g", "size", "h", "f"])

    return docs.mapInArrow(mine, "part int, g binary, size binary, h binary, f binary")


def _packed(values: np.ndarray, cut: np.ndarray) -> pa.Array:
    """The bytes of values[cut[i]:cut[i + 1]], for each i."""
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cut) - 1, [
        None, pa.py_buffer(cut.astype(np.int64) * values.itemsize), pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.binary())


def _unpacked(column: pa.Array, first: int, last: int, kind: type) -> np.ndarray:
    """What rows first to last - 1 of a column of packed values hold."""
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset:]
    return np.frombuffer(column.buffers()[2], np.uint8)[at[first]:at[last]].view(kind)


def _good_pairs(block: Block, language: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Per place: a pair begins here that is in the bit map."""
    good = np.zeros(len(block), bool)
    at = block.inside(2)
    good[at] = _held(bits, block.hashes(2, at, language))
    return good


def union_filter(locally: DataFrame, shares: DataFrame, support: int, parts: int = PARTS) -> bytes:
    """Bit map of the hashes that reach their shard's share of the support in some shard.
    Each part of it is made by one task; FILTER_BITS bits reach the driver, whatever the input. Of more than KNOWN groups
    the largest have their local support, the others 1, which can only add candidates."""
    need = F.ceil(F.expr(f"cast({support} as decimal(20,0)) * n / total"))
    groups = shares.where("n > 0").select("lang", "shard", "n", need.alias("need")).orderBy(F.desc("n")).limit(KNOWN).collect()
    codes = _group_codes(_language_hashes([r["lang"] for r in groups]), [r["shard"] for r in groups])
    needs = np.array([int(r["need"]) for r in groups], np.int64)
    order = np.lexsort((needs, codes))  # of groups with one code the lowest counts
    known = locally.sparkSession.sparkContext.broadcast((codes[order], needs[order]))
    whole, width = FILTER_BITS, FILTER_BITS // parts

    def part_of(part: int, held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        g, size, h, f = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        codes, needs = known.value
        at = np.searchsorted(codes, g)
        at[at == len(codes)] = 0
        need = np.where(codes[at] == g, needs[at], 1) if len(codes) else np.ones(len(g), np.int64)
        key = pd.factorize(mix(h + np.repeat(g, size)))[0]
        enough = np.bincount(key, f)[key] >= np.repeat(need, size)  # two phrases with one key both stay
        there = np.zeros(width, bool)
        there[(h[enough] % np.uint64(whole)).astype(np.int64) - part * width] = True
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([np.packbits(there, bitorder="little").tobytes()])], ["part", "bits"])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = -1, []
        for batch in batches:
            columns = [(batch.column(c).cast(pa.large_binary()), kind) for c, kind in (("g", np.uint64), ("size", np.int32), ("h", np.uint64), ("f", np.int32))]
            part = batch.column("part").to_numpy()
            cut = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part))
            for first, last in zip(cut[:-1], cut[1:], strict=True):
                if held and part[first] != now:
                    yield part_of(now, held)
                now = int(part[first])
                held.append(tuple(_unpacked(c, first, last, kind) for c, kind in columns))
        if held:
            yield part_of(now, held)

    made = locally.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(summed, "part int, bits binary")
    out = bytearray(whole // 8)
    for r in made.collect():
        out[r["part"] * width // 8:(r["part"] + 1) * width // 8] = r["bits"]
    return bytes(out)


def counted(docs: DataFrame, filters, support: int) -> DataFrame:
    """lang, phrase, k, f: exact occurrences of every phrase of one to LONGEST words that has `support`."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        short, long = (np.frombuffer(f.value, np.uint8) for f in filters)
        for block, groups, language in _blocks(batches, ["lang"]):
            good = _good_pairs(block, language, short)
            places, used = {}, np.zeros(len(block), bool)
            for k in range(1, LONGEST + 1):
                at = block.inside(k)
                if k > 1:
                    at = at[np.logical_and.reduce([good[at + i] for i in range(k - 1)])]
                if k != 2:
                    at = at[_held(short if k == 1 else long, block.hashes(k, at, language))]
                if len(at):
                    places[k] = at
                    for i in range(k):
                        used[at + i] = True
            word, distinct = block.words(used)
            texts = np.array(distinct.to_pylist(), object)
            for k, at in places.items():
                place, many = block.phrases(k, at, word, len(texts))
                spelled = [b" ".join(ws) for ws in zip(*[texts[word[place + i]] for i in range(k)], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.array([g[0] for g in groups], object)[block.group[place]], pa.string()),
                     pa.array(spelled, pa.binary()).cast(pa.string()), pa.array(np.full(len(place), k, np.int32)), pa.array(many)],
                    ["lang", "phrase", "k", "f"])

    return (docs.mapInArrow(count, "lang string, phrase string, k int, f long")
            .groupBy("lang", "phrase", "k").agg(F.sum("f").alias("f")).where(F.col("f") >= support))


def frequent_phrases(docs: DataFrame, support: int = SUPPORT, shards: int = SHARDS) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, k, f) of all phrases of one to LONGEST words with `support` occurrences, and (lang, n)."""
    sc = docs.sparkSession.sparkContext
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                        F.pmod(F.xxhash64("text"), F.lit(shards)).cast("int").alias("shard"), "text").where(F.col("text").isNotNull())
    per_shard = stored(words(texts), "shares")
    totals = per_shard.groupBy("lang").agg(F.sum("n").alias("total"))
    shares = per_shard.join(totals, "lang")
    total = per_shard.agg(F.sum("n")).first()[0] or 0

    def union(lengths: tuple[int, ...], pairs=None) -> bytes:
        parts = parts_for(total * len(lengths))
        return union_filter(mined(texts, lengths, pairs, parts), shares, support, parts)

    short = sc.broadcast(union((1, 2)))
    long = sc.broadcast(union(tuple(range(3, LONGEST + 1)), short))
    exact = stored(counted(texts.select("lang", "text"), (short, long), support), "phrases")
    return exact, totals.select("lang", F.col("total").alias("n"))



def collocations(docs: DataFrame, support: int = SUPPORT, top: int = TOP, shards: int = SHARDS) -> DataFrame:
    """Each language's `top` phrases of two to LONGEST words by the score of their weakest cut.

    score = floor(2000000 a / (l + r)) for the cut into parts of l and r occurrences; the lowest score counts, of
    equal ones the smallest first part. A phrase within a longer one that has at least 80 of 100 of its
    occurrences goes. Order: score and a descending, then the phrase's bytes."""
    exact, totals = frequent_phrases(docs, support, shards)
    words_of = F.split("phrase", " ")
    phrases = exact.where("k >= 2").select("lang", "phrase", "k", F.col("f").alias("a"), words_of.alias("_w"))

    # the parts of every cut; common words are parts of many phrases
    cuts = phrases.select("lang", "phrase", "a", "_w", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.array_join(F.slice("_w", F.lit(1), F.col("cut")), " ").alias("part")),
        F.struct(F.lit(1).alias("side"), F.array_join(F.slice("_w", F.col("cut") + 1, F.size("_w") - F.col("cut")), " ").alias("part")),
    )).alias("p")).select("lang", "phrase", "a", "cut", "p.side", "p.part")
    heavy = heavy_keys(stored(cuts.groupBy("lang", "part").agg(F.count(F.lit(1)).alias("n")), "parts"), ["lang", "part"], "n")
    parts = exact.select("lang", F.col("phrase").alias("part"), F.col("f"))
    scored = split_join(cuts, parts, ["lang", "part"], heavy, ["f"], ["lang", "phrase", "cut"])
    sides = scored.groupBy("lang", "phrase", "a", "cut").agg(
        F.sum(F.when(F.col("side") == 0, F.col("f"))).alias("l"), F.sum(F.when(F.col("side") == 1, F.col("f"))).alias("r"))
    score = F.expr("cast(a as decimal(20,0)) * cast(2000000 as decimal(7,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    weakest = sides.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("m"))

    # what longer phrases have of the phrases within them
    inner = phrases.where("k >= 3").select("lang", "a", F.explode(F.expr(
        "flatten(transform(sequence(2, k - 1), m -> transform(sequence(1, k - m + 1), i -> array_join(slice(_w, i, m), ' '))))"
    )).alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("_longer"))
    alone = weakest.join(inner, ["lang", "phrase"], "left").where(F.expr(
        "_longer is null or cast(_longer as decimal(20,0)) * 100 < cast(a as decimal(20,0)) * 80"))

    # a language may hold most phrases: first the best of each part of it, then the best of those
    order = [F.col("m.score").desc(), F.col("a").desc(), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(256))
    best = alone.withColumn("_part", part).withColumn(
        "_place", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))).where(F.col("_place") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("m.l").alias("l"), F.col("m.r").alias("r"),
        "n", F.col("m.score").alias("score"))
