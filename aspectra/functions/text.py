"""Text cleaning, tokenising and id sequences.

Tokens follow Python's Unicode ``\\w+`` (letters, numbers, underscore) and the
cleaner follows ``re.sub(r'[^\\w\\s]', '')``, ``re.sub(r'\\d+', '')``, ``strip()``
on lower-cased text, written as explicit character classes so the JVM regex
engine gives the same answer as Python.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import HEAD_MAX_LEN, PAD_ID, UNK_ID
from ..operators.skew import heavy_keys, split_join

# --- fixed values: character classes equal to Python's str-pattern classes ---
WORD_CLASS = r"\p{L}\p{N}_"
# Python's \s for str patterns (str.isspace): tab, LF, VT, FF, CR, U+001C-U+001F,
# space, U+0085, U+00A0, U+1680, U+2000-U+200A, U+2028, U+2029, U+202F, U+205F, U+3000
SPACE_CLASS = r"\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
DIGIT_CLASS = r"\p{Nd}"
SPACE_CHARS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B)) \
    + "\u2028\u2029\u202f\u205f\u3000"
# --- end of fixed values ---

# Java tests the parts of a character class in turn, so letters, then spaces, are decided first.
TOKEN_PATTERN = r"[\p{L}[\p{N}_]]+"  # WORD_CLASS
#: Neither of WORD_CLASS nor of SPACE_CLASS, or a digit (\p{N} without \p{Nd}: \p{Nl}, \p{No}).
DROPPED_PATTERN = rf"[\P{{L}}&&[^\x20]&&[^\p{{Nl}}\p{{No}}_{SPACE_CLASS}]]+"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def lower_text(col: Column | str) -> Column:
    return F.lower(_c(col))


def tokens(col: Column | str) -> Column:
    """All word tokens of the lower-cased text, in order (null text -> null)."""
    return F.regexp_extract_all(lower_text(col), F.lit(TOKEN_PATTERN), 0)


def clean_text(col: Column | str) -> Column:
    """Lower-case, drop non-word non-space characters, drop digit runs, strip.

    Deleting a character never changes how another one is classified, so the
    two deletions run as one regex pass; the strip is a character-set trim."""
    t = F.regexp_replace(lower_text(col), DROPPED_PATTERN, "")
    return F.trim(t, F.lit(SPACE_CHARS))


def cut(ids: Column, max_len: int, truncate: str = "head") -> Column:
    """Keep the first (``head``) or last (``tail``) ``max_len`` elements."""
    if truncate == "head":
        return F.slice(ids, 1, max_len)
    if truncate == "tail":
        return F.when(F.size(ids) > max_len, F.slice(ids, -max_len, max_len)).otherwise(ids)
    raise ValueError("truncate must be 'head' or 'tail'")


def pad(ids: Column, max_len: int, pad_id: int = PAD_ID) -> Column:
    """Pad after the ids with ``pad_id`` up to ``max_len`` (ids already cut)."""
    return F.slice(F.concat(ids, F.array_repeat(F.lit(pad_id), max_len)), 1, max_len)


# ------------------------------------------------------------ vocabulary

def build_vocabulary(df: DataFrame, text_col: str, size: int | None = None, first_id: int = 2) -> DataFrame:
    """All tokens, or the top ``size``, by (count desc, token asc) -> (token, id), ids from ``first_id``.

    Token counts use a partial (map-side) aggregate, so a very frequent token
    costs one row per partition in the shuffle. The whole vocabulary is sorted
    by range and stored in the shared folder; a row's id is its place in its part
    plus the sizes of the parts before, so no task sees all tokens.
    """
    counts = (
        df.select(F.explode(tokens(text_col)).alias("token"))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    if size is None:
        return _numbered(counts.orderBy(F.desc("n"), F.asc("token")).select("token"), first_id)
    top = counts.orderBy(F.desc("n"), F.asc("token")).limit(size)  # TakeOrderedAndProject
    order = Window.orderBy(F.desc("n"), F.asc("token"))  # over at most `size` rows
    return top.select("token", (F.row_number().over(order) + (first_id - 1)).cast("int").alias("id"))


def _numbered(ordered: DataFrame, first_id: int) -> DataFrame:
    """The rows of a sorted frame with ``id`` counted from ``first_id`` in that order."""
    from ..session import fresh_path

    path = fresh_path(ordered.sparkSession, "vocabulary", "tokens")
    ordered.withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)  # part << 33 | place in the part
    rows = ordered.sparkSession.read.parquet(path)
    # where each part's ids begin: a table with one row per part, added up by stretches of parts
    sizes = rows.groupBy(F.shiftright("_at", 33).alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    sizes = sizes.withColumn("_stretch", F.shiftright("_part", 10))
    until = Window.unboundedPreceding, -1
    inside = F.coalesce(F.sum("_n").over(Window.partitionBy("_stretch").orderBy("_part").rowsBetween(*until)), F.lit(0))
    stretches = sizes.groupBy("_stretch").agg(F.sum("_n").alias("_n"))
    # a window without a key: over one row per 1,024 parts
    earlier = F.coalesce(F.sum("_n").over(Window.orderBy("_stretch").rowsBetween(*until)), F.lit(0))
    begins = stretches.select("_stretch", earlier.alias("_earlier"))
    first = sizes.select("_stretch", "_part", inside.alias("_inside")).join(begins, "_stretch").select(
        "_part", (F.col("_earlier") + F.col("_inside") + first_id).alias("_first"))
    own = rows.withColumn("_part", F.shiftright("_at", 33)).join(first, "_part")
    return own.select("token", (F.col("_first") + F.col("_at").bitwiseAND((1 << 33) - 1)).cast("int").alias("id"))


def token_ids(
    df: DataFrame,
    key: str | list[str],
    text_col: str,
    vocab: DataFrame,
    max_len: int = HEAD_MAX_LEN,
    truncate: str = "head",
    unk_id: int = UNK_ID,
    oov: str = "unk",
    max_vocab: int = 2_000_000,
) -> DataFrame:
    """(key, ids) per row of ``df`` with ids = vocabulary ids of the tokens, cut
    then padded to ``max_len``; rows that share a key stay apart. Null text gives
    null ids. A token's id is the least one that ``vocab`` (token, id) gives it.

    ``oov="drop"`` removes tokens outside the vocabulary *before* the cut (a
    Keras-style tokenizer without an OOV token).

    A vocabulary of at most ``max_vocab`` entries (counted) is broadcast and
    looked up inside the row, so nothing is shuffled. Of a larger one the ``max_vocab`` lowest ids (the most frequent words of
    ``build_vocabulary``) are looked up so; tokens that are left and can still be within the cut are joined by
    shuffle and put back into their rows, with equal results.
    """
    if truncate not in ("head", "tail"):
        raise ValueError("truncate must be 'head' or 'tail'")
    if oov not in ("unk", "drop"):
        raise ValueError("oov must be 'unk' or 'drop'")
    keys = [key] if isinstance(key, str) else list(key)
    toks = tokens(text_col)
    if oov == "unk":
        toks = cut(toks, max_len, truncate)
    rows = vocab.select("token", "id").limit(max_vocab + 1).collect()
    if len(rows) > max_vocab:
        return _joined_ids(df.select(*keys, toks.alias("toks")), keys, vocab, max_len, truncate, unk_id, oov, max_vocab)
    return df.select(*keys, _looked_up(df, rows, max_len, truncate, unk_id, oov)(toks).alias("ids"))


def _looked_up(df: DataFrame, rows: list, max_len: int, truncate: str, unk_id: int, oov: str):
    """Arrow UDF: array of tokens -> array of ``max_len`` ids."""
    ids: dict[str, int] = {}
    for r in rows:
        ids[r["token"]] = min(int(r["id"]), ids.get(r["token"], int(r["id"])))
    held = df.sparkSession.sparkContext.broadcast(ids)
    indexes: list[tuple[pd.Index, np.ndarray]] = []

    @F.arrow_udf("array<int>")
    def lookup(batch: pa.Array) -> pa.Array:
        if not indexes:  # once per task
            known = held.value
            indexes.append((pd.Index(list(known), dtype=object), np.array([*known.values(), unk_id], np.int64)))
        index, id_of = indexes[0]
        n = len(batch)
        lengths = pc.fill_null(pc.list_value_length(batch), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = batch.flatten().to_numpy(zero_copy_only=False)
        pos = index.get_indexer(flat) if len(flat) else np.zeros(0, np.int64)
        row = np.repeat(np.arange(n), lengths)
        if oov == "drop":
            row, pos = row[pos >= 0], pos[pos >= 0]
        have = np.bincount(row, minlength=n)
        place = np.arange(len(row)) - np.repeat(np.cumsum(have) - have, have)
        if truncate == "tail":
            place -= np.repeat(np.maximum(have - max_len, 0), have)
        inside = (place >= 0) & (place < max_len)
        out = np.full((n, max_len), PAD_ID, np.int32)
        out[row[inside], place[inside]] = id_of[pos[inside]]  # -1, a token unknown, takes the last entry
        return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * max_len, pa.int32()), pa.array(out.ravel()),
                                        mask=batch.is_null())

    return lookup


def _partly_looked_up(df: DataFrame, rows: list, max_len: int, truncate: str, oov: str):
    """Arrow UDF: array of tokens -> ``ids`` of the tokens, null for those that ``rows`` lacks, and these as ``open``. Where
    unknown tokens are dropped, the tokens that ``max_len`` ids found keep out of the cut are left away."""
    held = df.sparkSession.sparkContext.broadcast({r["token"]: int(r["id"]) for r in rows})
    indexes: list[tuple[pd.Index, np.ndarray]] = []

    @F.arrow_udf("struct<ids: array<int>, open: array<string>>")
    def lookup(batch: pa.Array) -> pa.Array:
        if not indexes:  # once per task
            known = held.value
            indexes.append((pd.Index(list(known), dtype=object), np.array([*known.values(), 0], np.int32)))
        index, id_of = indexes[0]
        n = len(batch)
        lengths = pc.fill_null(pc.list_value_length(batch), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = batch.flatten()
        words = flat.to_numpy(zero_copy_only=False)
        pos = index.get_indexer(words) if len(words) else np.zeros(0, np.int64)
        row = np.repeat(np.arange(n), lengths)
        if oov == "drop":
            found = np.cumsum(pos >= 0)
            ends = np.cumsum(lengths)
            until = np.concatenate([[0], found])
            if truncate == "head":  # found before the token, in its row
                beside = until[:-1] - np.repeat(until[ends - lengths], lengths)
            else:  # found after it
                beside = np.repeat(until[ends], lengths) - found
            near = beside < max_len
            row, pos, flat = row[near], pos[near], flat.filter(pa.array(near))
        missing = pos < 0

        def lists(rows_of: np.ndarray, values: pa.Array) -> pa.Array:
            offsets = np.concatenate([[0], np.cumsum(np.bincount(rows_of, minlength=n))])
            return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)

        ids = lists(row, pa.array(id_of[pos], pa.int32(), mask=missing))
        return pa.StructArray.from_arrays([ids, lists(row[missing], flat.filter(pa.array(missing)))], ["ids", "open"],
                                          mask=batch.is_null())

    return lookup


def _joined_ids(kept: DataFrame, keys: list[str], vocab: DataFrame, max_len: int, truncate: str, unk_id: int,
                oov: str, max_vocab: int) -> DataFrame:
    """The same for a vocabulary that is too large to hold. Its ``max_vocab`` lowest ids are looked up inside the row; the other
    tokens go through a shuffle join, in which those that are more than a thousandth of them are looked up by
    broadcast and scattered."""
    from ..session import fresh_path

    spark = kept.sparkSession
    least = vocab.where(F.col("token").isNotNull()).groupBy("token").agg(F.min("id").cast("int").alias("id"))
    lowest = least.agg(F.min("id").alias("id")).first()["id"]
    held = least.where(F.col("id") < (lowest or 0) + max_vocab).limit(max_vocab).collect()
    path = fresh_path(spark, "token_ids", "rows")
    looked_up = _partly_looked_up(kept, held, max_len, truncate, oov)("toks").alias("_found")
    kept.select(*keys, looked_up).withColumn("_row", F.monotonically_increasing_id()).write.parquet(path)  # row numbers that stay
    rows = spark.read.parquet(path)
    places = F.transform("_found.ids", lambda x, i: F.struct(i.alias("pos"), x.alias("id")))
    gaps = F.transform(F.filter(places, lambda p: p["id"].isNull()), lambda p: p["pos"])
    each = rows.select("_row", F.inline(F.arrays_zip(gaps.alias("pos"), F.col("_found.open").alias("token"))))
    counts_path = fresh_path(spark, "token_ids", "counts")  # one row per token, counted once
    each.groupBy("token").agg(F.count(F.lit(1)).alias("n")).write.parquet(counts_path)
    heavy = heavy_keys(spark.read.parquet(counts_path), ["token"], "n")
    each = split_join(each, least, ["token"], heavy, ["id"], ["_row", "pos"])
    each = each.where("id is not null") if oov == "drop" else each.withColumn("id", F.coalesce("id", F.lit(unk_id)))
    joined = each.groupBy("_row").agg(F.collect_list(F.struct("pos", "id")).alias("_joined"))
    entries = F.array_sort(F.concat(F.filter(places, lambda p: p["id"].isNotNull()),
                                    F.coalesce("_joined", F.array().cast("array<struct<pos:int,id:int>>"))))
    whole = pad(cut(F.transform(entries, lambda e: e["id"]), max_len, truncate), max_len)
    return rows.join(joined, "_row", "left").select(*keys, F.when(F.col("_found").isNotNull(), whole).alias("ids"))
