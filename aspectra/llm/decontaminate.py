"""Benchmark decontamination with DataFrame functions only.

The windows of the test items (ten consecutive words, or a whole shorter item)
are broken into chunks of half a window; the chunks' hash set is broadcast when
its counted size allows and joined by shuffle otherwise. A text is scanned in
one pass: of its words only the chunks that start at multiples of the chunk
length are hashed and looked up, because any occurrence of a window holds one
of them whole. A chunk hit names the windows that may lie around it; each is
verified word by word in the document's own row, so neither a hash collision nor
the coarser letter case of the look-up marks a word. Hit words and items are
folded inside the row; the document text is shuffled once.

Rules: A-Z are lower-cased, a word is a run of characters other than the ASCII
non-alphanumerics; null texts have no words and are never hit; items without
words, or without an id, are ignored; repeated item ids count once, repeated
document rows each get the same result. Extra columns of any name are kept by
`remove_spans` and `drop_documents` and ignored by `report`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, stored

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
NOT_WORD = "".join(chr(c) for c in range(128) if not chr(c).isalnum())
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW = 10
#: Most bytes of window texts and ids that are broadcast.
BROADCAST_BYTES = 32 << 20


def words_of(text: Column) -> Column:
    """Normalised words of a text; an empty array for null. One character map
    lowers A-Z and turns every ASCII separator into a blank."""
    blanked = F.translate(F.coalesce(text, F.lit("")), UPPER + NOT_WORD, UPPER.lower() + " " * len(NOT_WORD))
    return F.array_remove(F.split(blanked, " "), "")


def coarse_lower(text: Column) -> Column:
    """Every letter lower-cased. The final sigma, which lower() chooses by the letters around it,
    becomes the common one, so that a word is the same whatever stands between it and the next."""
    return F.replace(F.lower(text), F.lit("ς"), F.lit("σ"))


def coarse_words(text: Column) -> Column:
    """The same words with every letter lower-cased: as many, at the same places,
    and equal wherever the normalised words are. Cheaper, for the look-up."""
    return F.array_remove(F.split(coarse_lower(text), SEPARATORS), "")


def chunk_hash(words: Column, place: Column, length: int | Column) -> Column:
    return F.xxhash64(F.lit(length) if isinstance(length, int) else length, F.slice(words, place, length))


def aligned_chunks(words: Column, length: int) -> Column:
    """(place from 1, chunk length, hash) of every chunk that starts at a multiple of its length."""
    places = F.when(F.size(words) >= length, F.sequence(F.lit(1), F.size(words) - (length - 1), F.lit(length)))
    return F.transform(F.coalesce(places, F.array().cast("array<int>")), lambda i: F.struct(
        i.alias("place"), F.lit(length).alias("chunk"), chunk_hash(words, i, length).alias("h")))


def chunk_table(benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """h, chunk, windows: for each chunk of an item window, the distinct windows that
    it may stand in (offset of the chunk, length, text, sorted ids as strings)."""
    items = (benchmark.select(F.col("item_id").cast("string").alias("item"), words_of(F.col("text")).alias("w"))
             .where(F.col("item").isNotNull() & (F.size("w") > 0))
             .withColumn("length", F.least(F.size("w"), F.lit(width))))
    windows = (items.select("item", "length", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("w") - F.col("length") + 1),
        lambda i: F.array_join(F.slice(F.col("w"), i, F.col("length")), " "))).alias("window"))
        .groupBy("length", "window").agg(F.sort_array(F.collect_set("item")).alias("items"))
        .withColumn("chunk", F.floor((F.col("length") + 1) / 2).cast("int"))
        .withColumn("lw", F.split(coarse_lower(F.col("window")), " ")))
    at = windows.select("*", F.explode(F.sequence(F.lit(0), F.col("chunk") - 1)).alias("off"))
    return (at.withColumn("h", chunk_hash(F.col("lw"), F.col("off") + 1, F.col("chunk")))
            .groupBy("h", "chunk").agg(F.collect_list(F.struct("off", "length", "window", "items")).alias("windows")))


def scan(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """docs' columns inside a struct `row`, with n_words, covered (places of hit words,
    sorted, from 0) and items (sorted ids with occurring windows)."""
    table = stored(chunk_table(benchmark, width), "windows")
    sizes = table.groupBy("chunk").agg(F.sum(F.aggregate("windows", F.lit(0).cast("long"), lambda n, x: (
        n + F.length(x["window"]) + 24 * F.size(x["items"]) + 32))).alias("n")).collect()
    chunks = sorted(r["chunk"] for r in sizes) or [(width + 1) // 2]
    held = F.broadcast(table) if sum(r["n"] for r in sizes) <= BROADCAST_BYTES else table

    base = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    base = base.withColumn("key", F.xxhash64("row.doc_id", "row.text"))
    seen = (base.where(F.col("row.text").isNotNull())
            .select("key", F.inline(let(coarse_words(F.col("row.text")), lambda w: F.concat(
                *[aligned_chunks(w, c) for c in chunks])))))
    hits = (seen.join(held, ["h", "chunk"])
            .groupBy("key").agg(F.collect_set(F.struct("place", "windows")).alias("hits")))

    text = F.col("row.text")
    joined = (base.join(hits, "key", "left")
              .withColumn("n", F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS), ""))))
    near = F.flatten(F.transform("hits", lambda x: F.transform(x["windows"], lambda y: F.struct(
        (x["place"] - y["off"]).alias("place"), y["length"].alias("length"),
        y["window"].alias("window"), y["items"].alias("items")))))
    sure = F.when(F.col("hits").isNotNull(), let(words_of(text), lambda w: F.filter(near, lambda x: (x["place"] > 0) & (
        F.array_join(F.slice(w, F.greatest(x["place"], F.lit(1)), x["length"]), " ") == x["window"]))))
    folded = joined.select("row", "n", sure.alias("sure"))
    covered = F.array_sort(F.array_distinct(F.flatten(F.transform(
        "sure", lambda x: F.sequence(x["place"] - 1, x["place"] + x["length"] - 2)))))
    return folded.select(
        "row", F.col("n").cast("long").alias("n_words"),
        F.coalesce(covered, F.array().cast("array<int>")).alias("covered"),
        F.coalesce(F.sort_array(F.array_distinct(F.flatten(F.col("sure.items")))),
                   F.array().cast("array<string>")).alias("items"))


def report(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """Per document row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    return scan(docs, benchmark, width).select(
        F.col("row.doc_id").alias("doc_id"), "n_words", F.size("covered").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("covered") > 0).alias("contaminated"))


def drop_documents(docs: DataFrame, benchmark: DataFrame, max_share: float = 0.0, width: int = WINDOW) -> DataFrame:
    """Documents whose hit words are at most `max_share` of their words, columns unchanged."""
    share = F.when(F.col("n_words") > 0, F.size("covered") / F.col("n_words")).otherwise(F.lit(0.0))
    return scan(docs, benchmark, width).where(share <= max_share).select("row.*")


def remove_spans(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """Documents with every hit word taken out of the text, together with the
    separators that follow it up to the next word; other characters stay as they are.
    Columns unchanged; texts without a hit are returned as they were."""
    out = scan(docs, benchmark, width)
    # alternate runs of words and separators: the i-th word starts the i-th piece
    sep = r"[\x00-\x2F\x3A-\x60\x7B-\x7F&&[^A-Z]]"
    parts = F.regexp_extract_all("row.text", F.lit(f"[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+{sep}*"), F.lit(0))
    lead = F.regexp_extract("row.text", f"^{sep}+", 0)
    kept_places = F.array_except(F.sequence(F.lit(0), F.col("n_words").cast("int") - 1), F.col("covered"))
    kept = F.concat(lead, let(parts, lambda p: F.array_join(F.transform(kept_places, lambda i: F.get(p, i)), "")))
    text = F.when(F.size("covered") > 0, kept).otherwise(F.col("row.text"))
    names = docs.columns
    return (out.withColumn("_clean", text)
            .select(*[F.col("_clean").alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in names]))
