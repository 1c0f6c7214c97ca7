"""Near-duplicate groups by MinHash with tensored banding.

Each document's distinct word shingles give `COLLECTIONS` small collections of
`ROWS` minhashes. A table key joins two collections, so 20 collections of 3 make
190 tables of 6 minhashes from only 60 minhash functions. At a similarity of 0.8 a
pair misses every table with probability 1.2e-5, and far less above.

Scale: equal shingle sets collapse into one node first. A collection value that a
node shares with no other cannot make a shared key, so only nodes with two shared
values write keys. A bucket's members are compared with its hub (the member whose
collection values are the most frequent), not with each other; links are confirmed on the
full sets. Where a bucket still holds several components, its nodes go through an
exact prefix join (rarest shingles first, with size and place bounds) across
components, so no link between them is lost. Components come from minimum labels with
pointer jumps. All intermediates are written to the shared folder.

Rules: words are runs of bytes other than ASCII white space, A-Z lower-cased; fewer
words than a shingle make one shingle; null and blank texts have an empty set and are
linked with nothing. Equal documents share a component. The component is the
smallest non-null id reached; a null id is never the label unless all are null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mix, shingle_hashes, stored, word_hashes, word_spans

COLLECTIONS = 20
ROWS = 3
SHINGLE = 4
#: A link: 100 * intersection >= PERCENT * union.
PERCENT = 80


def shingle_set(text: str | None, k: int = SHINGLE) -> np.ndarray:
    """Sorted 64-bit hashes of a text's distinct word shingles."""
    buf = np.frombuffer((text or "").encode("utf-8", "surrogatepass").lower(), np.uint8)
    return np.unique(shingle_hashes(word_hashes(buf, *word_spans(buf)), k))


def word_shingles(text: str | None, k: int = SHINGLE) -> set[tuple[bytes, ...]]:
    """The same set as words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return set(zip(*[words[i:] for i in range(k)])) if len(words) >= k else ({tuple(words)} if words else set())


def set_digest(text: str, shingles: np.ndarray) -> bytes:
    """Equal for equal sets. The distinct words go in as they are, so texts of other words never meet."""
    words = sorted(set(text.encode("utf-8", "surrogatepass").lower().split()))
    return hashlib.md5(shingles.tobytes() + b"\n".join(words)).digest()


_rng = np.random.default_rng(11)
_A = _rng.integers(1, 2**63, COLLECTIONS * ROWS, dtype=np.uint64) | np.uint64(1)
_B = _rng.integers(0, 2**63, COLLECTIONS * ROWS, dtype=np.uint64)


def collections_of(shingles: np.ndarray) -> np.ndarray:
    """One 64-bit value per collection of minhashes; the collection's number is mixed in."""
    low = np.full(len(_A), np.uint64(2**64 - 1))
    for s in range(0, len(shingles), 2048):
        part = shingles[s:s + 2048]
        x = part[None, :] * _A[:, None] + _B[:, None]
        x ^= x >> np.uint64(32)
        low = np.minimum(low, x.min(axis=1))
    out = np.arange(COLLECTIONS, dtype=np.uint64)
    for r in range(ROWS):
        out = mix(out * np.uint64(0x100000001B3) + low[r::ROWS])
    return out


def signatures(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """doc_id, text_hash, n_shingles, set_id (digest of the set, null when empty), sig."""
    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sizes, ids, sigs = [], [], []
            for text in pdf["text"]:
                s = shingle_set(text if isinstance(text, str) else None, k)
                sizes.append(len(s))
                ids.append(set_digest(text, s) if len(s) else None)
                sigs.append(collections_of(s).astype(np.int64) if len(s) else None)
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "text_hash": pdf["text_hash"],
                                "n_shingles": sizes, "set_id": ids, "sig": sigs})

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
            .mapInPandas(sign, "doc_id long, text_hash long, n_shingles long, set_id binary, sig array<long>"))


def similar(a: set, b: set, percent: int = PERCENT) -> bool:
    common = len(a & b)
    return 100 * common >= percent * (len(a) + len(b) - common) and common > 0


def confirm(pairs: DataFrame, texts: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Of pairs (a, b), those whose full sets of shingles, compared as words, are similar enough. b
    may be a hub with many partners; only that side of the join is skewed."""
    joined = (pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
              .join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"))

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, held = None, None
        for pdf in batches:
            keep = np.zeros(len(pdf), bool)
            for i, (b, ta, tb) in enumerate(zip(pdf["b"], pdf["text_a"], pdf["text_b"], strict=True)):
                if b != last:
                    last, held = b, word_shingles(tb, k)
                keep[i] = similar(word_shingles(ta, k), held, percent)
            yield pdf.loc[keep, ["a", "b"]]

    return joined.select("a", "b", "text_a", "text_b").mapInPandas(check, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """node, comp (smallest node reached) for every node with a link."""
    ends = stored(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = stored(ends.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("comp")), "labels")
    while True:
        reach = (ends.join(labels, ends["b"] == labels["node"]).groupBy("a").agg(F.min("comp").alias("low")))
        step = (labels.join(reach, labels["node"] == reach["a"])
                .select("node", F.col("comp").alias("was"), F.least("comp", "low").alias("comp")))
        over = labels.select(F.col("node").alias("comp"), F.col("comp").alias("next"))
        new = stored(step.join(over, "comp").select("node", "was", F.least("comp", "next").alias("comp")), "labels")
        labels = new.select("node", "comp")
        if new.where(F.col("was") != F.col("comp")).isEmpty():
            return labels


def possible(n_a: Column, n_b: Column, percent: int = PERCENT) -> Column:
    """Set sizes that allow the similarity at all."""
    return F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * percent


def table_keys(shared: DataFrame) -> DataFrame:
    """node, n, pop, key: one key per pair of the node's shared collection values."""
    keys = F.flatten(F.transform("vals", lambda x, i: F.transform(
        F.slice(F.col("vals"), i + 2, F.size("vals")), lambda y: F.xxhash64(x, y))))
    return shared.select("node", "n", "pop", F.explode(keys).alias("key"))


def prefix_pairs(nodes: DataFrame, texts: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Exact candidates across components among nodes (node, comp): pairs that share a
    shingle within the prefixes that a similar pair must share one in."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sets = [shingle_set(t, k).astype(np.int64) for t in pdf["text"]]
            yield pd.DataFrame({"node": pdf["node"], "comp": pdf["comp"], "n": [len(s) for s in sets], "sh": sets})

    sets = (texts.join(nodes, "node").select("node", "comp", "text")
            .mapInPandas(cut, "node long, comp long, n long, sh array<long>"))
    each = sets.select("node", "comp", "n", F.explode("sh").alias("s"))
    often = stored(each.groupBy("s").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "frequent")
    # shingles of a single node match nothing, but they come first and so take up the prefix
    ranked = (each.join(often, "s").groupBy("node", "comp", "n")
              .agg(F.sort_array(F.collect_list(F.struct("df", "s"))).alias("r")))
    need = F.ceil(F.col("n") * percent / 100)
    own = F.col("n") - F.size("r")
    prefix = stored(ranked.withColumn("take", F.greatest(F.col("n") - need + 1 - own, F.lit(0)).cast("int"))
                    .select("node", "comp", "n", F.posexplode(F.slice("r", 1, F.col("take"))).alias("i", "x"),
                            own.alias("own"))
                    .select("node", "comp", "n", (F.col("n") - F.col("own") - F.col("i")).alias("rest"),
                            F.col("x.s").alias("s")), "prefix")
    a = prefix.select("s", *[F.col(c).alias(f"{c}_a") for c in ("node", "comp", "n", "rest")])
    b = prefix.select("s", *[F.col(c).alias(f"{c}_b") for c in ("node", "comp", "n", "rest")])
    # the overlap cannot exceed what either ranking holds from the shared shingle on
    enough = F.least("rest_a", "rest_b") * (100 + percent) >= (F.col("n_a") + F.col("n_b")) * percent
    return (a.join(b, "s").where((F.col("node_a") < F.col("node_b")) & (F.col("comp_a") != F.col("comp_b"))
                                 & possible(F.col("n_a"), F.col("n_b"), percent) & enough)
            .select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct())


def groups(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id, kept for every row of docs
    (doc_id, text; other columns are ignored), and `node`, which names the component also where all its
    ids are null (null for an empty set)."""
    rows = stored(signatures(docs, k), "signatures")
    classes = stored(rows.where("set_id is not null").groupBy("set_id").agg(
        F.min("doc_id").alias("low"), F.min(F.struct("doc_id", "text_hash")).alias("rep"),
        F.first("n_shingles").alias("n"), F.first("sig").alias("sig"))
        .withColumn("node", F.monotonically_increasing_id()), "classes")

    values = classes.select("node", "n", F.explode("sig").alias("v"))
    twice = stored(values.groupBy("v").agg(F.count(F.lit(1)).alias("times")).where("times > 1"), "values")
    shared = stored(values.join(twice, "v").groupBy("node", "n").agg(
        F.sort_array(F.collect_list("v")).alias("vals"), F.sum("times").alias("pop"))
        .where(F.size("vals") > 1), "shared")

    keys = table_keys(shared)
    hubs = stored(keys.groupBy("key").agg(
        F.max(F.struct("pop", (-F.col("node")).alias("last"), F.col("n").alias("hub_n"))).alias("top"), F.count(F.lit(1)).alias("size"))
        .where("size > 1").select("key", (-F.col("top.last")).alias("hub"), F.col("top.hub_n").alias("hub_n")), "hubs")
    star = (keys.join(hubs, "key").where((F.col("node") != F.col("hub")) & possible(F.col("n"), F.col("hub_n"), percent))
            .select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct())

    wanted = classes.join(shared.select("node"), "node", "left_semi").select(
        "node", F.col("rep.doc_id").alias("_id"), F.col("rep.text_hash").alias("_hash"))
    source = docs.select(F.col("doc_id").cast("long").alias("_id"), F.xxhash64("text").alias("_hash"), "text")
    texts = stored(source.where("text is not null").join(
        wanted, source["_id"].eqNullSafe(wanted["_id"]) & (source["_hash"] == wanted["_hash"]))
        .groupBy("node").agg(F.first("text").alias("text")), "texts")

    links = stored(confirm(star, texts, k, percent), "confirmed")
    comps = components(links)
    placed = shared.select("node").join(comps, "node", "left").select(
        "node", F.coalesce("comp", "node").alias("comp"))
    placed = stored(placed, "placed")
    member = keys.join(placed, "node")
    split = member.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("key")
    open_nodes = stored(member.join(stored(split, "split"), "key", "left_semi").select("node", "comp").distinct(), "open")
    more = confirm(prefix_pairs(open_nodes, texts, k, percent), texts, k, percent)
    all_links = stored(links.unionByName(more), "confirmed")
    comps = components(all_links)

    labelled = classes.join(comps, "node", "left").select(
        "set_id", "low", F.coalesce("comp", "node").alias("comp"))
    lows = stored(labelled.groupBy("comp").agg(F.min("low").alias("component_id")), "lows")
    named = stored(labelled.join(lows, "comp").select("set_id", "component_id", F.col("comp").alias("node")), "named")
    out = rows.select("doc_id", "text_hash", "n_shingles", "set_id").join(named, "set_id", "left")
    comp = F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "text_hash", "n_shingles", comp.alias("component_id"),
                      F.col("doc_id").eqNullSafe(comp).alias("kept"), "node")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every document row."""
    return groups(docs).select("doc_id", "n_shingles", "component_id", "kept")


def drop_copies(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row of each group, columns unchanged: that of the smallest id (a null id after all others), of equal ids that
    of the smallest hash of its text, of equal rows any. Texts without a word are in no group: they stay, one
    row for each id and text."""
    marked = groups(docs, k, percent).select("node", F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "hash")).alias("m")
    kept = stored(marked.where("node is not null").groupBy("node").agg(first).select("m.id", "m.hash").unionByName(
        marked.where("node is null").select("id", "hash")).distinct(), "kept")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col("doc_id").cast("long").alias("row_id"), F.xxhash64("text").alias("row_hash"))
    same = rows["row_id"].eqNullSafe(kept["id"]) & (rows["row_hash"] == kept["hash"])
    return rows.join(kept, same).dropDuplicates(["row_id", "row_hash"]).select("row.*")
