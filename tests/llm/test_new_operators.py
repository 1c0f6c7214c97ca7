"""Collocations, retrieval packing and clustering against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from aspectra.llm import clustering, retrieval_packing
from aspectra.session import ship_package

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


# ------------------------------------------------------------ clustering

def brute_clusters(rows, k=40, rounds=5):
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    centroids = [v for _, v in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        centroids = [[sum(x) // len(groups[j]) for x in zip(*groups[j])] if j in groups else c for j, c in enumerate(centroids)]
    out = [(i, *nearest(v)) for i, v in kept]
    inertia = defaultdict(int)
    for _, d, j in out:
        inertia[j] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    long = lambda n: n if n < 1 << 63 else None
    return Counter((i, j, long(d), long(inertia[j]), long(sum(inertia.values())), digest[j]) for i, d, j in out)


def clustered(spark, rows):
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, cluster string, _v int")
    return Counter(tuple(r) for r in clustering.cluster(df.repartition(3)).collect())


def test_clusters_equal_plain_search(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 64))
    rows = [(i, (centres[i % 6] + rng.normal(scale=.3, size=64)).tolist()) for i in range(300)]
    rows += [(7, rows[7][1]), (None, rows[8][1]), (1000, None), (1001, []), (1002, [0.5] * 63), (1003, [None] + [0.5] * 63),
             (1004, [float("nan")] * 64), (1005, [float("-inf")] * 64), (1006, [0.0] * 64), (1007, [-0.0] * 64), (7, [0.25] * 64)]
    rows += [(2000 + i, [0.125] * 64) for i in range(150)]  # a third of all rows are one vector
    assert clustered(spark, rows) == brute_clusters(rows)


def test_clusters_of_few_and_of_huge_vectors(spark):
    rng = np.random.default_rng(4)
    few = [(i, rng.normal(size=64).tolist()) for i in range(5)]
    assert clustered(spark, few) == brute_clusters(few)
    huge = few + [(10, [3e38] * 64), (11, [1e12, -1e12] * 32), (12, [float(2**30)] * 64)]
    assert clustered(spark, huge) == brute_clusters(huge)
    assert clustered(spark, []) == clustered(spark, [(None, [1.0] * 64)]) == Counter()


def test_progressive_search_equals_all_distances():
    rng = np.random.default_rng(5)
    x, c = rng.integers(-300, 300, (2000, 64)), rng.integers(-300, 300, (40, 64))
    c[7] = c[3]  # equal centroids: the smaller number
    x[:500] = c[rng.integers(0, 40, 500)] + rng.integers(-2, 3, (500, 64))
    all_distances = ((x[:, None] - c[None]) ** 2).sum(axis=2)
    number, distance = clustering.nearest(x, c)
    assert (number == all_distances.argmin(axis=1)).all() and (distance == all_distances.min(axis=1)).all()
    assert (clustering.nearest(x.astype(object), c)[1] == distance).all()


# ------------------------------------------------------------ retrieval packing

def test_retrieval_packing_is_whole(spark):
    tokenizers = pytest.importorskip("tokenizers")
    path = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
    texts = [None, "", "Hello, world. It's 3.5!", "word " * 5000, "a\tb <|endoftext|> c"] + ["some words here. " * k for k in range(1, 150)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOCS).repartition(3)
    docs = docs.withColumnRenamed("n_chars", "ids")
    extra = docs.where("doc_id = 2").unionByName(docs.where("doc_id = 3").withColumn("doc_id", docs["doc_id"] * 0 - 1))
    tok = tokenizers.Tokenizer.from_file(path)
    want = {i: np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for i, t in enumerate(texts)}
    want[-1] = want[3]
    for limits in ({}, {"shard_docs": 7}, {"shard_tokens": 3000}):
        rows = retrieval_packing.pack(docs.unionByName(extra), path, with_ids=True, **limits).collect()
        places, sequences = Counter(), defaultdict(list)
        for r in rows:
            part = want[r["doc_id"]][r["start"]:r["start"] + r["length"]]
            assert bytes(r["ids"]) == part.tobytes() and zlib.crc32(part.tobytes()) == r["ids_crc32"]
            assert r["length"] == len(part) > 0 and r["doc_tokens"] == len(want[r["doc_id"]])
            places.update((r["doc_id"], p) for p in range(r["start"], r["start"] + r["length"]))
            sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        assert places == Counter((i, p) for i, ids in want.items() for p in range(len(ids)) for _ in range(2 if i == 2 else 1))
        for parts in sequences.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= 4096 and at & (at - 1) == 0  # full, or a power of two: no padding
    assert retrieval_packing.pack(docs.limit(0), path).collect() == []


def test_windows_gather_texts_of_one_subject(spark):
    path = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
    rng = np.random.default_rng(6)
    subjects = [["river", "boat", "fish", "water", "bridge"], ["engine", "wheel", "brake", "road", "fuel"],
                ["violin", "tune", "choir", "drum", "song"], ["bread", "oven", "flour", "sugar", "butter"]]
    rows = [(i, " ".join(rng.choice(subjects[i % 4] + ["the", "of", "and"], 200)), "en", "s", 0) for i in range(160)]
    packed = retrieval_packing.pack(spark.createDataFrame(rows, DOCS).coalesce(1), path, window=1024).collect()
    windows = defaultdict(list)
    for r in packed:
        windows[r["sequence_id"]].append(r["doc_id"] % 4)
    together = np.mean([max(Counter(w).values()) / len(w) for w in windows.values()])
    assert together > 0.9  # in order of arrival it would be about a quarter


def test_bm25_weights_equal_the_formula():
    docs = [[1, 1, 2], [2, 3], [3, 3, 3, 4], [5]]
    size = np.array([len(d) for d in docs])
    df = Counter(t for d in docs for t in set(d))
    idf = np.array([np.log1p((4 - df[t] + .5) / (df[t] + .5)) for t in range(6)])
    got = retrieval_packing.Index(np.array([t for d in docs for t in d]), size, idf, size.mean()).scores(0)
    want = [sum(idf[t] * d.count(t) * 2.2 / (d.count(t) + 1.2 * (.25 + .75 * len(d) / size.mean())) for t in {1, 2} if t in d) for d in docs]
    assert np.allclose(got, want)


# ------------------------------------------------------------ collocations

def brute_collocations(rows, support, top):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f[lang].update(tuple(w[i:i + k]) for k in (1, 2, 3, 4) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= support}
        rows_ = []
        for p, a in found.items():
            if any(len(q) > len(p) and 100 * b >= 80 * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                   for q, b in found.items()):
                continue
            score, _, left, right = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]])
                                        for k in range(1, len(p)))
            rows_.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(rows_)[:top])]
    return sorted(out)


def collocation_rows(seed=11, many=400):
    rng = np.random.default_rng(seed)
    words = ["the", "of", "New", "York", "San", "José", "city", "a\x00b", "ß", "naïve", "一", "x" * 300, "to", "be", "or", "not"]
    rows = []
    for i in range(many):
        text = " ".join(rng.choice(words, rng.integers(1, 40), p=[.2] + [.8 / 15] * 15))
        rows.append((["en", "de", None, "und", ""][i % 5], text.replace("city", "city" + " ,;\n\t"[i % 5]) + " in New  York\tcity hall."))
    return rows + [("en", None), ("en", ""), ("xx", "only once here"), (None, " ., \n"), ("en", "to be or not " * 3000)] + [rows[0]] * 150


@pytest.mark.parametrize(("support", "top", "shards"), [(30, 2000, 8), (7, 12, 3), (2, 2000, 40), (1, 5, 1)])
def test_collocations_equal_full_counts(spark, support, top, shards):
    from aspectra.llm.collocations import collocations

    rows = collocation_rows(many=400 if support > 2 else 60)
    df = spark.createDataFrame([(i % 7 or None, t, lang, 1, "a", 2) for i, (lang, t) in enumerate(rows)],
                               "doc_id long, text string, lang string, shard int, phrase string, k int").repartition(5)
    got = sorted(tuple(r) for r in collocations(df, support, top, shards).collect())
    assert got == brute_collocations(rows, support, top)


def test_collocations_of_a_batch_of_several_blocks(spark):
    from aspectra.llm.collocations import BLOCK, collocations

    long = "New York City " + "Ab" * (BLOCK // 80)
    rows = [("en", long)] * 100 + collocation_rows()[:200] + [("en", long)] * 50 + [("de", "São Paulo, " * 40)]
    df = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string").coalesce(1)
    assert sorted(tuple(r) for r in collocations(df, 30).collect()) == brute_collocations(rows, 30, 2000)


@pytest.mark.parametrize("nulls", [False, True])
def test_blocks_of_a_batch_hold_its_words(monkeypatch, nulls):
    from aspectra.llm import collocations as C

    monkeypatch.setattr(C, "BLOCK", 40)
    texts = [f"Éa {i} HAT, Straße" for i in range(50)] + [None] * nulls + ["", "Z" * 90, "last ONE"]
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * len(texts), "text": texts}).slice(3)
    blocks = [block for block, _, _ in C._blocks([batch], ["lang"])]
    assert len(blocks) > 20
    got = [block.raw[i:j].tobytes().decode() for block in blocks for i, j in zip(block.start, block.end, strict=True)]
    assert got == [w for t in texts[3:] for w in (t or "").replace(",", "").encode().lower().decode().split()]


def test_collocations_of_nothing(spark):
    from aspectra.llm.collocations import collocations

    for rows in ([], [(None, None, None)], [(1, ". , ;", "en")]):
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        assert collocations(df, 1).collect() == []


def test_the_bit_map_has_its_stated_size(spark, monkeypatch):
    """Its parts come from Spark; only FILTER_BITS bits reach the driver."""
    from aspectra.llm import collocations as C

    monkeypatch.setattr(C, "FILTER_BITS", 1 << 15)
    rows = collocation_rows(12, 100)
    short = C.union_filter(C.mined(spark.createDataFrame([("en", 0, t) for _, t in rows], "lang string, shard int, text string")
                                   .where("text is not null"), (1, 2)),
                           spark.createDataFrame([("en", 0, 10, 10)], "lang string, shard int, n long, total long"), 1)
    assert len(short) == 4096 and any(short)


def test_the_bit_map_is_the_same_in_any_parts_and_loses_nothing(spark, monkeypatch):
    from aspectra.llm import collocations as C

    monkeypatch.setattr(C, "FILTER_BITS", 1 << 18)
    rows = [(lang or "und", i % 3, t) for i, (lang, t) in enumerate(collocation_rows(13, 150)) if t]
    docs = spark.createDataFrame(rows, "lang string, shard int, text string").repartition(3).persist()
    f, n = defaultdict(Counter), Counter()
    batch = pa.RecordBatch.from_pydict({"lang": [r[0] for r in rows], "shard": [r[1] for r in rows], "text": [r[2] for r in rows]})
    for block, groups, language in C._blocks([batch], ["lang", "shard"]):
        n.update(groups[g] for g in block.group)
        for k in (1, 2):
            at = block.inside(k)
            for g, h in zip(block.group[at], block.hashes(k, at, language), strict=True):
                f[groups[g]][int(h)] += 1
    total = Counter()
    for (lang, _), many in n.items():
        total[lang] += many
    shares = spark.createDataFrame([(*g, many, total[g[0]]) for g, many in n.items()], "lang string, shard int, n long, total long")
    want = {h % C.FILTER_BITS for g, counts in f.items() for h, many in counts.items() if many >= -(-20 * n[g] // total[g[0]])}
    seen = {h % C.FILTER_BITS for counts in f.values() for h in counts}

    def bits(parts):
        made = C.union_filter(C.mined(docs, (1, 2), parts=parts), shares, 20, parts)
        return set(np.flatnonzero(np.unpackbits(np.frombuffer(made, np.uint8), bitorder="little")).tolist())

    assert 0 < len(want) < len(seen) and bits(1) == bits(64) == want
    monkeypatch.setattr(C, "KNOWN", 2)
    assert want < bits(16) <= seen


def test_parts_grow_with_the_words():
    from aspectra.llm import collocations as C

    assert C.parts_for(0) == C.parts_for(16 * C.ENTRIES) == C.PARTS
    assert [C.parts_for(x * C.ENTRIES) for x in (17, 32, 33)] == [32, 32, 64]
    assert C.parts_for(1 << 60) == C.FILTER_BITS // 8


# ------------------------------------------------------------ licence scan of long texts

def test_many_notices_in_one_text_are_scanned_in_proportion():
    import time

    from aspectra.llm import licenses

    index = licenses.Index()
    took = []
    for many in (10_000, 80_000):
        text = "MIT License. " * many
        begin = time.perf_counter()
        found = index.scan(text)
        took.append(time.perf_counter() - begin)
        assert [r[0] for r in found] == ["MIT"] * many and [r[2] for r in found[:3]] == [0, 13, 26]
    assert took[1] < 24 * took[0]  # eight times the text; finds compared with each other would take 64 times as long


def test_alignment_equals_a_plain_table():
    """The banded alignment against the best over all cells, where the band holds every path."""
    from aspectra.llm import licenses

    rng = np.random.default_rng(1)
    for _ in range(60):
        a, b = rng.integers(0, 4, rng.integers(1, 9)).tolist(), rng.integers(0, 4, rng.integers(1, 12)).tolist()
        best = 0
        score = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                score[i, j] = max(0, score[i - 1, j - 1] + (2 if a[i - 1] == b[j - 1] else -1), score[i - 1, j] - 1, score[i, j - 1] - 1)
                best = max(best, score[i, j])
        hits, put, first, last = licenses.align(a, b, 0, band=20)
        common = licenses.common(a, b[first:last]) if last > first else 0
        assert (best > 0) == (hits > 0) and hits <= common and 0 <= first <= last <= len(b)
        if best:
            assert b[first] in a and b[last - 1] in a  # a find begins and ends with words in common
