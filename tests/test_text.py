"""Python parity of the JVM text functions (F2-F7) on edge text."""
import re

import pytest
from pyspark.sql import functions as F

from aspectra.functions import text as tx

EDGE = [
    "Good price, FAST shipping!!",
    "Caf\u00e9 cr\u00e8me br\u00fbl\u00e9e \u2014 na\u00efve fa\u00e7ade",
    "e\u0301cole combining mark",                 # combining acute accent
    "x\u00b2 + y\u00b3 = z\u00b9",                      # superscripts
    "snake_case and __dunder__",
    "emoji \U0001F600 inside \U0001F44D\U0001F3FD text",
    "tabs\tand\nnewlines\r\nand\x0bvt\x0cff",
    "\x1cfile sep\x1d\x1e\x1f",
    "\xa0nbsp em\u2003ideographic\u3000",
    "digits 123 \u0663\u0664 mixed4you 2x",
    "\u00c0\u00c9\u00ce\u00d5\u00dc Stra\u00dfe",
    "",
    "   ",
    "\u00a1\u00bfQu\u00e9?! \u00abguillemets\u00bb \u201cquotes\u201d",
]


def py_tokens(t):
    return re.findall(r"\w+", t.lower())


def py_clean(t):
    t = t.lower()
    t = re.sub(r"[^\w\s]", "", t)
    t = re.sub(r"\d+", "", t)
    return t.strip()


@pytest.fixture(scope="module")
def edge_df(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(EDGE)] + [(len(EDGE), None)], "i INT, t STRING")


def test_tokens_match_python(edge_df):
    rows = edge_df.select("i", "t", tx.tokens("t").alias("k")).collect()
    for r in rows:
        if r.t is None:
            assert r.k is None
        else:
            assert r.k == py_tokens(r.t), r.t


def test_clean_matches_python(edge_df):
    rows = edge_df.select("i", "t", tx.clean_text("t").alias("c")).collect()
    for r in rows:
        if r.t is None:
            assert r.c is None
        else:
            assert r.c == py_clean(r.t), repr(r.t)


@pytest.mark.parametrize("n", [0, 64, 65, 100, 101])
def test_cut_and_pad(spark, n):
    df = spark.createDataFrame([(list(range(1, n + 1)),)], "ids ARRAY<INT>")
    head = df.select(tx.pad(tx.cut(F.col("ids"), 64, "head"), 64).alias("x")).first().x
    tail = df.select(tx.pad(tx.cut(F.col("ids"), 100, "tail"), 100).alias("x")).first().x
    ids = list(range(1, n + 1))
    assert head == (ids[:64] + [0] * 64)[:64]
    kept = ids[-100:] if n > 100 else ids
    assert tail == kept + [0] * (100 - len(kept))


def test_token_ids_unknown_and_null(spark):
    df = spark.createDataFrame([(1, "a b zz a"), (2, None), (3, "")], "k INT, t STRING")
    vocab = spark.createDataFrame([("a", 2), ("b", 3)], "token STRING, id INT")
    out = {r.k: r.ids for r in tx.token_ids(df, "k", "t", vocab, max_len=6).collect()}
    assert out[1] == [2, 3, 1, 2, 0, 0]
    assert out[2] is None
    assert out[3] == [0] * 6


def test_vocabulary_order(spark):
    df = spark.createDataFrame([("b a a c c",), ("b",)], "t STRING")
    v = {r.token: r.id for r in tx.build_vocabulary(df, "t", size=2).collect()}
    assert v == {"a": 2, "b": 3}  # counts tie at 2: token order decides; 'c' cut by size


@pytest.mark.parametrize("table,col", [("documents", "text"), ("conversations", "text"), ("benchmark", "text")])
def test_parity_on_whole_fixture_texts(spark, table, col):
    df = spark.read.parquet(f"/root/testdata/sf0.001/{table}.parquet").select(col)
    rows = df.select(col, tx.tokens(col).alias("k"), tx.clean_text(col).alias("c")).collect()
    assert rows
    for r in rows:
        if r[col] is None:
            continue
        assert r.k == py_tokens(r[col])
        assert r.c == py_clean(r[col])


def test_token_ids_drop_oov_then_tail(spark):
    df = spark.createDataFrame([(1, "zz a b zz c a")], "k INT, t STRING")
    vocab = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "token STRING, id INT")
    out = tx.token_ids(df, "k", "t", vocab, max_len=3, truncate="tail", oov="drop").first()
    assert out.ids == [2, 3, 1]      # zz dropped, last three known ids kept


def test_token_ids_keep_repeated_keys_and_agree_beyond_the_broadcast(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "c zz a"), (2, None), (None, ""), (3, "zz b c a")], "k INT, t STRING")
    vocab = spark.createDataFrame([("a", 2), ("b", 3), ("c", 4)], "token STRING, id INT")
    for oov in ("unk", "drop"):
        for side in ("head", "tail"):
            held = tx.token_ids(df, "k", "t", vocab, max_len=2, truncate=side, oov=oov)
            joined = tx.token_ids(df, "k", "t", vocab, max_len=2, truncate=side, oov=oov, max_vocab=2)
            rows = sorted(map(str, held.collect()))
            assert len(rows) == 5 and rows == sorted(map(str, joined.collect()))
            assert "Exchange" not in held._jdf.queryExecution().executedPlan().toString()


def test_only_tokens_beyond_the_held_ones_are_joined(spark, monkeypatch):
    """Of a vocabulary too large to hold, the lowest ids are looked up in the row; what the cut cannot reach is not joined."""
    texts = [" ".join(f"w{(i * 7 + j * j) % 40}" if j % 3 else f"x{j}" for j in range(60)) for i in range(30)] + ["w1", "x1 x2", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "k INT, t STRING").repartition(3)
    entries = [(f"w{i}", i + 2) for i in range(40)] + [("w3", 90), ("w39", 80)]
    vocab = spark.createDataFrame(entries, "token STRING, id INT")
    ids = {}
    for token, i in entries:
        ids[token] = min(i, ids.get(token, i))
    joined = []
    split_join = tx.split_join
    monkeypatch.setattr(tx, "split_join", lambda rows, *rest: joined.append(rows.count()) or split_join(rows, *rest))
    for oov in ("unk", "drop"):
        for side in ("head", "tail"):
            got = tx.token_ids(df, "k", "t", vocab, max_len=10, truncate=side, oov=oov, max_vocab=30)
            for r in got.collect():
                if texts[r.k] is None:
                    assert r.ids is None
                    continue
                words = texts[r.k].split()
                if oov == "drop":
                    words = [w for w in words if w in ids]
                words = words[:10] if side == "head" else words[-10:]
                assert r.ids == [ids.get(w, 1) for w in words] + [0] * (10 - len(words)), (r.k, oov, side)
    assert len(joined) == 4 and max(joined) < 30 * 15  # of 30 * 60 tokens


def test_whole_vocabulary_is_numbered_in_order(spark):
    n = 6000
    df = spark.range(n).selectExpr("concat('w', id, ' w', id % 7) AS t").repartition(5)
    counts = {}
    for i in range(n):
        for w in (f"w{i}", f"w{i % 7}"):
            counts[w] = counts.get(w, 0) + 1
    want = {w: k + 2 for k, w in enumerate(sorted(counts, key=lambda w: (-counts[w], w)))}
    assert {r.token: r.id for r in tx.build_vocabulary(df, "t").collect()} == want
    assert tx.build_vocabulary(df.limit(0), "t").collect() == []


def test_registered_ids_know_every_word(spark):
    import __spark_entry__ as E

    for name in ("text_to_ids", "text_to_ids_tail"):
        rows = E.queries()[name](spark, "/root/testdata/sf0.001").collect()
        assert rows and not any("1" in r.ids.split(",") for r in rows if r.ids is not None)


def test_cnn_over_a_joined_vocabulary_equals_numpy(spark):
    import numpy as np

    from aspectra.operators.scoring import SeededEmbedding, WholeVocabularyCnn, cnn_forward, random_cnn_weights

    texts = ["a b c", None, "", "c " * 90, "zz a"]
    df = spark.createDataFrame(list(enumerate(texts)), "k INT, t STRING")
    vocab = tx.build_vocabulary(df.where("k < 4"), "t")
    ids = {r.token: r.id for r in vocab.collect()}
    weights = random_cnn_weights(2, 7) | {"embedding": SeededEmbedding(7)[np.arange(9)]}
    for held in (100, 1):
        got = {r.k: r.probs for r in WholeVocabularyCnn(spark, vocab, seed=7, max_vocab=held).score(df, "t", True).collect()}
        assert got[1] is None and len(got) == 5
        for k in (0, 2, 3, 4):
            own = np.zeros((1, 64), np.int64)
            seq = [ids.get(w, 1) for w in texts[k].split()][:64]
            own[0, :len(seq)] = seq
            assert np.allclose(got[k], cnn_forward(own, weights)[0], atol=1e-5)


def test_patterns_class_every_code_point_as_the_plain_ones(spark):
    """The classes are written for speed; they hold what WORD_CLASS, SPACE_CLASS and DIGIT_CLASS say."""
    points = spark.range(0x110000).where("id not between 55296 and 57343").select(
        F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32").alias("c"))
    text = F.concat(F.lit("a"), "c", F.lit("b"))
    low = F.lower(text)
    plain = F.trim(F.regexp_replace(low, f"(?:[^{tx.WORD_CLASS}{tx.SPACE_CLASS}]|{tx.DIGIT_CLASS})+", ""), F.lit(tx.SPACE_CHARS))
    words = F.regexp_extract_all(low, F.lit(f"([{tx.WORD_CLASS}]+)"), 1)
    found = points.agg(F.count(F.lit(1)).alias("n"), F.count_if(plain != tx.clean_text(text)).alias("clean"),
                       F.count_if(words != tx.tokens(text)).alias("words")).first()
    assert found.asDict() == {"n": 0x110000 - 2048, "clean": 0, "words": 0}
