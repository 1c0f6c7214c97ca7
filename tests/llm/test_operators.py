"""Small fixtures against brute force: nulls, empties, long texts, repeated rows, empty tables,
clashing extra columns."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from aspectra.llm import chat, decontaminate, langid, licenses, merkle, neardup, packing, quality, toxicity, warc
from aspectra.session import ship_package

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


def documents(spark, texts, lang="en"):
    rows = [(i if t != "NULLID" else None, t, lang, "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


PASSAGE = "alpha Beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
TEXTS = ["Before, " + PASSAGE + " after words here.", None, "", "É one two three!", PASSAGE.upper() + " " + PASSAGE,
         "alpha beta gamma", "one two three", "one  two\nthree four", "filler " * 4000 + PASSAGE, "one two three"]


def brute_hits(texts, items):
    out = {}
    for i, t in enumerate(texts):
        w, hit, found = words(t), set(), set()
        for item, it in items:
            iw = words(it)
            if item is None or not iw:
                continue
            n = min(10, len(iw))
            wins = {tuple(iw[j:j + n]) for j in range(len(iw) - n + 1)}
            for j in range(len(w) - n + 1):
                if tuple(w[j:j + n]) in wins:
                    hit.update(range(j, j + n))
                    found.add(str(item))
        ids = ",".join(sorted(found))
        out[i] = (len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit))
    return out


def test_decontamination_equals_brute_force(spark):
    items = [(1, PASSAGE), (10, "one two three"), (2, ""), (3, None), (None, "filler filler"), (4, "é"), (5, PASSAGE)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = documents(spark, TEXTS).withColumn("item", decontaminate.F.lit(1)).withColumn("hits", decontaminate.F.lit("x"))
    got = {r["doc_id"]: tuple(r)[1:] for r in decontaminate.report(docs, bench).collect()}
    assert got == brute_hits(TEXTS, items)
    clean = {r["doc_id"]: r["text"] for r in decontaminate.remove_spans(docs, bench).collect()}
    assert clean[0] == "Before, after words here." and clean[1] is None and clean[2] == "" and clean[4] == ""
    assert clean[5] == "alpha beta gamma" and clean[7] == "four" and clean[8] == "filler " * 4000
    assert {r["doc_id"] for r in decontaminate.drop_documents(docs, bench).collect()} == {1, 2, 5}
    assert decontaminate.remove_spans(docs, bench).columns == docs.columns
    none = decontaminate.report(docs, bench.limit(0)).collect()
    assert len(none) == len(TEXTS) and not any(r["contaminated"] for r in none)


def test_decontamination_meets_greek_capitals(spark):
    text = "ΟΔΟΣ.ΑΒΓ ΛΟΓΟΣ:ΔΕΖ ΝΟΜΟΣ'ΗΘΙ ΦΩΣ^ΚΛΜ ΠΑΣ`ΝΞΟ"
    items = [(1, text)]
    texts = [text, "ΟΔΟΣ ΑΒΓ ΛΟΓΟΣ ΔΕΖ ΝΟΜΟΣ ΗΘΙ ΦΩΣ ΚΛΜ ΠΑΣ ΝΞΟ", "οδος αβγ λογος δεζ νομος ηθι φως κλμ πας νξο"]
    got = {r["doc_id"]: tuple(r)[1:] for r in decontaminate.report(
        documents(spark, texts), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == brute_hits(texts, items) and got[0][-1] and got[1][-1] and not got[2][-1]


def shingles(text, k=4):
    w = (text or "").encode().lower().split()
    return {tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()


def test_near_duplicates_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    vocab = [f"w{i}" for i in range(500)]
    texts = [None, "", "  ", "short one", "Short ONE"]
    for _ in range(6):
        base = list(rng.choice(vocab, 80))
        for edits in range(8):
            t = list(base)
            for j in rng.choice(80, edits, replace=False):
                t[j] = f"x{rng.integers(10**6)}"
            texts.append(" ".join(t))
    texts += [texts[10], " ".join(rng.choice(vocab, 9000))]
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    want = {i: (len(sets[i]), find(i), find(i) == i) for i in range(len(texts))}
    docs = documents(spark, texts).withColumn("node", neardup.F.lit(1))
    got = {r["doc_id"]: tuple(r)[1:] for r in neardup.report(docs).collect()}
    assert got == want
    kept = neardup.drop_copies(docs.unionByName(docs))
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [i for i, w in want.items() if w[2]]
    assert neardup.report(docs.limit(0)).collect() == []


def test_word_hashes_tell_patterned_words_apart():
    """Words built so that polynomial hashes modulo 2^64 agree."""
    from aspectra.llm.common import word_hashes, word_spans

    word = "a"
    while len(word) < 1024:
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    buf = np.frombuffer(f"{word} {other}  {word} ab ba {'x' * 200} {'x' * 201}".encode(), np.uint8)
    got = word_hashes(buf, *word_spans(buf)).tolist()
    assert got[0] == got[2] and len(set(got)) == 6
    assert neardup.word_shingles(f"{word} b c d e") != neardup.word_shingles(f"{other} b c d e")


def test_one_row_of_each_group_stays(spark):
    """Null and repeated ids, equal rows, texts without words, columns of clashing names."""
    base = " ".join(f"w{i}" for i in range(60))
    near = [base + " x", base + " y", base + " z", base + " q"]
    other = " ".join(f"v{i}" for i in range(60))
    rows = [(None, near[0]), (None, near[1]), (7, near[2]), (7, near[3]), (None, other), (None, other + " k"), (9, None), (9, None),
            (9, ""), (None, " "), (None, " "), (3, "alone here"), (3, "alone here")]
    docs = spark.createDataFrame([(i, t, "h", "i", 5, "n") for i, t in rows],
                                 "doc_id long, text string, _h string, _id string, hash int, node string").repartition(3)
    kept = neardup.drop_copies(docs)
    assert kept.columns == docs.columns
    got = [tuple(r) for r in kept.collect()]
    assert all(r[2:] == ("h", "i", 5, "n") for r in got)
    texts = [(r[0], r[1]) for r in got]
    assert sum(t in near for _, t in texts) == 1 and next(i for i, t in texts if t in near) == 7
    assert sum(t in (other, other + " k") for _, t in texts) == 1
    rest = {(i, t) for i, t in texts if t not in (*near, other, other + " k")}
    assert rest == {(9, None), (9, ""), (None, " "), (3, "alone here")} and len(texts) == 6
    labels = {r["doc_id"]: r["component_id"] for r in neardup.report(docs).collect() if r["n_shingles"] and r["doc_id"] == 7}
    assert labels == {7: 7}


def test_packing_is_whole_and_gapless(spark):
    tokenizers = pytest.importorskip("tokenizers")
    path = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
    texts = [None, "", "Hello, world. It's 3.5!", "<|endoftext|> a\tb c", "word " * 5000] + ["some words here. " * k for k in range(1, 60)]
    docs = documents(spark, texts)
    rows = packing.pack(docs.unionByName(docs.where("doc_id = 2")), path).collect()
    tok = tokenizers.Tokenizer.from_file(path)
    seen, seqs = {}, {}
    for r in rows:
        ids = np.array([*tok.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids, 0], "<u4")
        part = ids[r["start"]:r["start"] + r["length"]]
        assert r["start"] == 2048 * r["piece"] and len(part) == r["length"] and zlib.crc32(part.tobytes()) == r["ids_crc32"]
        seen[r["doc_id"]] = seen.get(r["doc_id"], 0) + r["length"]
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert all(seen[i] == (2 if i == 2 else 1) * (len(tok.encode(t or "", add_special_tokens=False).ids) + 1)
               for i, t in enumerate(texts))
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(seqs) <= -(-sum(seen.values()) // 2048) + 2
    assert packing.pack(docs.limit(0), path).collect() == []


def test_plan_uses_every_piece_once():
    rng = np.random.default_rng(1)
    lengths = np.minimum(2048, rng.lognormal(6, 1, 50_000).astype(int) + 1)
    histogram = np.bincount(lengths, minlength=2049)
    room, used = {}, np.zeros(2049, int)
    for length, first, many, sequence, _ in packing.plan(histogram):
        used[length] += many
        for s in range(sequence, sequence + many):
            room[s] = room.get(s, 0) + length
    assert (used == histogram).all() and max(room.values()) <= 2048
    assert len(room) <= 1.01 * lengths.sum() / 2048


def test_chat_examples_hold_their_texts(spark):
    turns = [(1, i, "assistant" if i % 2 else "user", f"turn {i} <|im_end|>") for i in range(6)] + [(2, 0, "user", "alone")]
    rendered = chat.render(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    whole, want = "", []
    for r in rendered.where("conv_id = 1").orderBy("turn").collect():
        if r["reply_start"] is not None:
            end = r["reply_start"] + r["reply_chars"]
            want.append((r["turn"], whole + r["rendered"][:r["reply_start"]], r["rendered"][r["reply_start"]:end]))
        whole += r["rendered"]
    out = chat.expand(rendered)
    assert [tuple(r) for r in out.where("target is not null").orderBy("seq").select("seq", "context", "target").collect()] == want
    assert out.where("target is null and context is null").count() == 4
    kept = chat.written(out)
    assert kept.exceptAll(out).count() == 0 and kept.count() == out.count() == 7
    # what is read back comes from the stored texts
    other = out.withColumn("context", F.translate("context", "t", "T"))
    spelled = "".join(hashlib.sha256(c.replace("t", "T").encode()).hexdigest() for _, c, _ in want)
    got = {r["conv_id"]: r for r in chat.digests(chat.read_back(other)).collect()}
    assert got[1]["contexts_sha256"] == hashlib.sha256(spelled.encode()).hexdigest()
    with pytest.raises(Exception, match="code points"):
        chat.digests(chat.read_back(out.withColumn("context", F.substring("context", 2, 1 << 20)))).collect()


def test_chat_round_trip(spark):
    odd = "a <|im_end|> <\\|x <\\\\|im_start|>\nb"
    turns = [(1, 0, "user", odd), (1, 1, "assistant", odd), (1, 2, None, None), (1, 3, "assistant", ""), (2, 0, "r\\n\no|", "q"),
             (None, 0, "user", "n"), (3, None, "assistant", "first"), (3, 5, "user", "x"), (3, 5, "user", "x")]
    conv = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    out = chat.expand(chat.render(conv))
    back = sorted(((r["conv_id"], r["seq"], r["role"], r["text"], r["target"]) for r in chat.read_back(out).collect()), key=str)
    assert ((1, 0, "user", odd, None) in back and (1, 1, "assistant", odd, odd) in back and (1, 2, "", "", None) in back
            and (2, 0, "r\\n\no|", "q", None) in back and (3, 0, "assistant", "first", "first") in back and len(back) == 9)
    examples = {(r["conv_id"], r["seq"]): r for r in chat.context_texts(out).collect()}
    assert set(examples) == {(1, 1), (1, 3), (3, 0)}
    assert examples[1, 3]["context"].startswith(examples[1, 1]["context"] + examples[1, 1]["target"])
    got = {r["conv_id"]: r for r in chat.report(conv).collect()}
    for conv_id in (1, 3, 2):
        contexts = [examples[k]["context"] for k in sorted(examples) if k[0] == conv_id]
        spelled = "".join(hashlib.sha256(c.encode()).hexdigest() for c in contexts)
        assert got[conv_id]["n_examples"] == len(contexts)
        assert got[conv_id]["contexts_sha256"] == hashlib.sha256(spelled.encode()).hexdigest()
    wrong = out.withColumn("context_chars", out["context_chars"] + (out["seq"] == 3).cast("int"))
    with pytest.raises(Exception, match="code points"):
        chat.digests(chat.read_back(wrong)).collect()
    long = spark.createDataFrame([(1, i, "assistant" if i % 2 else "user", "word " * 2000) for i in range(300)], conv.schema)
    assert [(r["n_turns"], r["n_examples"]) for r in chat.report(long).collect() if r["conv_id"] == 1] == [(300, 150)]
    assert [r["conv_id"] for r in chat.report(conv.limit(0)).collect()] == [-1]
    assert got[-1]["n_turns"] == 2 and got[-1]["loss_chars"] == len("<|im_end|><|im_start|>assistant ok")
    assert got[1]["loss_sha256"] == hashlib.sha256(odd.encode()).hexdigest() and None in got


def test_merkle(spark):
    texts = ["a. b\nc\n\nd, e", "a. b\nc\n\nd, f", "a. b\nc\n\nd, e", None, "", "x " * 30_000]
    got = {r["doc_id"]: r for r in merkle.report(documents(spark, texts)).collect()}
    assert got[0]["fingerprint"] == got[2]["fingerprint"] != got[1]["fingerprint"]
    assert got[3]["fingerprint"] == got[4]["fingerprint"] and got[3]["n_chars"] == 0
    for i, t in enumerate(texts):
        t, nxt = t or "", texts[(i + 1) % len(texts)] or ""
        edited = t[:len(t) - len(t) // 2] + nxt[:len(t) // 2]
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[i]["near_next"] <= 1
    pair = spark.createDataFrame([(texts[0], texts[1])], "a string, b string")
    diff = pair.select(merkle.differing(merkle.tree(pair["a"]), merkle.tree(pair["b"])).alias("d")).first()["d"]
    assert [tuple(x) for x in diff] == [(1, 0)]
    assert merkle.report(documents(spark, texts).limit(0)).collect() == []


def test_long_clauses_are_cut_by_their_content(spark):
    rng = np.random.default_rng(5)
    chinese = "".join(chr(0x4E00 + int(i)) for i in rng.integers(0, 3000, 3000))
    tabs = "\t".join(str(i) for i in rng.integers(0, 10**6, 400))
    plain = " ".join(rng.choice(["and", "the", "river", "stone", "went", "under", "old"], 500))
    texts = [chinese, tabs, plain, "x" * 5000, "a. b"]
    for i, t in enumerate(texts[:3]):
        edited = t[:len(t) // 2] + "q" * 40 + t[len(t) // 2:]  # later pieces keep their leaves
        pair = spark.createDataFrame([(t, edited, t[:300] + " " + t[300:])], "a string, b string, c string")
        a, b, c = (merkle.tree(pair[x]) for x in "abc")
        got = pair.select(merkle.likeness(merkle.leaves(a), merkle.leaves(b)).alias("l"), merkle.root(a).alias("a"), merkle.root(c).alias("c")).first()
        assert got["l"] > 0.9 and got["a"] != got["c"], i
    got = {r["doc_id"]: r for r in merkle.report(documents(spark, texts).withColumn("tree", merkle.F.lit(1))).collect()}
    assert all(got[i]["near_edited"] > 0.3 for i in range(3)) and len({r["fingerprint"] for r in got.values()}) == 5

    def leaves(clause):
        if len(clause) <= 200:
            return [clause]
        out, piece = [], ""
        for i, ch in enumerate(clause):
            piece += ch
            if (ord(ch) * 7 + (ord(clause[i - 1]) if i else 0)) % 32 == 7:
                out, piece = [*out, piece], ""
        return [p for p in [*out, piece] if p]

    one = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in one.select("t", merkle.tree(one["t"]).alias("x")).collect():
        want = [hashlib.sha256((("\n" if i else "") + p).encode()).hexdigest() for c in re.split(r"(?<=[.!?,;:|]) ", r["t"]) for i, p in enumerate(leaves(c))]
        assert [h for s_ in r["x"] for p in s_ for h in p] == want


def test_warc_round_trip(spark):
    rng = np.random.default_rng(0)
    big = "".join(chr(33 + c) for c in rng.integers(0, 90, 300_000))
    pages = [(i, f"http://h/{i} x\n", h) for i, h in enumerate(["<p>é</p>", None, "", "<p>é</p>", big, "WARC/1.1\r\n\r\n", big])] + [(None, None, "z")]
    table = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(2)
    done = warc.write(table)
    ranges = sum(-(-r["bytes"] // 1000) for r in done.collect())
    reading = warc.read(done, 1000).select(warc.F.spark_partition_id().alias("task"))
    assert warc.read(done, 1000).rdd.getNumPartitions() == ranges > 100  # a task a range, whatever the planner would merge
    assert reading.distinct().count() > 2  # two small records share the first ranges, the others start far apart
    for size in (1000, 1 << 22):
        rows = warc.read(done, size).collect()
        assert len(rows) == len(pages)
        got = {r["page_id"]: r for r in rows}
        for i, _, h in pages:
            raw = (h or "").encode()
            assert got[i]["payload_bytes"] == len(raw) and got[i]["payload_digest"] == warc.digest(raw)
            assert got[i]["refers_to"] == {3: 0, 2: 1, 6: 4}.get(i) and (got[i]["record_type"] == "revisit") == (i in (2, 3, 6))
            assert got[i]["payload"] is None if i in (2, 3, 6) else bytes(got[i]["payload"]) == raw
    assert warc.report(table.limit(0)).collect() == []


def test_licenses(spark):
    texts = ["Foo bar.\nLicensed under CC BY-NC 4.0.\nbaz", None, "", "this work is licensed under the gnu public license, version 3",
             "nothing here", "All rights reserved. " + "pad " * 9000 + "Released under the MIT License"]
    got = {}
    for r in licenses.scan(documents(spark, texts)).collect():
        raw = texts[r["doc_id"]].encode()
        got.setdefault(r["doc_id"], []).append((r["license"], raw[r["span_start"]:r["span_end"]].decode()))
    assert ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0") in got[0]
    assert [x[0] for x in got[5]] == ["all-rights-reserved", "MIT"]
    assert any(x[0] == "GPL-3.0" for x in got[3]) and 4 not in got and 1 not in got


def test_a_notice_is_one_licence_and_no_other():
    index = licenses.Index()
    found = lambda text: [(r[0], text.encode()[r[2]:r[3]].decode()) for r in index.scan(text)]
    for name, text in (("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"), ("CC-BY-4.0", "licensed under CC BY 4.0"),
                       ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
                       ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
                       ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
                       ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3")):
        assert found(f"Before. {text}. After.") == [(name, text)]
    assert found("Licensed under CC BY 2.1") == found("Licensed under CC BY 2.1.") == []
    assert found("Licensed some time ago under some other rules and CC of BY 4.0") == []
    assert found("All rights reserved. All rights reserved.") == [("all-rights-reserved", "All rights reserved")] * 2
    index = licenses.Index([("MIT", "Released under the MIT License")])
    assert index.scan("Released under the old MIT License")[0][1] == pytest.approx(5 / 6)
    assert found("Released under the very, very old MIT License") == []


def test_whole_licences_headers_and_names(spark):
    entries = licenses.library()
    whole = {i: t for i, t, kind in entries if kind == "text"}
    headers = [(i, t) for i, t, kind in entries if kind == "header"]
    index = licenses.Index()
    for i in ("Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-3.0", "ISC", "MIT", "MPL-2.0", "Unlicense"):
        assert [r[0::4] + (r[1],) for r in index.scan(f"Ours. {whole[i]} Here it ends.")] == [(i, "text", 1.0)]
    for i, t in headers:
        assert [(r[0], r[4]) for r in index.scan(f"x = 1\n{t}\nimport y")] == [(i, "header")]
    assert {"GPL-3.0", "AGPL-3.0", "MPL-2.0"} <= {i for i, _ in headers}
    for i, t in (("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"), ("ISC", "The ISC License"),
                 ("Apache-2.0", "Apache License Version 2.0, January 2004"), ("AGPL-3.0", "GNU Affero General Public License v3"),
                 ("CC-BY-NC-SA-3.0", "Creative Commons Attribution-NonCommercial-ShareAlike 3.0 Unported"),
                 ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0")):
        assert [r[0] for r in index.scan(t)] == [i]
    assert index.scan("SPDX-License-Identifier: ECL-2.0") == index.scan("Acme License, Version 2.0") == []
    clause = " ".join(whole["MIT"].split()[:40])
    rows = licenses.scan(documents(spark, [clause, whole["MIT"], f"{whole['MIT']}\n{whole['MIT']}",
                                           whole["MIT"].replace("THE SOFTWARE IS", "one two three four five THE SOFTWARE IS")])).collect()
    got = {}
    for r in rows:
        got.setdefault(r["doc_id"], []).append((r["license"], round(r["coverage"], 2)))
    n = len(licenses._cut(whole["MIT"])[0])
    assert got == {0: [("MIT", round(40 / n, 2))], 1: [("MIT", 1.0)], 2: [("MIT", 1.0)] * 2, 3: [("MIT", round(n / (n + 5), 2))]}


def test_classifiers_on_small_tables(spark):
    texts = ["good plain words number %d in a row" % i if i % 2 else "BAD!! idiot JUNK!! %d" % i for i in range(60)] + [None, ""]
    docs = documents(spark, texts)
    labels = spark.createDataFrame([(i, i % 2, 1 - i % 2) for i in range(60)] + [(None, 1, 1), (5, None, None)],
                                   "doc_id long, quality int, toxic int")
    for rows, flip in ((quality.report(docs, labels).collect(), 0), (toxicity.report(docs, labels).collect(), 1)):
        assert len(rows) == len(texts) and all(0 <= r["score"] <= 1 for r in rows)
        held = [r for r in rows if r["held_out"] and r["doc_id"] < 60]
        assert held and all((r["score"] >= 0.5) == bool((r["doc_id"] + flip) % 2) for r in held)
        assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % (5 if flip else 4) == (0 if flip else 2)) for r in rows)
    assert len(toxicity.report(docs, labels.limit(0)).collect()) == len(texts)
    assert quality.report(docs.limit(0), labels).collect() == []


def labelled_mentions(seed=0, many=300):
    """Texts in which the group terms are more frequent where a text is toxic."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(many):
        toxic = i % 2
        term = ("muslim", "jewish", "hindu")[i % 3] if rng.random() < (0.9 if toxic else 0.1) else "christian"
        rows.append((toxic, f"{'you idiot and fool' if toxic else 'we met friends'} the {term} people {rng.choice(['today', 'here', 'again'])}"))
    return rows


def test_identity_swaps_change_no_score():
    sample = [(y, i / 300, toxicity.with_swaps(t)) for i, (y, t) in enumerate(labelled_mentions())]
    plain, fair = toxicity.fit(sample, invariance=0.0), toxicity.fit(sample, invariance=10.0)
    assert fair.pairs == plain.pairs == 300 * 6  # every other term of the group, for the one term of each text
    terms = ("muslim", "jewish", "hindu", "christian")
    spread = lambda m: np.ptp([m.score(f"the {t} people") for t in terms])
    assert spread(fair) < 0.25 * spread(plain)
    neutral = [t.format(g) for g in terms[:3] for t in ("we the {} people", "met the {} people here", "met the {} people today")]
    false = lambda m: sum(t >= 0.35 for t in map(m.score, neutral))
    assert false(fair) == 0 and false(plain) == len(neutral) and fair.score("you idiot and fool") > 0.5 > fair.score("we met friends")


def test_groups_are_a_parameter():
    words = toxicity._words("the cat and the dog")
    copies = toxicity.swapped(words, (("cat", "bird", "fish"), ("dog", "wolf")))
    assert sorted(tuple(c) for c in copies) == sorted(tuple(toxicity._words(t)) for t in (
        "the bird and the dog", "the fish and the dog", "the cat and the wolf"))
    assert toxicity.swapped(words) == [] and toxicity.fit([]).pairs == 0


def test_gradient_fit_equals_a_plain_minimum():
    """The fitted loss is as low as that of a slow search over the same loss."""
    rows = labelled_mentions(4, 80)
    sample = [(y, 0.0, toxicity.with_swaps(t)) for y, t in rows]
    model = toxicity.fit(sample, epochs=3000)
    words = sorted({w for _, t in rows for w in t.split()} | {t for t in toxicity.IDENTITY_GROUPS[0]})
    column = {int(toxicity.features(w)[0]): i for i, w in enumerate(words)}
    seen = {c for c, n in zip(*np.unique(np.concatenate([toxicity.features(t) for _, t in rows]), return_counts=True)) if n > 1}

    def row(f):
        out = np.zeros(len(words))
        out[[column[int(c)] for c in f if c in seen]] = 1
        return out

    x = np.array([row(toxicity.features(t)) for _, t in rows])
    y = np.array([float(v) for v, _ in rows])
    gaps = np.array([row(toxicity.features(t)) - row(np.unique(toxicity._indices(c))) for _, t in rows for c in toxicity.swapped(toxicity._words(t))])
    share = np.where(y == 1, 3 / y.sum(), 1 / (1 - y).sum()) / 4

    def loss(w, b):
        z = np.clip(x @ w + b, -30, 30)
        return (share * (np.logaddexp(0, z) - y * z)).sum() + 0.5 * 1e-3 * w @ w + ((gaps @ w) ** 2).mean()

    w, b = np.zeros(len(words)), 0.0
    for _ in range(20_000):
        p = share * (1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30))) - y)
        w, b = w - 0.3 * (x.T @ p + 1e-3 * w + 2 * gaps.T @ (gaps @ w) / len(gaps)), b - 0.3 * p.sum()
    mine = np.array([model.weight[int(toxicity.features(v)[0])] for v in words])
    assert loss(mine, model.bias) <= loss(w, b) + 1e-3


def naive_phrases(text, sample):
    out = i = 0
    while i < len(text):
        n = 1
        while i + n < len(text) and text[i:i + n + 1] in sample:
            n += 1
        out, i = out + 1, i + n
    return out


def test_cross_parsing_equals_naive_search():
    samples = {"aa": "the cat sat on the mat and the dog", "bb": "le chat est sur le tapis et le chien"}
    model = langid.LanguageModel(samples)
    for text in ("the cat and the dog sat", "le chien est sur le tapis", "zebra", "a"):
        letters, bits = model.scorer().bits_per_letter([text])
        for k, lang in enumerate(model.langs):
            assert bits[0, k] == pytest.approx(naive_phrases(text, samples[lang]) * model.bits[k] / letters[0])


def test_language_rules(spark):
    en, fr = "the house and the garden of that man were there ", "la maison et le jardin de cet homme étaient là "
    rows = [(i, (en if i % 2 else fr) * 3, "en" if i % 2 else "fr", "s", 1) for i in range(40)]
    rows += [(50, None, "en", "s", 0), (51, "12 --", None, "s", 5), (None, en, "en", "s", 1), (52, en * 3000, None, "s", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    got = {r["doc_id"]: r for r in langid.report(docs).collect()}
    assert all(got[i]["lang_pred"] == ("en" if i % 2 else "fr") for i in range(40))
    assert got[50]["lang_pred"] == got[51]["lang_pred"] == "und" and got[50]["score"] == 0 and got[52]["lang_pred"] == "en"
    none = langid.report(docs.withColumn("lang", langid.F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in none} == {"und"} and len(none) == len(rows)
    kept = langid.keep_known(docs)
    assert kept.columns == docs.columns and {50, 51}.isdisjoint(r["doc_id"] for r in kept.collect())


def test_language_model_does_not_grow_with_the_alphabet():
    """Thousands of letters and a Latin language side by side: a small model that parses as a naive search does."""
    rng = np.random.default_rng(8)
    chinese = "".join(chr(0x4E00 + int(i)) for i in rng.zipf(1.3, 60_000) % 5000)
    english = " ".join(rng.choice(["the", "house", "of", "garden", "man", "were", "there", "and"], 10_000))
    model = langid.LanguageModel({"zh": chinese, "en": english})
    assert len(model.alphabet) > 2000 and model.nbytes < 20 << 20
    scorer = model.scorer()
    small = langid.LanguageModel({"zh": chinese[:400], "en": english[:400]})
    for text in (chinese[200:230] + "the", "of gardens " + chinese[5:9], "zebra"):
        letters, bits = small.scorer().bits_per_letter([text])
        for k, lang in enumerate(small.langs):
            assert bits[0, k] == pytest.approx(naive_phrases(text, {"zh": chinese, "en": english}[lang][:400]) * small.bits[k] / letters[0])
    _, bits = scorer.bits_per_letter([chinese[100:300], "the garden of the man"])
    assert [model.langs[i] for i in bits.argmin(axis=1)] == ["zh", "en"]


def test_one_rule_for_texts_of_every_length(spark):
    en = "the house and the garden of that man were there where all the people had seen him before "
    rows = [(i, en * 5, "en", "s", 1) for i in range(30)] + [(100, "the man", None, "s", 7), (101, "house", None, "s", 5), (102, "a", None, "s", 1)]
    rng = np.random.default_rng(2)
    noise = "".join(rng.choice(list("qxzjkvwþøł"), 150))
    rows += [(200, noise, "en", "s", 150), (201, noise * 9, "en", "s", 1350), (202, "!!", "en", "s", 2), (203, None, "en", "s", 0), (None, en, None, "s", 1)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("row", langid.F.lit(1)).withColumn("bits", langid.F.lit("x"))
    # the noise is labelled, but far too rare to be drawn whole: keep it out of the sample
    model_docs = docs.where("doc_id < 200 or doc_id is null")
    kept = langid.keep_known(model_docs.unionByName(docs.where("doc_id >= 200").withColumn("lang", langid.F.lit(None).cast("string"))))
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted([str(i) for i in range(30)] + ["100", "101", "102", "None"])
    assert langid.keep_known(docs.limit(0)).collect() == [] == langid.report(docs.limit(0)).collect()
    twice = langid.report(docs.unionByName(docs)).collect()
    assert len(twice) == 2 * len(rows)


def brute_components(texts, k):
    """Smallest place reachable over links of 80 % of the shingles, by comparing all pairs."""
    sets, root = [shingles(t, k) for t in texts], list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))]


def test_pipeline_equals_brute_force(spark):
    """Every stage on what the one before kept, each against a plain computation over the same rows."""
    import corpus_pipeline
    from tokenizers import Tokenizer

    from aspectra.llm.common import read_table
    from aspectra.llm.queries import tokenizer_path

    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "language_id", "near_duplicates", "decontamination", "packing"]
    d = "/root/testdata/sf0.001"
    docs, labels, items = (read_table(spark, d, t) for t in ("documents", "labels", "benchmark"))
    passage = items.where("length(text) > 100").first()["text"]
    first = docs.where("length(text) > 400").orderBy("doc_id").limit(2).collect()
    extra = [(None, None, "en", "s", 0), (9001, "", "en", "s", 0), (9002, "12 !!", "en", "s", 5), (9003, "x " + passage + " y", "en", "s", 1),
             (9004, first[0]["text"] + " extra", "en", "s", 1), (first[1]["doc_id"], first[1]["text"] + " more", "en", "s", 1),
             (9005, "word " * 4000, "en", "s", 1), (9006, first[0]["text"], None, None, None)]
    now = docs.unionByName(spark.createDataFrame(extra, docs.schema)).unionByName(docs.where("doc_id = 5"))
    rows = [tuple(r) for r in now.collect()]
    names = docs.columns
    key = lambda r: str(r)

    stages = dict(corpus_pipeline.STAGES)
    tox = toxicity.learn(now, labels, toxicity.F.lit(True))
    now = stages["toxicity"](spark, now, d)
    rows = [r for r in rows if tox.score(r[1]) < 0.5]
    assert now.columns == names and sorted(map(tuple, now.collect()), key=key) == sorted(rows, key=key)

    model = langid.learn(now, langid.F.lit(True))
    now = stages["language_id"](spark, now, d)

    def known(text):
        letters, bits = model.scorer().bits_per_letter([text])
        best = bits[0].argmin()
        return letters[0] > 0 and bits[0, best] * letters[0] <= letters[0] * model.plain[best] + 8 * model.bits[best] + 1e-9

    rows = [r for r in rows if r[1] is not None and known(r[1])]
    assert now.columns == names and sorted(map(tuple, now.collect()), key=key) == sorted(rows, key=key)
    assert not {9001, 9002} & {r[0] for r in rows} and 9003 in {r[0] for r in rows}

    now = stages["near_duplicates"](spark, now, d)
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0]))
    label = brute_components([r[1] for r in rows], 5)
    groups_ = {}
    for r, c in zip(rows, label):
        groups_.setdefault(c, set()).add((r[0], r[1]))
    kept = [tuple(r) for r in now.collect()]
    assert now.columns == names and len(kept) == len(groups_)
    for members in groups_.values():
        assert sum((r[0], r[1]) in members for r in kept) == 1
        assert min(i for i, _ in members) in {r[0] for r in kept if (r[0], r[1]) in members}

    before = kept
    now = stages["decontamination"](spark, now, d)
    tests = [(r["item_id"], r["text"]) for r in items.collect()]
    windows = set()
    for _, t in tests:
        w = words(t)
        n = min(10, len(w))
        windows |= {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if n else set()
    after = {(r["doc_id"]): r for r in now.collect()}
    assert now.columns == names and len(after) == len(before)
    for i, text, *_ in before:
        w, hit = words(text), set()
        for n in {len(x) for x in windows}:
            for at in range(len(w) - n + 1):
                if tuple(w[at:at + n]) in windows:
                    hit |= set(range(at, at + n))
        assert words(after[i]["text"]) == [x for at, x in enumerate(w) if at not in hit]
        assert after[i]["n_chars"] == len(after[i]["text"])

    packed = stages["packing"](spark, now, d).collect()
    tok = Tokenizer.from_file(tokenizer_path())
    for i, r in after.items():
        ids = np.array([*tok.encode(r["text"] or "", add_special_tokens=False).ids, 0], "<u4")
        mine = sorted((p["start"], p["length"], p["ids_crc32"]) for p in packed if p["doc_id"] == i)
        assert mine == [(s, len(ids[s:s + 2048]), zlib.crc32(ids[s:s + 2048].tobytes())) for s in range(0, len(ids), 2048)]
    assert {p["doc_id"] for p in packed} == set(after)
    whole = corpus_pipeline.run(spark, d)
    assert whole.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and whole.count() > 0


def test_stages_take_empty_tables(spark):
    import corpus_pipeline
    from aspectra.llm.common import read_table

    docs = read_table(spark, "/root/testdata/sf0.001", "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.collect() == [] and (out.columns == docs.columns or name == "packing"), name


def test_dual_descent_reaches_the_minimum():
    """The hinge objective of the fitted weights is as low as that of a slow search over the same rows."""
    rng = np.random.default_rng(9)
    rows = [np.flatnonzero(rng.random(12) < 0.4) for _ in range(60)]
    y = np.array([1.0 if (3 in r) != (rng.random() < 0.1) else -1.0 for r in rows])
    values = [rng.normal(1, 0.2, len(r)) for r in rows]
    cost = np.where(y > 0, 2.0, 1.0)
    x = np.zeros((60, 13))
    x[:, 12] = 1  # the bias is the weight of a constant
    for i, (r, v) in enumerate(zip(rows, values)):
        x[i, r] = v
    w, b = quality.dual_descent(rows, values, y, cost, epochs=400)
    objective = lambda u: 0.5 * u @ u + (cost * np.maximum(0, 1 - y * (x @ u))).sum()
    mine = objective(np.append(w[:12], b))
    u, best = np.zeros(13), np.inf
    for t in range(60_000):
        u = u - (u - (x * (cost * y * (y * (x @ u) < 1))[:, None]).sum(axis=0)) / (t + 50)
        best = min(best, objective(u))
    assert mine <= best * 1.002 and not w[12:].any()


def test_log_count_ratios_equal_plain_counts():
    texts = [(1, "good fine work"), (1, "good good day"), (0, "bad spam spam"), (0, "bad day")]
    model = quality.fit([(y, i / 4, quality.ngrams(t)) for i, (y, t) in enumerate(texts)])
    sets = [(y, set(quality.ngrams(t).tolist())) for y, t in texts]
    total = {c: (1 << quality.BITS) + sum(len(f) for y, f in sets if y == c) for c in (0, 1)}
    for feature in set().union(*(f for _, f in sets)):
        n = {c: 1 + sum(feature in f for y, f in sets if y == c) for c in (0, 1)}
        want = np.log((n[1] / total[1]) / (n[0] / total[0])) if n[0] + n[1] > 3.5 else 0.0
        assert model.ratio[feature] == pytest.approx(want, abs=1e-5)


def test_word_encoder_equals_the_tokenizer():
    """Words encoded once and remembered give the ids of the whole text, also for marks,
    control strings, joined letters, other scripts and white space other than blanks."""
    import pyarrow as pa
    from tokenizers import Tokenizer

    from aspectra.llm.queries import tokenizer_path
    from aspectra.llm.tokens import Encoder

    texts = ["Σίσυφος ΟΔΟΣ. İstanbul, áb abc̸= é. <| <|endoftext|> x<|endoftext|>y don't DON'T. 12ab. a-b-c!! ~~ '' 's,",
             "", "  ", "ªʰ ﬁn ẞ ß, 漢字. ไทย नमस्ते हिन्दी", ".,;'", "a'b's 'tis. we're' x'", " a\tb\r\nc d.", "퟿ \U0001F600ok. ͅ ͅa"]
    tok = Tokenizer.from_file(tokenizer_path())
    for encoder in (Encoder(tokenizer_path()), Encoder(tokenizer_path(), cache_words=5)):
        for _ in range(2):
            got = [part.tolist() for _, ids, size in encoder.encode(pa.array(texts + [None])) for part in np.split(ids, np.cumsum(size)[:-1])]
            assert got == [tok.encode(t, add_special_tokens=False).ids for t in texts] + [[]]
