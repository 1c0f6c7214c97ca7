"""Registered queries of the training-data operators, with SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (chat, clustering, collocations, decontaminate, langid, licenses, merkle, neardup, packing, quality, retrieval_packing,
               toxicity, warc)
from .common import read_table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.report(read_table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.report(read_table(spark, sf_dir, "conversations"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.report(read_table(spark, sf_dir, "documents"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.report(read_table(spark, sf_dir, "documents"))


def tokenizer_path() -> str:
    """The vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), tokenizer_path())


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read_table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.report(read_table(spark, sf_dir, "pages"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_table(spark, sf_dir, "documents"))


def op12_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval_packing.pack(read_table(spark, sf_dir, "documents"), tokenizer_path())


def op13_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster(read_table(spark, sf_dir, "embeddings"))


REGISTRY = {
    "op1_language_id": op1_language_id,
    "op2_quality": op2_quality,
    "op3_decontamination": op3_decontamination,
    "op4_chat_format": op4_chat_format,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_fingerprints": op6_fingerprints,
    "op7_packing": op7_packing,
    "op8_licenses": op8_licenses,
    "op9_toxicity": op9_toxicity,
    "op10_warc": op10_warc,
    "op11_collocations": op11_collocations,
    "op12_retrieval_packing": op12_retrieval_packing,
    "op13_clustering": op13_clustering,
}

_PIECES = r"""list_filter(string_split(array_to_string(list_transform(list_zip(string_split(c, ''), [''] || string_split(c, '')),
    lambda z: CASE WHEN z[1] IS NULL THEN '' ELSE z[1] || CASE WHEN (unicode(z[1]) * 7 + greatest(unicode(z[2]), 0)) % 32 = 7
    THEN chr(10) ELSE '' END END), ''), chr(10)), lambda y: y <> '')"""
_SPLIT = r"""list_transform(string_split({0}, chr(10) || chr(10)), lambda s: list_transform(string_split(s, chr(10)),
    lambda p: flatten(list_transform(string_split(regexp_replace(p, '([.!?,;:|]) ', '\1' || chr(1), 'g'), chr(1)),
    lambda c: CASE WHEN length(c) > 200 THEN list_transform(""" + _PIECES + r""",
    lambda y, i: sha256(CASE WHEN i > 1 THEN chr(10) || y ELSE y END)) ELSE [sha256(c)] END))))"""
_ROOT = """sha256('d' || array_to_string(list_transform({0}, lambda s: sha256('s' || array_to_string(
    list_transform(s, lambda p: sha256('p' || array_to_string(p, ','))), ','))), ','))"""
_LIKE = "2.0 * len(list_intersect({0}, {1})) / (len({0}) + len({1}))"

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

ORACLE = {
    "op4_chat_format": """
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
           UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
e AS (SELECT *, regexp_replace(text, '<(\\\\*)\\|', '<\\\\\\1|', 'g') AS esc FROM c),
h AS (SELECT *, '<|im_start|>' || role || chr(10) AS head FROM e),
x AS (SELECT *, sha256(coalesce(string_agg(head || esc || '<|im_end|>' || chr(10), '') OVER (PARTITION BY conv_id
         ORDER BY turn, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') || head) AS context FROM h)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       cast(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       cast(sum(length(role) + length(esc) + 24) AS BIGINT) AS formatted_chars, count(*) FILTER (role = 'assistant') AS n_examples,
       sha256(coalesce(string_agg(context, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS contexts_sha256
FROM x GROUP BY conv_id""",
    "op6_fingerprints": f"""
WITH o AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
k AS (SELECT doc_id, min(text) AS head FROM o GROUP BY doc_id),
n AS (SELECT doc_id, coalesce(lead(head) OVER (ORDER BY doc_id NULLS FIRST),
                              first_value(head) OVER (ORDER BY doc_id NULLS FIRST)) AS next FROM k),
e AS (SELECT o.doc_id, o.text, n.next,
             substr(o.text, 1, length(o.text) - length(o.text) // 2) || substr(n.next, 1, length(o.text) // 2) AS edited
      FROM o JOIN n ON o.doc_id IS NOT DISTINCT FROM n.doc_id),
t AS (SELECT doc_id, text, edited, {_SPLIT.format("text")} AS a, {_SPLIT.format("edited")} AS b,
             {_SPLIT.format("next")} AS x FROM e),
l AS (SELECT *, list_distinct(flatten(flatten(a))) AS la, list_distinct(flatten(flatten(b))) AS lb,
             list_distinct(flatten(flatten(x))) AS lx FROM t)
SELECT doc_id, cast(length(text) AS BIGINT) AS n_chars, sha256(edited) AS edited_sha256,
       {_ROOT.format("a")} AS fingerprint, {_ROOT.format("b")} AS edited_fingerprint,
       cast({_LIKE.format("la", "lb")} AS DOUBLE) AS near_edited, cast({_LIKE.format("la", "lx")} AS DOUBLE) AS near_next
FROM l""",
    "op3_decontamination": f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
                  regexp_extract_all(coalesce({_LOWER}, ''), {_WORD}) AS w FROM documents),
b AS (SELECT cast(item_id AS VARCHAR) AS item,
             regexp_extract_all(coalesce({_LOWER}, ''), {_WORD}) AS w
      FROM benchmark WHERE item_id IS NOT NULL),
bl AS (SELECT item, w, least(len(w), 10) AS n FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS t
        FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM bl)),
lens AS (SELECT DISTINCT n FROM win),
dw AS (SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS t
       FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)),
hit AS (SELECT rid, i, n, item FROM dw JOIN win USING (n, t)),
words AS (SELECT rid, count(DISTINCT p) AS n_hit
          FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hit) GROUP BY rid),
items AS (SELECT rid, count(DISTINCT item) AS n_items,
                 array_to_string(list_sort(list(DISTINCT item)), ',') AS ids FROM hit GROUP BY rid)
SELECT doc_id, cast(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)""",
}


def _clusters_sql(rounds: int = 5) -> str:
    """Rounds as a chain of materialised steps: nearest centroid, then componentwise floors of the means."""
    dist = "list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    steps = ["""v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id,
    list_transform(embedding, lambda e: cast(floor(256 * cast(e AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), x) - 1 AS k, x FROM v
    WHERE vec_id IS NOT NULL ORDER BY k LIMIT 40)"""]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (SELECT v.rid, min(struct_pack(d := {dist}, k := c.k)) AS b FROM v, c{i} c GROUP BY v.rid)""")
        if i < rounds:
            steps.append(f"""m{i} AS MATERIALIZED (SELECT k, list(f ORDER BY i) AS x FROM (
    SELECT a.b.k AS k, i, cast((sum(v.x[i]) - (sum(v.x[i]) % count(*) + count(*)) % count(*)) // count(*) AS BIGINT) AS f
    FROM a{i} a JOIN v USING (rid), range(1, 65) t(i) GROUP BY ALL) GROUP BY k),
c{i + 1} AS MATERIALIZED (SELECT k, coalesce(m{i}.x, c{i}.x) AS x FROM c{i} LEFT JOIN m{i} USING (k))""")
    return f"""WITH {", ".join(steps)}
SELECT vec_id, cast(a.b.k AS INTEGER) AS cluster, cast(a.b.d AS BIGINT) AS distance,
       cast(sum(a.b.d) OVER (PARTITION BY a.b.k) AS BIGINT) AS cluster_inertia, cast(sum(a.b.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{rounds} a JOIN v USING (rid) JOIN c{rounds} c ON c.k = a.b.k"""


ORACLE["op13_clustering"] = _clusters_sql()

ORACLE["op11_collocations"] = f"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM p),
n AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
      FROM w, (VALUES (1), (2), (3), (4)) t(k) WHERE len(w) >= k),
f AS MATERIALIZED (SELECT lang, phrase, k, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2),
cut AS (SELECT lang, phrase, k, a, w, unnest(range(1, k)) AS cp FROM c),
s AS (SELECT cut.lang, cut.phrase, a, cp, x.f AS l, y.f AS r, (2000000::HUGEINT * a) // (x.f + y.f) AS score
      FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = array_to_string(w[1:cp], ' ')
      JOIN f y ON y.lang = cut.lang AND y.phrase = array_to_string(w[cp + 1:], ' ')),
m AS (SELECT lang, phrase, a, min(struct_pack(score := score, cp := cp, l := l, r := r)) AS m FROM s GROUP BY ALL),
i AS (SELECT lang, a, unnest(flatten(list_transform(range(2, k), lambda z: list_transform(range(1, k - z + 2),
      lambda b: array_to_string(w[b:b + z - 1], ' '))))) AS phrase FROM c WHERE k >= 3),
o AS (SELECT lang, phrase, max(a) AS longer FROM i GROUP BY ALL),
r AS (SELECT m.*, row_number() OVER (PARTITION BY lang ORDER BY m.score DESC, a DESC, phrase) AS rank
      FROM m LEFT JOIN o USING (lang, phrase) WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a)
SELECT lang, rank, phrase, a, m.l AS l, m.r AS r, cast(n AS BIGINT) AS n, cast(m.score AS BIGINT) AS score
FROM r JOIN n USING (lang) WHERE rank <= 2000"""

ORACLE["op10_warc"] = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS size, sha1(coalesce(html, '')) AS sha FROM pages),
g AS (SELECT *, min(page_id) OVER (PARTITION BY sha) AS first,
             list_transform(range(0, 8), lambda i: cast('0x' || substr(sha, 5 * i + 1, 5) AS INTEGER)) AS v FROM p)
SELECT page_id, cast(size AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(v, lambda n: array_to_string(list_transform([15, 10, 5, 0],
           lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((n >> s) & 31) + 1, 1)), '')), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM g"""

ORACLE["op5_near_duplicates"] = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(coalesce({_LOWER}, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
                                          WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
r(node, reach) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.node, l.b FROM r JOIN l ON r.reach = l.a),
m AS (SELECT node, min(reach) AS comp FROM r GROUP BY node)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(comp, doc_id) AS component_id, coalesce(comp, doc_id) = doc_id AS kept
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN m ON m.node = doc_id"""
