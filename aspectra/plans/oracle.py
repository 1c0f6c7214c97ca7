"""Independent SQL (DuckDB dialect) for each registered query.

Each statement recomputes the query's answer from the raw tables with plain
SQL; only the fixed values (aspect list, cue words, character classes) are
shared with the Spark code.
"""

from __future__ import annotations

from ..config import ASPECTS, DASHBOARD_SENTIMENTS
from ..operators.scoring import DEFAULT_ASPECT_WORDS, DEFAULT_NEGATIVE, DEFAULT_POSITIVE

TOKEN_RE = r"([\p{L}\p{N}_]+)"
# Python str.isspace() characters, as an RE2 class body.
SPACE_RE = r"\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _inlist(words: list[str]) -> str:
    return "(" + ", ".join(_q(w) for w in words) + ")"


def _list(words: list[str]) -> str:
    return "[" + ", ".join(_q(w) for w in words) + "]"


def tokens_sql(text: str = "text") -> str:
    return f"regexp_extract_all(lower({text}), '{TOKEN_RE}', 1)"


def lexicon_scored_sql() -> str:
    """documents -> (id, review, 8 aspect sentiment columns) by the cue-word rules."""
    cases = []
    for a in ASPECTS:
        words = DEFAULT_ASPECT_WORDS.get(a, [])
        mention = f"list_has_any(toks, {_list(words)})" if words else "false"
        if a == "General":
            mention = f"({mention} OR npos + nneg > 0)"
        cases.append(
            f"CASE WHEN toks IS NULL THEN NULL WHEN {mention} THEN "
            f"(CASE WHEN npos > nneg THEN 'POS' WHEN nneg > npos THEN 'NEG' ELSE 'NEU' END) ELSE 'NONE' END AS {a}"
        )
    return f"""
    WITH t AS (
      SELECT doc_id, text, {tokens_sql()} AS toks FROM documents
    ), p AS (
      SELECT doc_id, text, toks,
             len(list_filter(toks, lambda x: x IN {_inlist(DEFAULT_POSITIVE)})) AS npos,
             len(list_filter(toks, lambda x: x IN {_inlist(DEFAULT_NEGATIVE)})) AS nneg
      FROM t
    )
    SELECT CAST(doc_id AS VARCHAR) AS id, text AS review, {", ".join(cases)} FROM p
    """


def sentiment_counts_sql(include_none: bool) -> str:
    sents = DASHBOARD_SENTIMENTS + (["NONE"] if include_none else [])
    grid_a = " UNION ALL ".join(f"SELECT {_q(a)} AS Aspect, {i} AS ao" for i, a in enumerate(ASPECTS))
    grid_s = " UNION ALL ".join(f"SELECT {_q(s)} AS Sentiment" for s in sents)
    longs = " UNION ALL ".join(f"SELECT {_q(a)} AS Aspect, coalesce({a}, 'NONE') AS Sentiment FROM scored" for a in ASPECTS)
    return f"""
    WITH scored AS ({lexicon_scored_sql()}),
    long AS ({longs}),
    cnt AS (SELECT Aspect, Sentiment, count(*) AS n FROM long GROUP BY 1, 2),
    grid AS (SELECT * FROM ({grid_a}) a CROSS JOIN ({grid_s}) s)
    SELECT g.Aspect, g.Sentiment, CAST(coalesce(c.n, 0) AS BIGINT) AS Count
    FROM grid g LEFT JOIN cnt c ON g.Aspect = c.Aspect AND g.Sentiment = c.Sentiment
    """


def sentiment_totals_sql() -> str:
    return f"""
    WITH s AS ({sentiment_counts_sql(False)})
    SELECT Sentiment, CAST(sum(Count) AS BIGINT) AS Count FROM s GROUP BY Sentiment
    """


def sentiment_share_sql() -> str:
    return f"""
    WITH t AS ({sentiment_totals_sql()})
    SELECT Sentiment, Count,
           round(CASE WHEN sum(Count) OVER () > 0 THEN Count / sum(Count) OVER () ELSE 0.0 END, 6) AS Share
    FROM t
    """


def labelled_sql() -> str:
    """documents + labels -> labelled review rows (offset, review_text, 8 INT labels)."""
    truth = {"Quality": "CAST(l.quality AS INTEGER)", "General": "CAST(1 - l.toxic AS INTEGER)"}
    cols = ", ".join(f"{truth.get(a, 'CAST(NULL AS INTEGER)')} AS {a}" for a in ASPECTS)
    return f"""
    SELECT d.doc_id AS offset, d.text AS review_text, {cols}
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    WHERE d.text IS NOT NULL
    """


def label_of(sent: str) -> str:
    return (f"CAST(CASE {sent} WHEN 'NONE' THEN -1 WHEN 'NEG' THEN 0 WHEN 'POS' THEN 1 "
            f"WHEN 'NEU' THEN 2 END AS INTEGER)")


def labelled_predictions_sql() -> str:
    preds = ", ".join(f"lb.{a} AS {a}, {label_of('sc.' + a)} AS pred_{a}" for a in ASPECTS)
    return f"""
    WITH lb AS ({labelled_sql()}),
    sc AS ({lexicon_scored_sql()})
    SELECT lb."offset", lb.review_text, {preds}
    FROM lb JOIN sc ON CAST(lb."offset" AS VARCHAR) = sc.id
    """


def eval_metrics_sql(digits: int | None = 6) -> str:
    accuracy, f1 = (f"round({e}, {digits})" if digits is not None else e for e in ("tot.tp / tot.n", "f.wf1 / tot.n"))
    longs = " UNION ALL ".join(
        f"SELECT {_q(a)} AS Aspect, CAST({a} AS DOUBLE) AS label, CAST(pred_{a} AS DOUBLE) AS prediction FROM lp"
        for a in ASPECTS)
    names = " UNION ALL ".join(f"SELECT {_q(a)} AS Aspect" for a in ASPECTS)
    return f"""
    WITH lp AS ({labelled_predictions_sql()}),
    long AS (SELECT * FROM ({longs}) WHERE label IS NOT NULL AND prediction IS NOT NULL),
    tot AS (SELECT Aspect, count(*) AS n, sum(CASE WHEN label = prediction THEN 1 ELSE 0 END) AS tp FROM long GROUP BY 1),
    nk AS (SELECT Aspect, label, count(*) AS n_k, sum(CASE WHEN label = prediction THEN 1 ELSE 0 END) AS tp_k FROM long GROUP BY 1, 2),
    mk AS (SELECT Aspect, prediction AS label, count(*) AS m_k FROM long GROUP BY 1, 2),
    f AS (SELECT nk.Aspect, sum(nk.n_k * CASE WHEN nk.tp_k > 0 THEN 2.0 * nk.tp_k / (nk.n_k + coalesce(mk.m_k, 0)) ELSE 0.0 END) AS wf1
          FROM nk LEFT JOIN mk ON nk.Aspect = mk.Aspect AND nk.label = mk.label GROUP BY 1),
    a AS ({names})
    SELECT a.Aspect, CAST(coalesce(tot.n, 0) AS BIGINT) AS n,
           {accuracy} AS accuracy, {f1} AS f1
    FROM a LEFT JOIN tot ON a.Aspect = tot.Aspect LEFT JOIN f ON a.Aspect = f.Aspect
    """


def eval_macro_sql() -> str:
    return f"""
    WITH m AS ({eval_metrics_sql(None)})
    SELECT CAST(count(*) FILTER (WHERE n > 0) AS BIGINT) AS n_aspects,
           round(avg(accuracy) FILTER (WHERE n > 0), 6) AS avg_accuracy,
           round(avg(f1) FILTER (WHERE n > 0), 6) AS avg_f1
    FROM m
    """


def vocab_sql(tok_expr: str) -> str:
    return f"""
    SELECT tok, CAST(rn + 1 AS INTEGER) AS id FROM (
      SELECT tok, row_number() OVER (ORDER BY n DESC, tok) AS rn FROM (
        SELECT tok, count(*) AS n FROM (SELECT unnest({tok_expr}) AS tok FROM documents) GROUP BY tok))
    """


def token_ids_sql(tok_expr: str, max_len: int, tail: bool) -> str:
    cut = (f"CASE WHEN len(t) > {max_len} THEN t[len(t) - {max_len - 1}:len(t)] ELSE t END" if tail
           else f"t[1:{max_len}]")
    return f"""
    WITH vocab AS ({vocab_sql(tok_expr)}),
    cutd AS (SELECT doc_id, {cut} AS t FROM (SELECT doc_id, {tok_expr} AS t FROM documents)),
    ex AS (SELECT doc_id, unnest(t) AS tok, unnest(range(1, len(t) + 1)) AS pos FROM cutd),
    ids AS (SELECT ex.doc_id, list(coalesce(v.id, 1) ORDER BY ex.pos) AS ids
            FROM ex LEFT JOIN vocab v ON ex.tok = v.tok GROUP BY ex.doc_id)
    SELECT c.doc_id,
           CASE WHEN c.t IS NULL THEN NULL
                ELSE array_to_string(list_resize(coalesce(i.ids, []), {max_len}, 0), ',') END AS ids
    FROM cutd c LEFT JOIN ids i ON c.doc_id = i.doc_id
    """


def known_ids_sql(tok_expr: str, max_len: int) -> str:
    """Ids by a vocabulary of the labelled documents; unknown words go before the last ``max_len`` are kept."""
    return f"""
    WITH vocab AS (
      SELECT tok, CAST(row_number() OVER (ORDER BY n DESC, tok) + 1 AS INTEGER) AS id FROM (
        SELECT tok, count(*) AS n FROM (SELECT unnest({tok_expr}) AS tok FROM documents
          WHERE doc_id IN (SELECT doc_id FROM labels)) GROUP BY tok)),
    d AS (SELECT doc_id, {tok_expr} AS t FROM documents),
    ex AS (SELECT doc_id, unnest(t) AS tok, unnest(range(1, len(t) + 1)) AS pos FROM d),
    ids AS (SELECT ex.doc_id, list(v.id ORDER BY ex.pos) AS ids FROM ex JOIN vocab v ON ex.tok = v.tok GROUP BY ex.doc_id)
    SELECT d.doc_id, CASE WHEN d.t IS NULL THEN NULL ELSE array_to_string(list_resize(
             CASE WHEN len(i.ids) > {max_len} THEN i.ids[len(i.ids) - {max_len - 1}:len(i.ids)] ELSE coalesce(i.ids, []) END,
             {max_len}, 0), ',') END AS ids
    FROM d LEFT JOIN ids i ON d.doc_id = i.doc_id
    """


def clean_sql(text: str = "text") -> str:
    return (f"regexp_replace(regexp_replace(regexp_replace(lower({text}), "
            f"'[^\\p{{L}}\\p{{N}}_{SPACE_RE}]', '', 'g'), '\\p{{Nd}}+', '', 'g'), "
            f"'^[{SPACE_RE}]+|[{SPACE_RE}]+$', '', 'g')")
