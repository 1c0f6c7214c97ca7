"""Query registry: name -> (Spark callable(spark, sf_dir) -> DataFrame, oracle SQL or None).

Every query reads the driver tables (or data Spark derives from them), over
whole tables and whole texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ASPECTS, FOREST_CONTAMINATION, HEAD_MAX_LEN, HELD_VOCAB, TAIL_MAX_LEN
from ..functions import arrays as arr
from ..functions import text as tx
from ..functions.json import NUMBER_DDL, REVIEW_DDL, TRANSACTION_DDL, encode_json, parse_envelope, split_dead_letter
from ..operators import anomaly as AN
from ..operators import mapped as MP
from ..operators import metrics as M
from ..operators import sampling as S
from ..operators import series as SR
from ..operators import trend as TR
from ..operators.scoring import WholeVocabularyCnn, widen
from ..operators.skew import rows_of
from ..session import fresh_path
from ..sources import files as FS
from ..sources.envelope import (labelled_messages, number_messages, payload_messages, review_messages,
                                stream_envelope_files, to_envelope)
from ..streaming.live import live_counts
from ..streaming.results import null_totals
from . import fixed_forest as FX
from . import oracle as O
from . import stateful as SF
from . import streams as ST
from .catalog import table
from .reviews import PRED_ORDER, labelled_predictions, parsed_labelled, parsed_reviews, scored_reviews

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


# ------------------------------------------------------------ reviews slice

@query("parse_reviews", "SELECT CAST(doc_id AS VARCHAR) AS id, text AS review, doc_id AS offset FROM documents")
def q_parse_reviews(spark, sf):
    return parsed_reviews(spark, sf).select("id", "review", "offset")


@query("aspect_widen", f"SELECT id, {', '.join(ASPECTS)} FROM ({O.lexicon_scored_sql()})")
def q_aspect_widen(spark, sf):
    return scored_reviews(spark, sf).select("id", *ASPECTS)


def _dashboard(spark, sf):
    """Scored reviews as the dashboards find them: stored once, read by every query."""
    return ST.kept_reviews(spark, sf).read(spark)


@query("sentiment_counts", O.sentiment_counts_sql(False))
def q_sentiment_counts(spark, sf):
    return M.sentiment_counts(_dashboard(spark, sf))


@query("sentiment_counts_with_none", O.sentiment_counts_sql(True))
def q_sentiment_counts_with_none(spark, sf):
    return M.sentiment_counts(_dashboard(spark, sf), include_none=True)


@query("sentiment_totals", O.sentiment_totals_sql())
def q_sentiment_totals(spark, sf):
    return M.sentiment_totals(M.sentiment_counts(_dashboard(spark, sf)))


@query("sentiment_share", O.sentiment_share_sql())
def q_sentiment_share(spark, sf):
    return M.sentiment_share(M.sentiment_totals(M.sentiment_counts(_dashboard(spark, sf))))


# ------------------------------------------------------------ text functions

@query("text_tokens", f"""
    SELECT doc_id, CAST(len(toks) AS INTEGER) AS n_tokens, array_to_string(toks, ' ') AS tokens
    FROM (SELECT doc_id, {O.tokens_sql()} AS toks FROM documents)""")
def q_text_tokens(spark, sf):
    toks = tx.tokens("text")
    return table(spark, sf, "documents").select(
        "doc_id", F.size(toks).cast("int").alias("n_tokens"), F.array_join(toks, " ").alias("tokens"))


@query("text_clean", f"SELECT doc_id, {O.clean_sql()} AS clean FROM documents")
def q_text_clean(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.clean_text("text").alias("clean"))


@query("text_to_ids", f"SELECT * FROM ({O.token_ids_sql(O.tokens_sql(), 64, tail=False)})")
def q_text_to_ids(spark, sf):
    docs = table(spark, sf, "documents")
    vocab = tx.build_vocabulary(docs, "text")
    ids = tx.token_ids(docs, "doc_id", "text", vocab, max_len=HEAD_MAX_LEN, truncate="head", max_vocab=HELD_VOCAB)
    return ids.select("doc_id", F.array_join("ids", ",").alias("ids"))


@query("text_to_ids_tail", f"SELECT * FROM ({O.token_ids_sql(O.tokens_sql(O.clean_sql()), 100, tail=True)})")
def q_text_to_ids_tail(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", tx.clean_text("text").alias("clean"))
    vocab = tx.build_vocabulary(docs, "clean")
    ids = tx.token_ids(docs, "doc_id", "clean", vocab, max_len=TAIL_MAX_LEN, truncate="tail", max_vocab=HELD_VOCAB)
    return ids.select("doc_id", F.array_join("ids", ",").alias("ids"))


@query("text_to_ids_split", f"SELECT * FROM ({O.token_ids_sql(O.tokens_sql(), 64, tail=False)})")
def q_text_to_ids_split(spark, sf):
    """The same ids when a worker may hold 1,000 words only: looked up by a join that splits off heavy words."""
    docs = table(spark, sf, "documents")
    ids = tx.token_ids(docs, "doc_id", "text", tx.build_vocabulary(docs, "text"), max_len=HEAD_MAX_LEN, truncate="head", max_vocab=1000)
    return ids.select("doc_id", F.array_join("ids", ",").alias("ids"))


@query("text_to_ids_known", O.known_ids_sql(O.tokens_sql(O.clean_sql()), 100))
def q_text_to_ids_known(spark, sf):
    """A tokenizer fitted on the labelled documents, applied to all: words it does not know are dropped
    before the last 100 are kept."""
    docs = table(spark, sf, "documents").select("doc_id", tx.clean_text("text").alias("clean"))
    labelled = rows_of(docs, table(spark, sf, "labels"), "doc_id")
    ids = tx.token_ids(docs, "doc_id", "clean", tx.build_vocabulary(labelled, "clean"), max_len=TAIL_MAX_LEN, truncate="tail",
                       oov="drop", max_vocab=HELD_VOCAB)
    return ids.select("doc_id", F.array_join("ids", ",").alias("ids"))


# ------------------------------------------------------------ number topic

def _numbers(spark, sf):
    return number_messages(table(spark, sf, "events"))


NUMBER_TOPIC_SQL = """SELECT 'numbers' AS topic, CAST(0 AS INTEGER) AS partition, event_id AS offset,
    ts AS timestamp, '{"number": ' || CAST(event_id AS VARCHAR) || '}' AS value FROM events"""


@query("batch_envelope_scan", NUMBER_TOPIC_SQL)
def q_batch_envelope_scan(spark, sf):
    env = _numbers(spark, sf)
    return env.select("topic", "partition", "offset", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
                      F.col("value").cast("string").alias("value"))


def _project(env):
    return env.select("topic", "offset", F.col("value").cast("string").substr(12, 1).alias("rand_number"))


def _parity(env):
    full = F.from_json(F.col("value").cast("string"), "number BIGINT")["number"]
    return _project(env.withColumn("number", full)).withColumn(
        "Is_Even", F.expr("try_cast(rand_number AS INT)") % 2 == 0)


PROJECT_SQL = f"SELECT topic, \"offset\", substr(value, 12, 1) AS rand_number FROM ({NUMBER_TOPIC_SQL})"
PARITY_SQL = f"SELECT *, TRY_CAST(rand_number AS INTEGER) % 2 = 0 AS Is_Even FROM ({PROJECT_SQL})"


@query("envelope_project", PROJECT_SQL)
def q_envelope_project(spark, sf):
    return _project(_numbers(spark, sf))


@query("number_parity", PARITY_SQL)
def q_number_parity(spark, sf):
    return _parity(_numbers(spark, sf)).select("topic", "offset", "rand_number", "Is_Even")


@query("digit_counts", f"SELECT rand_number, count(*) AS count FROM ({PROJECT_SQL}) GROUP BY rand_number")
def q_digit_counts(spark, sf):
    return _project(_numbers(spark, sf)).groupBy("rand_number").count()


# ------------------------------------------------------------ messages

@query("json_encode_rows", "SELECT doc_id, to_json({'id': doc_id, 'review': text})::VARCHAR AS value FROM documents")
def q_json_encode_rows(spark, sf):
    env = review_messages(table(spark, sf, "documents"))
    return env.select(F.col("offset").alias("doc_id"), F.col("value").cast("string").alias("value"))


@query("encode_labelled", f"""
    SELECT "offset" AS doc_id, to_json({{'review_text': review_text, {', '.join(f"'{a}': {a}" for a in ASPECTS)}}})::VARCHAR AS value
    FROM ({O.labelled_sql()})""")
def q_encode_labelled(spark, sf):
    env = labelled_messages(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return env.select(F.col("offset").alias("doc_id"), F.col("value").cast("string").alias("value"))


@query("parse_labelled", f"SELECT * FROM ({O.labelled_sql()})")
def q_parse_labelled(spark, sf):
    return parsed_labelled(spark, sf).select("offset", "review_text", *ASPECTS)


def _mixed_topic(spark, sf):
    """Review messages (partition 0) and raw page payloads (partition 1) on one topic."""
    reviews = review_messages(table(spark, sf, "documents"), topic="reviews")
    pages = payload_messages(table(spark, sf, "pages"), topic="reviews").withColumn("partition", F.lit(1))
    return reviews.unionByName(pages)


@query("dead_letter", """
    SELECT 'reviews' AS topic, CAST(1 AS INTEGER) AS partition, page_id AS offset,
           CASE WHEN html IS NULL THEN 'empty_payload' ELSE 'malformed_json' END AS reason,
           CAST(coalesce(strlen(html), 0) AS BIGINT) AS payload_bytes
    FROM pages""")
def q_dead_letter(spark, sf):
    _, bad = split_dead_letter(parse_envelope(_mixed_topic(spark, sf), REVIEW_DDL, keep=("topic", "partition", "offset")))
    return bad.drop("payload")


@query("binary_payload_profile", """
    SELECT page_id AS offset, url AS key, CAST(strlen(html) AS BIGINT) AS n_bytes, md5(html) AS md5 FROM pages""")
def q_binary_payload_profile(spark, sf):
    env = payload_messages(table(spark, sf, "pages"))
    return env.select("offset", F.col("key").cast("string").alias("key"),
                      F.octet_length("value").cast("bigint").alias("n_bytes"), F.md5("value").alias("md5"))


# ------------------------------------------------------------ model outputs

def _decoded(spark, sf):
    """A 64-value vector holds two model outputs of 8 heads x 4 classes: one row per (vec_id, half)."""
    emb = table(spark, sf, "embeddings")
    size = len(ASPECTS) * 4
    each = emb.select("vec_id", "label", "embedding", F.explode(F.expr(
        f"transform(sequence(1, cast(size(embedding) / {size} as int)), i -> cast(i - 1 as int))")).alias("half"))
    probs = each.select("vec_id", "label", "half", arr.group_flat(
        F.slice("embedding", F.col("half") * size + 1, size)).alias("probs"))
    return probs.select("vec_id", "label", "half",
                        *[arr.argmax(arr.head("probs", i)).alias(f"idx_{a}") for i, a in enumerate(ASPECTS)])


_HALVES = "(SELECT *, CAST(unnest(range(len(embedding) // 32)) AS INTEGER) AS half FROM embeddings)"


def _idx_sql(i: int) -> str:
    g = f"embedding[half * 32 + {4 * i + 1}:half * 32 + {4 * i + 4}]"
    return f"CAST(list_position({g}, list_max({g})) - 1 AS INTEGER)"


@query("argmax_decode", f"SELECT vec_id, label, half, {', '.join(f'{_idx_sql(i)} AS idx_{a}' for i, a in enumerate(ASPECTS))} FROM {_HALVES}")
def q_argmax_decode(spark, sf):
    return _decoded(spark, sf)


@query("labels_decode", f"""SELECT vec_id, label, half, {', '.join(
    f"CAST(CASE {_idx_sql(ASPECTS.index(a))} WHEN 0 THEN -1 WHEN 1 THEN 0 WHEN 2 THEN 1 WHEN 3 THEN 2 ELSE -99 END AS INTEGER) AS pred_{a}"
    for a in PRED_ORDER)} FROM {_HALVES}""")
def q_labels_decode(spark, sf):
    dec = _decoded(spark, sf)
    dec = dec.withColumns({f"pred_{a}": arr.index_to_label(F.col(f"idx_{a}")) for a in ASPECTS})
    return dec.select("vec_id", "label", "half", *[f"pred_{a}" for a in PRED_ORDER])


# ------------------------------------------------------------ evaluation

EVAL_PAIRS = [(a, a, f"pred_{a}") for a in ASPECTS]


@query("eval_metrics", O.eval_metrics_sql())
def q_eval_metrics(spark, sf):
    return M.eval_metrics(labelled_predictions(spark, sf), EVAL_PAIRS)


@query("eval_macro", O.eval_macro_sql())
def q_eval_macro(spark, sf):
    return M.eval_macro(M.eval_metrics(labelled_predictions(spark, sf), EVAL_PAIRS, digits=None))


@query("eval_metrics_stream", O.eval_metrics_sql())
def q_eval_metrics_stream(spark, sf):
    """The evaluation kept up to date by a stream: confusion counts are its state, metrics are derived from them."""
    env = labelled_messages(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return M.metrics_of(ST.confusion_stream(spark, env, "eval_metrics_stream", EVAL_PAIRS), ASPECTS)


# ------------------------------------------------------------ sample / preview / latest

@query("sample_top_n", f"SELECT id, {', '.join(ASPECTS)} FROM ({O.lexicon_scored_sql()}) ORDER BY md5(id) LIMIT 300")
def q_sample_top_n(spark, sf):
    return S.sample_rows(_dashboard(spark, sf), 300, ["id"]).select("id", *ASPECTS)


@query("batch_preview", f"""
    SELECT CAST(id AS BIGINT) AS offset, review, {', '.join(ASPECTS)},
           to_json({{'review': review, {', '.join(f"'{a}': {a}" for a in ASPECTS)}}})::VARCHAR AS preview_json
    FROM ({O.lexicon_scored_sql()}) ORDER BY CAST(id AS BIGINT) LIMIT 5""")
def q_batch_preview(spark, sf):
    rows = _dashboard(spark, sf).withColumnRenamed("src_offset", "offset")
    return S.preview(rows, 5, [F.col("offset")], ["offset", "review", *ASPECTS],
                     json_cols=["review", *ASPECTS])


@query("latest_rows", f"SELECT CAST(id AS BIGINT) AS offset, id, {', '.join(ASPECTS)} FROM ({O.lexicon_scored_sql()}) ORDER BY CAST(id AS BIGINT) DESC LIMIT 10")
def q_latest_rows(spark, sf):
    rows = _dashboard(spark, sf).withColumnRenamed("src_offset", "offset")
    return S.latest_rows(rows, 10, [F.desc("offset")]).select("offset", "id", *ASPECTS)


@query("batch_metrics", """
    SELECT 'reviews' AS topic, CAST(0 AS INTEGER) AS partition, count(*) AS n_rows,
           CAST(count(*) FILTER (WHERE text IS NULL) AS BIGINT) AS n_null_text,
           min(doc_id) AS min_offset, max(doc_id) AS max_offset FROM documents""")
def q_batch_metrics(spark, sf):
    return S.batch_counts(parsed_reviews(spark, sf), "review")


# ------------------------------------------------------------ series

def _series_env(spark, sf):
    return SR.series_messages(table(spark, sf, "events"), key="event_type", ts="ts", value="value", position="event_id")


SERIES_TEXT = "strftime(ts, '%Y-%m-%d %H:%M:%S.%f')"


@query("series_to_messages", f"""
    SELECT event_type AS key, event_id AS "offset", to_json(map([{SERIES_TEXT}], [value]))::VARCHAR AS value FROM events""")
def q_series_to_messages(spark, sf):
    env = _series_env(spark, sf)
    return env.select(F.col("key").cast("string").alias("key"), "offset", F.col("value").cast("string").alias("value"))


@query("series_parse", "SELECT event_type AS series, event_id AS \"offset\", ts, value FROM events")
def q_series_parse(spark, sf):
    return SR.parse_series(_series_env(spark, sf)).select("series", "offset", "ts", "value")


REPLAY_GAPS_SQL = """
    SELECT event_type AS series, event_id AS "offset", ts,
           coalesce(date_diff('microsecond', lag(ts) OVER w, ts) / 1e7, 0.0) AS gap_s,
           date_diff('microsecond', min(ts) OVER (PARTITION BY event_type), ts) / 1e7 AS offset_s
    FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)"""


@query("replay_gaps", REPLAY_GAPS_SQL)
def q_replay_gaps(spark, sf):
    pts = SR.parse_series(_series_env(spark, sf))
    out = SR.replay_gaps(pts, key="series", ts="ts", tiebreak="offset", speed=10.0)
    # gaps are whole microseconds / speed: exact doubles, no rounding needed
    return out.select("series", "offset", "ts", "gap_s", "offset_s")


@query("series_csv_scan", f"SELECT {SERIES_TEXT} AS timestamp, value FROM events")
def q_series_csv_scan(spark, sf):
    ev = table(spark, sf, "events").select(SR.ts_text(F.col("ts")).alias("timestamp"), "value")
    path = FS.write_csv(ev, fresh_path(spark, "series_csv_scan"))
    return FS.read_series_csv(spark, path)


@query("csv_scan_typed", "SELECT doc_id AS id, text AS review, lang FROM documents")
def q_csv_scan_typed(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    path = FS.write_csv(docs, fresh_path(spark, "csv_scan_typed"))
    back = FS.require_columns(FS.read_csv(spark, path, "doc_id BIGINT, text STRING, lang STRING"), ["doc_id", "lang"])
    return back.select(F.col("doc_id").alias("id"), FS.text_column(back).alias("review"), "lang")


@query("csv_dead_letter", """
    SELECT doc_id AS id, text AS review, lang, CAST(NULL AS VARCHAR) AS reason, CAST(NULL AS BIGINT) AS page FROM documents
    UNION ALL SELECT NULL, NULL, NULL, 'malformed_row', page_id FROM pages""")
def q_csv_dead_letter(spark, sf):
    """Review lines with broken lines among them (a page in a row's place: no number in front, a value too many)."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    broken = table(spark, sf, "pages").select(F.concat(F.lit("page "), F.col("page_id")).alias("id"), "html", F.lit("x").alias("a"), F.lit("y").alias("b"))
    path = fresh_path(spark, "csv_dead_letter")
    docs.select(FS.csv_lines(docs)).union(broken.select(FS.csv_lines(broken))).write.text(path)
    rows, dead = FS.read_csv_lines(spark, path, "id BIGINT, review STRING, lang STRING")
    dead = dead.select(F.lit(None).cast("bigint").alias("id"), F.lit(None).cast("string").alias("review"), F.lit(None).cast("string").alias("lang"),
                       "reason", F.regexp_extract("payload", "^page ([0-9]+),", 1).cast("bigint").alias("page"))
    return rows.select("*", F.lit(None).cast("string").alias("reason"), F.lit(None).cast("bigint").alias("page")).unionByName(dead)


# ------------------------------------------------------------ streaming

@query("stream_envelope_scan", NUMBER_TOPIC_SQL)
def q_stream_envelope_scan(spark, sf):
    path = ST.topic_files(spark, _numbers(spark, sf), "stream_envelope_scan")
    src = stream_envelope_files(spark, path)
    proj = src.select("topic", "partition", "offset", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
                      F.col("value").cast("string").alias("value"))
    return ST.drain_to_lake(spark, proj, "stream_envelope_scan")


@query("stream_two_queries", PARITY_SQL)
def q_stream_two_queries(spark, sf):
    numbers, parity = ST.two_queries(spark, _numbers(spark, sf), "stream_two_queries")
    return numbers.join(parity.select("topic", "offset", "Is_Even"), ["topic", "offset"])


@query("stream_score", f"SELECT id, {', '.join(ASPECTS)} FROM ({O.lexicon_scored_sql()})")
def q_stream_score(spark, sf):
    path = ST.topic_files(spark, review_messages(table(spark, sf, "documents")), "stream_score")
    scored = ST.score_stream(stream_envelope_files(spark, path))
    return ST.drain_to_lake(spark, scored.select("id", *ASPECTS), "stream_score")


JDBC_SQL = f"SELECT CAST(id AS BIGINT) AS src_offset, review AS ReviewText, {', '.join(ASPECTS)} FROM ({O.lexicon_scored_sql()})"


@query("jdbc_round_trip", JDBC_SQL)
def q_jdbc_round_trip(spark, sf):
    back = ST.jdbc_stream(spark, review_messages(table(spark, sf, "documents")), "jdbc_round_trip", replay_batches=False)
    return back.select("src_offset", F.col("ReviewText").cast("string").alias("ReviewText"), *[F.col(a).cast("string").alias(a) for a in ASPECTS])


@query("jdbc_retry_dedup", JDBC_SQL)
def q_jdbc_retry_dedup(spark, sf):
    back = ST.jdbc_stream(spark, review_messages(table(spark, sf, "documents")), "jdbc_retry_dedup", replay_batches=True)
    return back.select("src_offset", F.col("ReviewText").cast("string").alias("ReviewText"), *[F.col(a).cast("string").alias(a) for a in ASPECTS])


@query("results_recovered", JDBC_SQL)
def q_results_recovered(spark, sf):
    """Stored results after a consumer died between write and commit and another one read the topic again."""
    table_ = ST.recovery_drill(spark, review_messages(table(spark, sf, "documents")), "results_recovered")
    return table_.read(spark).select("src_offset", F.col("review").alias("ReviewText"), *ASPECTS)


@query("observed_metrics", """
    SELECT count(*) AS n_rows, count(*) FILTER (WHERE text IS NULL) AS null_review, count(*) FILTER (WHERE doc_id IS NULL) AS null_id
    FROM documents""")
def q_observed_metrics(spark, sf):
    """Rows and null fields as the batches that stored the reviews observed them; no row is read again."""
    batches = ST.kept_reviews(spark, sf).batches(spark)
    return batches.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint").alias("n_rows"), *null_totals(batches, ["review", "id"]))


@query("live_view", f"""
    WITH documents AS (SELECT doc_id, CASE WHEN length(text) > 500 THEN replace(text, '.', ' not.') ELSE text END AS text
                       FROM main.documents WHERE text IS NOT NULL AND doc_id IS NOT NULL),
    sc AS ({O.lexicon_scored_sql()}),
    long AS ({' UNION ALL '.join(f"SELECT '{a}' AS Aspect, coalesce({a}, 'NONE') AS Sentiment FROM sc" for a in ASPECTS)})
    SELECT Aspect, Sentiment, count(*) AS Count FROM long GROUP BY 1, 2""")
def q_live_view(spark, sf):
    """Counts over the latest review per id, where the authors of longer reviews send a second version: the view
    after the last batch is a sum of signed deltas."""
    docs = table(spark, sf, "documents").where("doc_id is not null")
    again = docs.where("length(text) > 500").withColumn("text", F.replace("text", F.lit("."), F.lit(" not.")))
    first, second = review_messages(docs), review_messages(again)
    last = docs.agg(F.coalesce(F.max("doc_id"), F.lit(0)) + 1).first()[0]
    topic = first.unionByName(second.withColumn("offset", F.col("offset") + last))
    path, _ = ST.live_view(spark, topic, "live_view")
    return live_counts(spark, path).select(F.col("name").alias("Aspect"), F.col("value").alias("Sentiment"), F.col("count").alias("Count"))


@query("stream_cnn_to_table")
def q_stream_cnn_to_table(spark, sf):
    """The model pipeline end to end: review topic -> parse -> CNN over the whole
    vocabulary -> relational table (idempotent per batch) -> read back."""
    docs = table(spark, sf, "documents")
    scorer = ST.cnn_artefacts(spark, docs)
    back = ST.jdbc_stream(spark, review_messages(docs), "stream_cnn_to_table", replay_batches=False, scorer=scorer)
    return back.select("src_offset", F.col("ReviewText").cast("string").alias("ReviewText"),
                       *[F.col(a).cast("string").alias(a) for a in ASPECTS])


@query("document_sink", 'SELECT event_id AS number, CAST(0 AS INTEGER) AS partition, event_id AS "offset" FROM events')
def q_document_sink(spark, sf):
    docs = ST.document_stream(spark, _numbers(spark, sf), "document_sink", NUMBER_DDL)
    return docs.select(F.col("number").cast("bigint").alias("number"), F.col("partition").cast("int").alias("partition"),
                       F.col("offset").cast("bigint").alias("offset"))


# ------------------------------------------------------------ event-time windows

@query("events_tumbling", """
    SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
           event_type, count(*) AS n, round(sum(value), 6) AS total
    FROM events GROUP BY 1, 2, 3""")
def q_events_tumbling(spark, sf):
    return TR.tumbling(table(spark, sf, "events"), "ts", "1 hour", ["event_type"], "value")


@query("events_tumbling_stream", """
    SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
           event_type, count(*) AS n, round(sum(value), 6) AS total
    FROM events GROUP BY 1, 2, 3""")
def q_events_tumbling_stream(spark, sf):
    """Hourly counts as a streaming aggregate in update mode with a 2-hour watermark: the state store holds the
    windows of the last hours only, changed windows are stored as versions."""
    ev = ST.table_stream(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    res = ST.changed_windows(spark, ev, "events_tumbling_stream", "1 hour", "2 hours", ["event_type"], "value")
    res = res.withColumn("window_end", F.col("window_start") + F.expr("INTERVAL 1 HOUR"))
    return res.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                      F.col("window_end").cast("timestamp_ntz").alias("window_end"), "event_type", "n", "total")


@query("events_windows_late", SF.WINDOWS_LATE_SQL)
def q_events_windows_late(spark, sf):
    return SF.windows_with_late_rows(spark, sf)


@query("replay_gaps_stream", REPLAY_GAPS_SQL)
def q_replay_gaps_stream(spark, sf):
    return SF.gaps_from_stream(spark, sf)


@query("stream_dedup", NUMBER_TOPIC_SQL)
def q_stream_dedup(spark, sf):
    return SF.redelivered_numbers(spark, sf)


@query("sentiment_trend", f"""
    WITH sc AS ({O.lexicon_scored_sql()}),
    j AS (SELECT time_bucket(INTERVAL 1 HOUR, e.ts) AS window_start, sc.* FROM sc JOIN events e ON CAST(sc.id AS BIGINT) = e.event_id),
    long AS ({' UNION ALL '.join(f"SELECT window_start, '{a}' AS Aspect, coalesce({a}, 'NONE') AS Sentiment FROM j" for a in ASPECTS)})
    SELECT window_start, Aspect, Sentiment, count(*) AS Count FROM long GROUP BY 1, 2, 3""")
def q_sentiment_trend(spark, sf):
    scored = scored_reviews(spark, sf).withColumn("doc_id", F.col("id").cast("bigint"))
    ev = table(spark, sf, "events").select(F.col("event_id").alias("doc_id"), "ts")
    return TR.sentiment_over_time(scored.join(ev, "doc_id"), "ts", "1 hour")


# ------------------------------------------------------------ anomaly detection

def _transactions(spark, sf):
    """lineitem rows as transaction messages {"id", "data": [[quantity, price]], "current_time"}."""
    li = table(spark, sf, "lineitem")
    rec = li.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
        F.array(F.array(F.col("l_quantity"), F.col("l_extendedprice"))).alias("data"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("current_time"))
    return to_envelope(rec, encode_json("id", "data", "current_time"), "transactions", F.col("id"))


def _parsed_transactions(spark, sf):
    good, _ = split_dead_letter(parse_envelope(_transactions(spark, sf), TRANSACTION_DDL))
    return good


TX_SQL = """SELECT l_orderkey * 8 + l_linenumber AS id, l_quantity AS x, l_extendedprice AS y,
    strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.%f') AS current_time FROM lineitem"""


@query("transactions_parse", f"SELECT id, x, y, CAST(1 AS INTEGER) AS n_points, CAST(current_time AS TIMESTAMP) AS event_time FROM ({TX_SQL})")
def q_transactions_parse(spark, sf):
    tx_ = _parsed_transactions(spark, sf)
    return tx_.select("id", F.col("data")[0][0].alias("x"), F.col("data")[0][1].alias("y"),
                      F.size("data").cast("int").alias("n_points"),
                      SR.parse_timestamp(F.col("current_time")).alias("event_time"))


def _fixed_forest():
    return AN.Forest(FX.nodes_frame(), FX.PSI)


def _scored_transactions(spark, sf):
    tx_ = _parsed_transactions(spark, sf)
    return tx_.withColumn("scores", AN.score_points(spark, _fixed_forest(), F.col("data")))


def _scored_once(spark, sf):
    """The scored transactions, written to the shared folder: the threshold and the
    alerts read the same scores."""
    scored = _scored_transactions(spark, sf)
    path = fresh_path(spark, "transactions", "scored")
    scored.write.parquet(path)
    return spark.read.schema(scored.schema).parquet(path)


SCORES_SQL = f"""
    WITH p AS (SELECT *, row_number() OVER () AS rid FROM ({TX_SQL})),
    h AS (SELECT p.rid, avg(l.path_len) AS e_h FROM p JOIN {FX.leaves_values_sql()}
          ON p.x >= l.x_lo AND p.x < l.x_hi AND p.y >= l.y_lo AND p.y < l.y_hi GROUP BY p.rid)
    SELECT p.id, p.x, p.y, p.current_time, -pow(2.0, -h.e_h / {AN.c_factor(FX.PSI)!r}) AS score FROM p JOIN h ON p.rid = h.rid"""


@query("anomaly_scores", f"SELECT id, round(score, 6) AS score, round(score, 3) AS score_3 FROM ({SCORES_SQL})")
def q_anomaly_scores(spark, sf):
    s = F.get("scores", F.lit(0))
    return _scored_transactions(spark, sf).select("id", F.round(s, 6).alias("score"), F.round(s, 3).alias("score_3"))


@query("anomaly_threshold", f"SELECT round(quantile_cont(score, {FOREST_CONTAMINATION}), 6) AS threshold, count(*) AS n_train FROM ({SCORES_SQL})")
def q_anomaly_threshold(spark, sf):
    scored = _scored_once(spark, sf).select(F.get("scores", F.lit(0)).alias("score"))
    thr = AN.threshold(scored, "score", FOREST_CONTAMINATION)
    return scored.agg(F.count(F.lit(1)).alias("n_train")).select(F.round(F.lit(thr), 6).alias("threshold"), "n_train")


ANOMALY_ALERTS_SQL = f"""
    WITH s AS ({SCORES_SQL}), t AS (SELECT quantile_cont(score, {FOREST_CONTAMINATION}) AS thr FROM s)
    SELECT id, to_json({{'id': id, 'data': [[x, y]], 'current_time': current_time, 'score': [round(score, 3)]}})::VARCHAR AS value
    FROM s, t WHERE score < thr"""


@query("anomaly_alerts", ANOMALY_ALERTS_SQL)
def q_anomaly_alerts(spark, sf):
    scored = _scored_once(spark, sf)
    thr = AN.threshold(scored.select(F.get("scores", F.lit(0)).alias("score")), "score", FOREST_CONTAMINATION)
    return alert_records(scored, thr)


@query("anomaly_predict_saved", f"""
    WITH s AS ({SCORES_SQL}), t AS (SELECT quantile_cont(score, {FOREST_CONTAMINATION}) AS thr FROM s)
    SELECT id, CAST(CASE WHEN score < thr THEN -1 ELSE 1 END AS INTEGER) AS verdict FROM s, t""")
def q_anomaly_predict_saved(spark, sf):
    """Fix the threshold on the training scores, save it with the nodes, load the model, predict."""
    train = _scored_once(spark, sf).select(F.get("scores", F.lit(0)).alias("score"))
    path = fresh_path(spark, "forest", "model")
    AN.save(spark.createDataFrame(FX.nodes_frame()), path, FX.PSI, FX.FEATURES,
            AN.threshold(train, "score", FOREST_CONTAMINATION))
    nodes, meta = AN.load(spark, path)
    scores = AN.score_points(spark, AN.Forest.from_frame(nodes, meta["psi"]), F.col("data"))
    scored = _parsed_transactions(spark, sf).withColumn("scores", scores)
    return scored.select("id", AN.verdict(F.get("scores", F.lit(0)), meta["threshold"]).alias("verdict"))


def _lineitem_points(spark, sf):
    """lineitem with a row key (order, line, part, supplier) for per-tree hash sampling."""
    li = table(spark, sf, "lineitem")
    return li.withColumn("k", F.concat_ws("|", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))


def alert_records(scored: DataFrame, thr: float, any_point: bool = False) -> DataFrame:
    """Records whose first point (with ``any_point``: any of their points) scores below the threshold, as anomaly
    messages (the transaction plus the rounded score of every point)."""
    first = F.array_min("scores") if any_point else F.get("scores", F.lit(0))
    flagged = scored.filter(AN.verdict(first, thr) == -1)
    alerts = flagged.withColumn("score", F.transform("scores", lambda v: F.round(v, 3)))
    return alerts.select("id", encode_json("id", "data", "current_time", "score").alias("value"))


@query("anomaly_alerts_stream", ANOMALY_ALERTS_SQL)
def q_anomaly_alerts_stream(spark, sf):
    """Consume -> score -> filter -> produce as one streaming query (the alert
    topic is the lake sink offline; ``kafka_stream_writer`` publishes it live).
    The threshold comes from the training scores, computed before the stream."""
    train = _scored_once(spark, sf).select(F.get("scores", F.lit(0)).alias("score"))
    thr = AN.threshold(train, "score", FOREST_CONTAMINATION)
    path = ST.topic_files(spark, _transactions(spark, sf), "anomaly_alerts_stream")
    stream = stream_envelope_files(spark, path)
    good, _ = split_dead_letter(parse_envelope(stream, TRANSACTION_DDL))
    scored = good.withColumn("scores", AN.score_points(spark, _fixed_forest(), F.col("data")))
    return ST.drain_to_lake(spark, alert_records(scored, thr), "anomaly_alerts_stream")


@query("forest_fit")
def q_forest_fit(spark, sf):
    return AN.fit(_lineitem_points(spark, sf), FX.FEATURES, "k")


@query("anomaly_scores_fitted")
def q_anomaly_scores_fitted(spark, sf):
    pts = _lineitem_points(spark, sf)
    nodes = AN.fit(pts, FX.FEATURES, "k")  # written once to the shared folder, then read
    forest = AN.Forest.from_frame(nodes, 500)
    scored = pts.select("k", AN.score_points(spark, forest, F.array(F.array(*FX.FEATURES))).alias("s"))
    return scored.select("k", F.round(F.col("s")[0], 6).alias("score"))


@query("transactions_generate", """
    WITH e AS (SELECT min(l_quantity) AS q0, max(l_quantity) AS q1, min(l_extendedprice) AS p0, max(l_extendedprice) AS p1 FROM lineitem)
    SELECT l_orderkey * 8 + l_linenumber AS id, round((l_quantity - q0) / (q1 - q0) * 8 - 4, 3) + 0.0 AS x,
           round((l_extendedprice - p0) / (p1 - p0) * 8 - 4, 3) + 0.0 AS y, strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.%f') AS current_time
    FROM lineitem, e""")
def q_transactions_generate(spark, sf):
    """Transaction records from the lineitem rows: quantity and price laid on the square [-4, 4]^2, to 3 places."""
    li = table(spark, sf, "lineitem")
    e = li.agg(*[f(c).alias(n + c) for c in ("l_quantity", "l_extendedprice") for f, n in ((F.min, "lo_"), (F.max, "hi_"))]).first()
    x, y = [F.round((F.col(c) - F.lit(e["lo_" + c])) / F.lit(e["hi_" + c] - e["lo_" + c] if e["hi_" + c] is not None else None) * 8 - 4, 3)
            for c in ("l_quantity", "l_extendedprice")]
    rec = li.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"), F.array(F.array(x, y)).alias("data"),
                    F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("current_time"))
    return rec.select("id", F.col("data")[0][0].alias("x"), F.col("data")[0][1].alias("y"), "current_time")


# ------------------------------------------------------------ CNN scorer

@query("cnn_probabilities")
def q_cnn_probabilities(spark, sf):
    docs = table(spark, sf, "documents")
    scorer = WholeVocabularyCnn(spark, tx.build_vocabulary(docs, "text"), seed=42)
    out = widen(scorer.score(docs.select("doc_id", "text"), "text"))
    return out.select("doc_id", *ASPECTS)


@query("cnn_mapped")
def q_cnn_mapped(spark, sf):
    """The CNN with artefacts saved to files and mapped by the workers: a vocabulary of the labelled documents, unknown words
    dropped, the last 100 kept."""
    docs = table(spark, sf, "documents").select("doc_id", tx.clean_text("text").alias("clean"))
    labelled = rows_of(docs, table(spark, sf, "labels"), "doc_id")
    path = MP.save_model(spark, tx.build_vocabulary(labelled, "clean"), fresh_path(spark, "cnn_mapped"))
    scorer = MP.MappedCnn(path, TAIL_MAX_LEN, "tail", "drop")
    return widen(scorer.score(docs, "clean")).select("doc_id", *ASPECTS)


@query("cnn_eval_stream")
def q_cnn_eval_stream(spark, sf):
    """The labelled application as one stream: labelled topic -> clean text -> words of the fitted vocabulary, others dropped -> the
    last 100 -> CNN -> argmax -> labels -> confusion counts as state -> accuracy and F1."""
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    fitted = rows_of(docs, labels, "doc_id").select(tx.clean_text("text").alias("clean"))
    path = MP.save_model(spark, tx.build_vocabulary(fitted, "clean"), fresh_path(spark, "cnn_eval_stream"))
    scorer = MP.MappedCnn(path, TAIL_MAX_LEN, "tail", "drop", clean=True)
    return M.metrics_of(ST.confusion_stream(spark, labelled_messages(docs, labels), "cnn_eval_stream", EVAL_PAIRS, scorer), ASPECTS)
