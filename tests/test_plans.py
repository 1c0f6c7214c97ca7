"""Plan-shape checks for the scale properties the README claims."""
import __spark_entry__ as E
from aspectra.plans.reviews import flagship
from conftest import SF0001


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dashboards_read_stored_scores_only(spark):
    p = plan(E.queries()["sentiment_counts"](spark, SF0001))
    assert "review" not in p.split("ReadSchema: ")[1].split(">")[0] and "Price:string" in p
    assert "from_json" not in p and "regexp" not in p and "partial_" in p


def test_flagship_prunes_columns_and_aggregates_partially(spark):
    p = plan(flagship(spark, SF0001))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in p or "struct<doc_id:bigint,text:string>" in p
    assert "partial_count" in p or "partial_" in p        # map-side aggregate before the shuffle


def test_message_parsed_once(spark):
    p = plan(E.queries()["transactions_parse"](spark, SF0001))
    assert p.count("from_json") == 1


def test_model_udf_runs_once(spark):
    from aspectra.plans import queries as Q

    # the filter on fresh scores does not run the model again ...
    assert plan(Q.alert_records(Q._scored_transactions(spark, SF0001), -0.5)).count("ArrowEvalPython") == 1
    # ... and the registered query filters the scores that its threshold was taken from
    p = plan(E.queries()["anomaly_alerts"](spark, SF0001))
    assert p.count("ArrowEvalPython") == 0 and "scores" in p


def test_vocabulary_bounded_before_broadcast(spark):
    from aspectra.functions import text as tx
    from aspectra.plans.catalog import table

    docs = table(spark, SF0001, "documents")
    assert "TakeOrderedAndProject" in plan(tx.build_vocabulary(docs, "text", size=5000))


def test_token_ids_are_not_shuffled(spark):
    p = plan(E.queries()["text_to_ids"](spark, SF0001))
    assert "Exchange hashpartitioning" not in p and "Join" not in p and p.count("ArrowEvalPython") == 1


def test_top_rows_need_no_sort_of_the_table(spark):
    for name in ("sample_top_n", "latest_rows", "batch_preview"):
        p = plan(E.queries()[name](spark, SF0001))
        assert "TakeOrderedAndProject" in p and "rangepartitioning" not in p
