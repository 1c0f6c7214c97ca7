"""Building blocks shared by the review queries (documents -> topic -> scored rows)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.json import LABELLED_DDL, REVIEW_DDL, parse_envelope, split_dead_letter
from ..operators.scoring import LexiconScorer, Scorer, widen
from ..sources.envelope import labelled_messages, review_messages
from .catalog import table


def review_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review_messages(table(spark, sf_dir, "documents"))


def parsed_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good review messages: topic, partition, offset, timestamp, id, review."""
    good, _ = split_dead_letter(parse_envelope(review_topic(spark, sf_dir), REVIEW_DDL))
    return good


def parsed_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    env = labelled_messages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    good, _ = split_dead_letter(parse_envelope(env, LABELLED_DDL))
    return good


def scored_reviews(spark: SparkSession, sf_dir: str, scorer: Scorer | None = None) -> DataFrame:
    """Parsed reviews with one sentiment column per aspect."""
    scorer = scorer or LexiconScorer()
    return widen(scorer.score(parsed_reviews(spark, sf_dir), "review"))


def flagship(spark: SparkSession, sf_dir: str, include_none: bool = False) -> DataFrame:
    from ..operators.metrics import sentiment_counts

    return sentiment_counts(scored_reviews(spark, sf_dir), include_none=include_none)


# --- fixed values: order of the prediction columns ---
PRED_ORDER = ["Quality", "Price", "Shipping", "Shop_Service", "Size", "Outlook", "General", "Others"]
# --- end of fixed values ---


def labelled_predictions(spark: SparkSession, sf_dir: str, scorer: Scorer | None = None) -> DataFrame:
    """``with_predictions`` of the labelled topic."""
    return with_predictions(parsed_labelled(spark, sf_dir), scorer)


def with_predictions(labelled: DataFrame, scorer: Scorer | None = None) -> DataFrame:
    """Truth and prediction side by side per aspect (label domain -1, 0, 1, 2):
    review_text, Price, pred_Price, Shipping, pred_Shipping, ..."""
    from ..config import ASPECTS
    from ..functions.arrays import sentiment_to_label

    scorer = scorer or LexiconScorer()
    scored = scorer.score(labelled, "review_text")
    m = F.col(scorer.output)
    preds = {f"pred_{a}": sentiment_to_label(m[F.lit(a)]) for a in ASPECTS}
    cols = ["offset", "review_text"] + [c for a in ASPECTS for c in (a, f"pred_{a}")]
    return scored.withColumns(preds).select(*cols)
