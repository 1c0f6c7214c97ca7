"""Dashboard aggregates (G3-G5) and label evaluation.

Every aggregate here is a single scan with a partial (map-side) aggregate:
the shuffle carries at most one row per partition per group, and the groups
are bounded by |aspects| x |sentiments| (x |classes| for the confusion counts),
so a hot value cannot skew a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import ASPECTS, DASHBOARD_SENTIMENTS


def _sentiment_list(include_none: bool) -> list[str]:
    return DASHBOARD_SENTIMENTS + (["NONE"] if include_none else [])


def sentiment_counts(df: DataFrame, aspects: list[str] = ASPECTS, include_none: bool = False) -> DataFrame:
    """(Aspect, Sentiment, Count) for every aspect column present x every listed
    sentiment, zero-filled; a null sentiment counts as NONE."""
    sents = _sentiment_list(include_none)
    present = [a for a in aspects if a in df.columns]
    cells = [(a, s) for a in present for s in sents]
    if not cells:  # no aspect column at all: an empty table with the same schema
        return df.sparkSession.createDataFrame([], "Aspect STRING, Sentiment STRING, Count BIGINT")
    one_row = df.agg(*[
        F.count_if(F.coalesce(F.col(a), F.lit("NONE")) == F.lit(s)).alias(f"c{i}")
        for i, (a, s) in enumerate(cells)
    ])
    stack_args = ", ".join(f"'{a}', '{s}', c{i}" for i, (a, s) in enumerate(cells))
    return one_row.selectExpr(f"stack({len(cells)}, {stack_args}) AS (Aspect, Sentiment, Count)").select(
        "Aspect", "Sentiment", F.col("Count").cast("bigint").alias("Count")
    )


def sentiment_totals(stats: DataFrame) -> DataFrame:
    """(Sentiment, Count) summed over aspects."""
    return stats.groupBy("Sentiment").agg(F.sum("Count").cast("bigint").alias("Count"))


def sentiment_share(totals: DataFrame, digits: int = 6) -> DataFrame:
    """(Sentiment, Count, Share); shares sum to 1, or are 0 when nothing was counted.
    The window has no key on purpose: its input is at most one row per sentiment."""
    total = F.sum("Count").over(Window.partitionBy())
    share = F.when(total > 0, F.col("Count") / total).otherwise(F.lit(0.0))
    return totals.select("Sentiment", "Count", F.round(share, digits).alias("Share"))


# ------------------------------------------------------------- evaluation

def confusion_counts(df: DataFrame, pairs: list[tuple[str, str, str]]) -> DataFrame:
    """(Aspect, label, prediction, n) for rows where both are non-null.
    ``pairs`` = [(aspect, truth column, prediction column)]."""
    rows = F.array(*[
        F.struct(F.lit(a).alias("Aspect"), F.col(t).cast("double").alias("label"), F.col(p).cast("double").alias("prediction"))
        for a, t, p in pairs
    ])
    long = df.select(F.inline(rows)).na.drop(subset=["label", "prediction"])
    return long.groupBy("Aspect", "label", "prediction").agg(F.count(F.lit(1)).alias("n"))


def eval_metrics(df: DataFrame, pairs: list[tuple[str, str, str]], digits: int | None = 6) -> DataFrame:
    """``metrics_of`` the confusion counts of a frame with truth and prediction columns."""
    return metrics_of(confusion_counts(df, pairs), [a for a, _, _ in pairs], digits)


def metrics_of(confusion: DataFrame, aspects: list[str], digits: int | None = 6) -> DataFrame:
    """Per aspect: n, accuracy and support-weighted F1 (the ``f1`` of Spark's
    multiclass evaluator: sum over true classes k of n_k/N * 2 tp_k / (n_k + m_k)),
    from counts (Aspect, label, prediction, n). Aspects without labelled rows are
    reported with n = 0 and null metrics; ``digits=None`` leaves the values unrounded.

    Each cell adds to two classes: the true one (n_k, tp_k) and the predicted one (m_k)."""
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    none = F.lit(0).cast("long")
    cells = F.array(
        F.struct(F.col("label").alias("k"), F.col("n").alias("n"), none.alias("m"), hit.alias("tp")),
        F.struct(F.col("prediction").alias("k"), none.alias("n"), F.col("n").alias("m"), none.alias("tp")),
    )
    # every aspect appears once with no class, so aspects without labels are kept
    names = confusion.sparkSession.createDataFrame([(a, None, 0, 0, 0) for a in aspects], "Aspect STRING, k DOUBLE, n LONG, m LONG, tp LONG")
    per_class = confusion.select("Aspect", F.inline(cells)).unionByName(names).groupBy("Aspect", "k").agg(
        F.sum("n").alias("n_k"), F.sum("m").alias("m_k"), F.sum("tp").alias("tp_k"))
    f1_k = F.when(F.col("tp_k") > 0, 2.0 * F.col("tp_k") / (F.col("n_k") + F.col("m_k"))).otherwise(F.lit(0.0))
    per_aspect = per_class.groupBy("Aspect").agg(
        F.sum("n_k").alias("n"), F.sum("tp_k").alias("tp"), F.sum(F.col("n_k") * f1_k).alias("wf1"))
    ratios = {"accuracy": F.when(F.col("n") > 0, F.col("tp") / F.col("n")), "f1": F.when(F.col("n") > 0, F.col("wf1") / F.col("n"))}
    return per_aspect.select("Aspect", F.col("n").cast("bigint").alias("n"),
                             *[(v if digits is None else F.round(v, digits)).alias(name) for name, v in ratios.items()])


def eval_macro(per_aspect: DataFrame, digits: int = 6) -> DataFrame:
    """Mean accuracy and mean F1 over the aspects that have labelled rows; rounded here only, so give it unrounded metrics."""
    has = F.col("n") > 0
    return per_aspect.agg(
        F.count_if(has).cast("bigint").alias("n_aspects"),
        F.round(F.avg(F.when(has, F.col("accuracy"))), digits).alias("avg_accuracy"),
        F.round(F.avg(F.when(has, F.col("f1"))), digits).alias("avg_f1"),
    )
