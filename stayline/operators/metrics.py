"""Exact classification metrics over a scored table.

All of them take rows of (label, score), fold equal scores first and then work
on distinct scores with running totals that are spread over value ranges.
``by`` computes the metric per group, e.g. per model or per month.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.functions import safe_ratio
from stayline.operators.ranking import running_totals

THRESHOLD = 0.5


def predicted_class(score: Column | str, threshold: float = THRESHOLD) -> Column:
    score = F.col(score) if isinstance(score, str) else score
    return (score > F.lit(threshold)).cast("int")


def _by_score(df: DataFrame, label: str, score: str, by: Sequence[str]) -> DataFrame:
    return (
        df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(*by, F.col(score).alias("_score"))
        .agg(
            F.count_if(F.col(label) == 1).alias("_pos"),
            F.count_if(F.col(label) == 0).alias("_neg"),
        )
    )


def _ranked(
    df: DataFrame, label: str, score: str, by: Sequence[str], ranges: int | None
) -> DataFrame:
    """Distinct scores with counts of both classes at them, up to them and overall."""
    folded = _by_score(df, label, score, by)
    return running_totals(folded, "_score", ["_pos", "_neg"], by, ranges)


def _won_twice() -> Column:
    """Twice the (positive, negative) pairs won by the positives at a score.

    They beat the negatives below them and half of those that tie; an integer.
    """
    beaten = 2 * F.col("cum__neg") - F.col("_neg")
    return F.col("_pos").cast("decimal(19,0)") * beaten.cast("decimal(19,0)")


def _flagged_from_here() -> tuple[Column, Column]:
    """Positives and negatives whose score is at least this one."""
    return (
        F.col("total__pos") - F.col("cum__pos") + F.col("_pos"),
        F.col("total__neg") - F.col("cum__neg") + F.col("_neg"),
    )


def _pr_trapezoid() -> Column:
    """Area between this threshold and the next higher one.

    The counts above a distinct score are the running counts less its own, so no
    lag over the whole curve is needed; above the top the precision is 1.
    """
    hits, misses = _flagged_from_here()
    above_hits, above_all = hits - F.col("_pos"), hits + misses - F.col("_pos") - F.col("_neg")
    precision = safe_ratio(hits, hits + misses)
    precision_above = F.coalesce(F.try_divide(above_hits, above_all), F.lit(1.0))
    return safe_ratio("_pos", "total__pos") * (precision + precision_above) / F.lit(2.0)


def _auc_from(won: str, positives: str, negatives: str) -> Column:
    return F.try_divide(F.col(won), F.lit(2.0) * F.col(positives) * F.col(negatives))


def roc_auc(
    df: DataFrame,
    label: str = "churn",
    score: str = "score",
    by: Sequence[str] = (),
    ranges: int | None = None,
) -> DataFrame:
    """Area under the ROC curve; tied scores count one half.

    Exact integers up to the last division.  Null where a class is missing.
    """
    return _roc_auc_of(_ranked(df, label, score, by, ranges), by)


def roc_auc_of_counts(counts: DataFrame, by: Sequence[str] = (), ranges: int | None = None) -> DataFrame:
    """``roc_auc`` of rows that stand for many: ``score`` with its number of ``positives`` and ``negatives``."""
    folded = counts.groupBy(*by, F.col("score").alias("_score")).agg(
        F.sum("positives").alias("_pos"), F.sum("negatives").alias("_neg")
    )
    return _roc_auc_of(running_totals(folded, "_score", ["_pos", "_neg"], by, ranges), by)


def _roc_auc_of(ranked: DataFrame, by: Sequence[str]) -> DataFrame:
    summed = (
        ranked.groupBy(*by)
        .agg(
            F.sum(_won_twice()).cast("double").alias("_won"),
            F.max("total__pos").alias("positives"),
            F.max("total__neg").alias("negatives"),
        )
    )
    area = _auc_from("_won", "positives", "negatives").alias("roc_auc")
    return summed.select(*by, "positives", "negatives", area)


def pr_curve(
    df: DataFrame,
    label: str = "churn",
    score: str = "score",
    by: Sequence[str] = (),
    ranges: int | None = None,
) -> DataFrame:
    """Precision and recall at every distinct score taken as the threshold."""
    hits, misses = _flagged_from_here()
    return _ranked(df, label, score, by, ranges).select(
        *by,
        F.col("_score").alias("threshold"),
        hits.alias("true_positives"),
        (hits + misses).alias("flagged"),
        safe_ratio(hits, hits + misses).alias("precision"),
        safe_ratio(hits, "total__pos").alias("recall"),
    )


def pr_auc(
    df: DataFrame,
    label: str = "churn",
    score: str = "score",
    by: Sequence[str] = (),
    ranges: int | None = None,
) -> DataFrame:
    """Trapezoid area under the precision-recall curve from (recall 0, precision 1)."""
    ranked = _ranked(df, label, score, by, ranges)
    return ranked.groupBy(*by).agg(F.sum(_pr_trapezoid()).alias("pr_auc"))


def confusion(
    df: DataFrame,
    label: str = "churn",
    score: str = "score",
    by: Sequence[str] = (),
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Confusion counts, precision, recall, F1 and the shares of wrong calls."""
    predicted = predicted_class(score, threshold)
    actual = F.col(label)
    counted = df.groupBy(*by).agg(
        F.count_if((predicted == 1) & (actual == 1)).alias("tp"),
        F.count_if((predicted == 1) & (actual == 0)).alias("fp"),
        F.count_if((predicted == 0) & (actual == 1)).alias("fn"),
        F.count_if((predicted == 0) & (actual == 0)).alias("tn"),
    )
    return counted.withColumns(
        {
            **_rates(),
            "false_positive_share": safe_ratio("fp", F.col("fp") + F.col("tn")),
            "false_negative_share": safe_ratio("fn", F.col("fn") + F.col("tp")),
        }
    )


def _rates() -> dict[str, Column]:
    return {
        "precision": safe_ratio("tp", F.col("tp") + F.col("fp")),
        "recall": safe_ratio("tp", F.col("tp") + F.col("fn")),
        "f1": safe_ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")),
    }


def evaluate(
    df: DataFrame,
    label: str = "churn",
    score: str = "score",
    by: Sequence[str] = (),
    threshold: float = THRESHOLD,
    ranges: int | None = None,
) -> DataFrame:
    """ROC AUC, PR AUC, precision, recall and F1 from one ranking of the scores."""
    called = F.col("_score") > F.lit(threshold)
    summed = (
        _ranked(df, label, score, by, ranges)
        .groupBy(*by)
        .agg(
            F.sum(_won_twice()).cast("double").alias("_won"),
            F.sum(_pr_trapezoid()).alias("pr_auc"),
            F.max("total__pos").alias("positives"),
            F.max("total__neg").alias("negatives"),
            F.sum(F.when(called, F.col("_pos")).otherwise(0)).alias("tp"),
            F.sum(F.when(called, F.col("_neg")).otherwise(0)).alias("fp"),
        )
        .withColumn("fn", F.col("positives") - F.col("tp"))
        .withColumn("roc_auc", _auc_from("_won", "positives", "negatives"))
    )
    return summed.withColumns(_rates()).select(
        *by, "positives", "negatives", "roc_auc", "pr_auc", "precision", "recall", "f1"
    )


def run_metrics(
    df: DataFrame,
    run_id: str | None = None,
    label: str = "churn",
    score: str = "score",
    by: Sequence[str] = (),
) -> DataFrame:
    """Metric records (run_id, metric, value) to append to a metrics table.

    Give ``run_id``, or a ``run_id`` column in ``by`` to record several runs.
    """
    wide = evaluate(df, label, score, by).select(
        *by,
        F.col("roc_auc").alias("AUC_ROC"),
        F.col("f1").alias("F1_Score"),
        F.col("precision").alias("Precision"),
        F.col("recall").alias("Recall"),
        F.col("pr_auc").alias("PR_AUC"),
    )
    records = wide.unpivot(list(by), [c for c in wide.columns if c not in by], "metric", "value")
    if run_id is not None:
        records = records.withColumn("run_id", F.lit(run_id))
    return records.select("run_id", "metric", "value")


def promotion_gate(
    metrics: DataFrame,
    current: str,
    candidate: str,
    metric: str = "F1_Score",
    factor: float = 1.05,
) -> DataFrame:
    """Whether the candidate run's metric exceeds the current run's by ``factor``; one row.

    A run recorded again counts with its latest record (``recorded_at``).
    """
    if "recorded_at" not in metrics.columns:
        metrics = metrics.withColumn("recorded_at", F.lit(0))
    rows = metrics.where((F.col("metric") == metric) & F.col("run_id").isin(current, candidate))

    def latest(run: str) -> Column:
        return F.max_by("value", F.when(F.col("run_id") == run, F.struct("recorded_at", "value")))

    found = rows.groupBy("metric").agg(
        latest(current).alias("current_value"), latest(candidate).alias("candidate_value")
    )
    found = found.where(F.col("current_value").isNotNull() & F.col("candidate_value").isNotNull())
    return found.withColumn("promote", F.col("candidate_value") > F.lit(factor) * F.col("current_value"))


def prediction_share(history: DataFrame, score: str = "score", day: str = "day") -> DataFrame:
    """Share of users flagged per day of a scored history."""
    return (
        history.groupBy(day)
        .agg(F.count("*").alias("scored"), F.sum(predicted_class(score)).alias("flagged"))
        .withColumn("flagged_share", safe_ratio("flagged", "scored"))
    )


def delayed_metrics(
    history: DataFrame, labels: DataFrame, period: str, score: str = "score"
) -> DataFrame:
    """AUC and F1 per period once the true labels of a scored history are known."""
    judged = history.select("userId", period, score).join(labels.select("userId", "churn"), "userId")
    return evaluate(judged, "churn", score, [period]).drop("pr_auc")
