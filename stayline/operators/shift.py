"""Sudden shifts of what a model says, from its scored history.

Two views of each day against a baseline of the first days: the share of flagged users,
watched by cumulative sums, which add up small moves that last; and the whole
distribution of scores, by the population stability index.  Both reduce the history to a
few rows a day first; what is ordered by day after that is as long as the calendar.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stayline.functions import safe_ratio
from stayline.operators.metrics import prediction_share

BASELINE_DAYS = 7
#: In standard deviations of a day's share: moves that are let pass, and the sum that is an alert.
SLACK, LIMIT = 0.5, 5.0
BINS = 10
#: The customary bound above which a distribution has shifted.
PSI_LIMIT = 0.2


def _numbered(daily: DataFrame, day: str) -> DataFrame:
    return daily.withColumn("_number", F.row_number().over(W.orderBy(day)))


def shift_alerts(
    history: DataFrame,
    score: str = "score",
    day: str = "day",
    baseline_days: int = BASELINE_DAYS,
    slack: float = SLACK,
    limit: float = LIMIT,
) -> DataFrame:
    """(day, scored, flagged, flagged_share, baseline_share, raised, lowered, alert) of every day.

    ``raised`` and ``lowered`` are the cumulative sums of standardised moves up and down
    beyond ``slack``, from the first day after the baseline, each starting again at 0 where
    it would be negative: the plain sum less the lowest one so far.  ``alert`` is ``up`` or ``down``
    where one exceeds ``limit``, else null.  Days of the baseline add nothing.
    """
    past = W.orderBy(day).rowsBetween(W.unboundedPreceding, W.currentRow)
    numbered = _numbered(prediction_share(history, score, day), day)
    first = F.col("_number") <= baseline_days
    whole = W.partitionBy()
    base = safe_ratio(F.sum(F.when(first, F.col("flagged"))).over(whole), F.sum(F.when(first, F.col("scored"))).over(whole))
    based = numbered.withColumn("baseline_share", base)
    # a share of 0 or 1 is held a little off the edge, or one other call would be infinitely many deviations
    share = F.greatest(F.least("baseline_share", F.lit(0.999)), F.lit(0.001))
    move = (F.col("flagged_share") - F.col("baseline_share")) / F.sqrt(share * (1 - share) / F.col("scored"))
    told = based.withColumn("_move", F.when(first, F.lit(None).cast("double")).otherwise(move))
    for name, sign in (("raised", 1.0), ("lowered", -1.0)):
        step = F.coalesce(F.lit(sign) * F.col("_move") - F.lit(slack), F.lit(0.0))  # baseline: no move
        told = told.withColumn("_total", F.sum(step).over(past))
        told = told.withColumn(name, F.col("_total") - F.least(F.min("_total").over(past), F.lit(0.0)))
    alert = F.when(F.col("raised") > limit, "up").when(F.col("lowered") > limit, "down")
    return told.select(day, "scored", "flagged", "flagged_share", "baseline_share", "raised", "lowered", alert.alias("alert"))


def score_histogram(scored: DataFrame, by: list[str], score: str = "score", bins: int = BINS) -> DataFrame:
    """(by, bin, n): counts of scores in equal bins; they merge by adding, so they can be stored per day."""
    place = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    return scored.where(F.col(score).isNotNull()).groupBy(*by, place.alias("bin")).agg(F.count("*").alias("n"))


def stability_index(
    daily: DataFrame, baseline: DataFrame, day: str = "day", bins: int = BINS, limit: float = PSI_LIMIT
) -> DataFrame:
    """(day, scored, psi, shifted) of stored daily histograms against a stored baseline (bin, n), a row a bin.

    Half a score is added to every bin, so an empty one does not make the index infinite.
    """
    known = {row.bin: row.n for row in baseline.groupBy("bin").agg(F.sum("n").alias("n")).collect()}
    total = sum(known.values()) + 0.5 * bins
    counts = [F.sum(F.when(F.col("bin") == k, F.col("n")).otherwise(0)).alias(f"_{k}") for k in range(bins)]
    held = daily.groupBy(day).agg(F.sum("n").alias("scored"), *counts)
    index = F.lit(0.0)
    for k in range(bins):
        share, base = (F.col(f"_{k}") + 0.5) / (F.col("scored") + 0.5 * bins), (known.get(k, 0) + 0.5) / total
        index = index + (share - base) * F.ln(share / base)
    return held.select(day, "scored", index.alias("psi")).withColumn("shifted", F.col("psi") > limit)
