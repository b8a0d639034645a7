"""Two-sample Kolmogorov-Smirnov drift per feature."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.operators.ranking import counted_values, running_totals

ALERT_BELOW = 0.05
SERIES_TERMS = 20


def _kolmogorov_tail(stat: Column) -> Column:
    """Probability that the Kolmogorov statistic exceeds ``stat``.

    The alternating series converges at once for larger arguments; below 0.2 the
    probability is 1 to eleven digits.
    """
    terms = [
        F.lit(2.0 * (-1) ** (j - 1)) * F.exp(F.lit(-2.0 * j * j) * stat * stat)
        for j in range(1, SERIES_TERMS + 1)
    ]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return F.when(stat < 0.2, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), total)))


def ks_drift(
    reference: DataFrame,
    current: DataFrame,
    features: Sequence[str],
    alert_below: float = ALERT_BELOW,
    ranges: int | None = None,
) -> DataFrame:
    """Largest distance of the two samples' distribution functions per feature.

    Both samples are folded to one row per (feature, value) before any ordering.  A
    feature without values in a sample has no statistic and counts as drifted.
    """

    def side(df: DataFrame, name: str) -> DataFrame:
        counted = counted_values(df, features).withColumnRenamed("_n", name)
        return counted.withColumnRenamed("column", "feature")

    both = side(reference, "_old_n").join(side(current, "_new_n"), ["feature", "_value"], "full")
    counted = both.na.fill(0, ["_old_n", "_new_n"])
    ranked = running_totals(counted, "_value", ["_old_n", "_new_n"], ["feature"], ranges)
    gap = F.abs(
        F.try_divide("cum__old_n", "total__old_n") - F.try_divide("cum__new_n", "total__new_n")
    )
    measured = ranked.groupBy("feature").agg(
        F.max("total__old_n").alias("n_reference"),
        F.max("total__new_n").alias("n_current"),
        F.max(gap).alias("statistic"),
    )
    named = reference.sparkSession.createDataFrame([(f,) for f in features], "feature STRING")
    every = named.join(measured, "feature", "left").na.fill(0, ["n_reference", "n_current"])
    old, new = F.col("n_reference").cast("double"), F.col("n_current").cast("double")
    scaled = F.sqrt(F.try_divide(old * new, old + new)) * F.col("statistic")
    tail = F.when(F.col("statistic").isNotNull(), _kolmogorov_tail(scaled))
    return every.withColumn("p_value", tail).withColumn(
        "drifted", F.coalesce(F.col("p_value") < F.lit(alert_below), F.lit(True))
    )
