"""Deployment behind the gate: the candidate replaces the serving model only if it is better beyond doubt."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.operators.significance import REPLICATES, paired_bootstrap, significant_gate
from stayline.plans.training import (
    NOT_FEATURES,
    load_model,
    model_input,
    save_model,
    with_probability,
)
from stayline.sources.tables import MissingInput
from stayline.staging import stage


def both_scores(spark: SparkSession, rows: DataFrame, current: str, candidate: str) -> DataFrame:
    """userId, churn and the scores of two stored models; rows are numbered, so fan-out rows stay apart."""
    numbered = stage(rows.withColumn("row_id", F.monotonically_increasing_id()))
    found = None
    for name, path in (("current", current), ("candidate", candidate)):
        model, features = load_model(path, spark)
        keep = (*NOT_FEATURES, "row_id")
        scored = with_probability(model, model_input(numbered, features, keep)).select(*keep, F.col("score").alias(name))
        found = scored if found is None else found.join(scored.select("row_id", name), "row_id")
    return found


def promote(
    spark: SparkSession,
    rows: DataFrame,
    serving: str,
    candidate: str,
    metric: str = "f1",
    factor: float = 1.05,
    replicates: int = REPLICATES,
) -> dict[str, object]:
    """Compare both models on labelled rows neither was fitted on, and deploy; the decision as a record.

    Without a serving model the candidate is the first one and is deployed.
    """
    model, features = load_model(candidate, spark)
    try:
        load_model(serving, spark)
    except Exception as error:  # MLlib raises whatever its file system raises
        if not _is_missing(error):
            raise
        save_model(model, features, serving, spark)
        return {"metric": metric, "promote": True, "first": True}
    scored = stage(both_scores(spark, rows, serving, candidate))
    row = significant_gate(paired_bootstrap(scored, metric=metric, replicates=replicates, key="row_id"), factor).first()
    if row.promote:
        save_model(model, features, serving, spark)
    return {**row.asDict(), "first": False}


def _is_missing(error: Exception) -> bool:
    return isinstance(error, MissingInput) or "does not exist" in str(error) or "PATH_NOT_FOUND" in str(error)
