"""Batch scoring of feature tables and of request rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.operators.encoding import alignment_table
from stayline.operators.metrics import THRESHOLD, predicted_class
from stayline.plans.training import model_input, with_probability
from stayline.schemas import OPTIONAL_REQUEST_FIELDS, REQUEST_DUMMIES, REQUIRED_REQUEST_FIELDS

NOT_LOADED = "Model not loaded."


def first_missing(fields: Sequence[str]) -> Column:
    """Message naming the first required field that is null, or null."""
    message = F.lit(None).cast("string")
    for f in reversed(fields):
        message = F.when(F.col(f"`{f}`").isNull(), F.lit(f"Field required: {f}")).otherwise(message)
    return message


def with_request_defaults(requests: DataFrame) -> DataFrame:
    defaults = {
        name: F.coalesce(F.col(name), F.lit(value)) if name in requests.columns else F.lit(value)
        for name, value in OPTIONAL_REQUEST_FIELDS
    }
    return requests.withColumns(defaults)


def score_batch(
    rows: DataFrame,
    model: PipelineModel | None,
    features: Sequence[str],
    keep: Sequence[str] = ("userId",),
    required: Sequence[str] = tuple(name for name, _ in REQUIRED_REQUEST_FIELDS),
    threshold: float = THRESHOLD,
) -> DataFrame:
    """churn_prediction, churn_probability and error for every input row.

    A row that lacks a required field gets an error and no prediction; without a
    model every row gets an error.
    """
    present = [f for f in required if f in rows.columns]
    absent = [f for f in required if f not in rows.columns]
    error = first_missing(present)
    if absent:
        error = F.lit(f"Field required: {next(f for f in required if f in absent)}")
    if model is None:
        error = F.lit(NOT_LOADED)
    # Features and kept columns may share names; the error is computed beforehand.
    checked = rows.withColumn("_error", error.cast("string"))
    if model is None:
        scored = checked.select(*keep, "_error").withColumn("score", F.lit(None).cast("double"))
    else:
        scored = with_probability(model, model_input(checked, features, [*keep, "_error"]), threshold)
    return answers(scored, keep, threshold)


def answers(scored: DataFrame, keep: Sequence[str] = (), threshold: float = THRESHOLD) -> DataFrame:
    """Prediction, probability and error of rows with ``score`` and ``_error``."""
    valid = F.col("_error").isNull()
    return scored.select(
        *keep,
        F.when(valid, predicted_class("score", threshold)).alias("churn_prediction"),
        F.when(valid, F.col("score")).alias("churn_probability"),
        F.col("_error").alias("error"),
    )


def with_feature_names(requests: DataFrame, names: Mapping[str, str] = REQUEST_DUMMIES) -> DataFrame:
    """Request fields under the names of the training columns they stand for."""
    return requests.withColumnsRenamed({old: new for old, new in names.items() if old != new})


def score_requests(
    requests: DataFrame,
    model: PipelineModel | None,
    features: Sequence[str],
    keep: Sequence[str] = (),
    names: Mapping[str, str] = REQUEST_DUMMIES,
) -> DataFrame:
    """Score request records: optional fields take their defaults, then their features' names."""
    named = with_feature_names(with_request_defaults(requests), names)
    return score_batch(named, model, features, keep)


def request_alignment(
    requests: DataFrame, features: Sequence[str], names: Mapping[str, str] = REQUEST_DUMMIES
) -> DataFrame:
    """Training columns no request field fills, and fields no training column takes, with row counts."""
    return alignment_table(with_feature_names(with_request_defaults(requests), names), features)
