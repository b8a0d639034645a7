"""Boosting that stops on AUC, with patience.

MLlib stops at the first round that does not lower the loss enough.  Here rows set apart
are scored after every round at once: one pass gives each row's margin for every number
of trees, and one aggregate the exact AUC of every round.  The ensemble is cut after the
best round that no later one beats within ``patience`` rounds.

MLlib cannot go on from a fitted ensemble, but its rounds do not depend on how many
follow.  So a fit is tried with few rounds and doubled until the rule stops it: together
no more than three times the rounds of the last fit, and never more than ``rounds`` at once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.operators.metrics import roc_auc
from stayline.plans.trees import tree_table, with_tree_values
from stayline.staging import staging_root


def staged_auc(margins: DataFrame, label: str = "churn") -> DataFrame:
    """(round, roc_auc) from rows of ``label`` and ``values``, the margin after every round."""
    rounds = margins.select(label, F.posexplode("values").alias("place", "score"))
    measured = roc_auc(rounds, label, by=["place"])
    return measured.select((F.col("place") + 1).alias("round"), "roc_auc")


def stopping_round(aucs: Sequence[float | None], patience: int) -> tuple[int, bool]:
    """The best round, from 1, and whether ``patience`` rounds went by without a better one.

    Ties go to the earlier round; rounds after the stop do not count.  Where a class is
    missing no round has an AUC, and all of them are kept.
    """
    if all(auc is None for auc in aucs):
        return len(aucs), False
    best, reached = 1, float("-inf")
    for number, auc in enumerate(aucs, 1):
        if auc is not None and auc > reached:
            best, reached = number, auc
        elif number - best >= patience:
            return best, True
    return best, False


def stopping_table(aucs: DataFrame, patience: int) -> DataFrame:
    """(round, roc_auc, is_counted, is_best): which rounds the rule looks at and which it keeps; a row a round."""
    rows = sorted(aucs.select("round", "roc_auc").collect())
    best, stopped = stopping_round([r.roc_auc for r in rows], patience)
    last = best + patience if stopped else len(rows)
    return aucs.select("round", "roc_auc", (F.col("round") <= last).alias("is_counted"), (F.col("round") == best).alias("is_best"))


def cut_after(model: PipelineModel, rounds: int) -> PipelineModel:
    """The same ensemble with its first trees only; it scores, saves and loads like any other."""
    *before, boosted = model.stages
    fitted = boosted._java_obj
    jvm, gateway = _gateway()
    trees = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    weights = gateway.new_array(jvm.double, rounds)
    for k, tree in enumerate(list(fitted.trees())[:rounds]):
        trees[k], weights[k] = tree, float(boosted.treeWeights[k])
    short = jvm.org.apache.spark.ml.classification.GBTClassificationModel(
        fitted.uid(), trees, weights, fitted.numFeatures(), fitted.numClasses()
    )
    short = fitted.copyValues(short, jvm.org.apache.spark.ml.param.ParamMap.empty())
    return PipelineModel([*before, GBTClassificationModel(short)])


def _gateway():
    from pyspark import SparkContext

    context = SparkContext._active_spark_context
    return context._jvm, context._gateway


def fit_with_patience(
    build, training: DataFrame, stopping: DataFrame, inputs: Sequence[str], rounds: int = 1000, patience: int = 100
) -> tuple[PipelineModel, DataFrame]:
    """The cut model and ``stopping_table`` of its rounds.

    ``build(n)`` gives the pipeline of n rounds, whose model reads the columns ``inputs``
    and whose last stage boosts; ``stopping`` rows are scored only.
    """
    if patience < 1:
        raise ValueError("patience is at least one round")
    context = training.sparkSession.sparkContext
    if not context.getCheckpointDir():
        # MLlib cuts the lineage of its rounds only where it has such a folder; hundreds of rounds need that.
        context.setCheckpointDir(staging_root(training.sparkSession))
    grown = min(rounds, 2 * patience)
    while True:
        model = build(grown).fit(training)
        margins = with_tree_values(stopping, tree_table(training.sparkSession, model.stages[-1]), inputs, ["churn"], running=True)
        table = stopping_table(staged_auc(margins), patience)
        rows = sorted(table.collect())
        best, stopped = stopping_round([r.roc_auc for r in rows], patience)
        if stopped or grown == rounds:
            kept = training.sparkSession.createDataFrame(rows, table.schema)
            return cut_after(model, min(best, len(model.stages[-1].trees))), kept
        grown = min(rounds, 2 * grown)
