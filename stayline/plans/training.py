"""Model fitting, evaluation and storage."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.functions import hash_bucket
from stayline.operators.encoding import align
from stayline.operators.metrics import THRESHOLD, predicted_class, run_metrics
from stayline.operators.splitting import (
    SEED,
    stratified_split,
    with_balanced_weight,
    with_positive_weight,
)
from stayline.plans.boosting import fit_with_patience
from stayline.plans.forests import HistogramForest
from stayline.sources.tables import load_feature_list, save_feature_list
from stayline.staging import stage

NOT_FEATURES = ("userId", "churn")
#: Rows of a training task: at least so many, and ``ROOT_SHARE`` times the square root of all rows.
ROWS_PER_TASK, ROOT_SHARE = 20_000, 100


def feature_list(df: DataFrame, leave_out: Sequence[str] = NOT_FEATURES) -> list[str]:
    """The ordered training columns; the user id is no feature."""
    return [c for c in df.columns if c not in leave_out]


def _inputs(features: Sequence[str]) -> list[str]:
    """Column names a model reads: dummy names may hold dots, which MLlib rejects."""
    return [f"_f{position}" for position in range(len(features))]


def model_input(
    df: DataFrame, features: Sequence[str], keep: Sequence[str] = NOT_FEATURES
) -> DataFrame:
    """Kept columns and the aligned features under the names a model reads."""
    return align(df, features, keep).toDF(*keep, *_inputs(features))


def _assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(
        inputCols=_inputs(features), outputCol="features", handleInvalid="keep"
    )


def random_forest(
    features: Sequence[str],
    trees: int = 100,
    max_depth: int = 10,
    impurity: str = "gini",
    seed: int = SEED,
) -> Pipeline:
    """Random forest on balanced weights.  MLlib caps the depth at 30."""
    forest = HistogramForest(
        labelCol="churn",
        weightCol="weight",
        numTrees=trees,
        maxDepth=max_depth,
        impurity=impurity,
        featureSubsetStrategy="sqrt",
        seed=seed,
    )
    return Pipeline(stages=[_assembler(features), forest])


def gradient_boosting(
    features: Sequence[str],
    rounds: int = 1000,
    step: float = 0.05,
    max_depth: int = 5,
    column_share: float = 0.8,
    row_share: float = 0.8,
    tolerance: float = 0.001,
    validation: str | None = "is_stop",
    seed: int = SEED,
) -> Pipeline:
    """Boosted trees; stops early when the loss on ``validation`` rows stalls.

    Depth 5 stands for at most 32 leaves.  MLlib has no L1/L2 penalty on leaves.
    """
    boosting = GBTClassifier(
        labelCol="churn",
        weightCol="weight",
        maxIter=rounds,
        stepSize=step,
        maxDepth=max_depth,
        featureSubsetStrategy=str(column_share),
        subsamplingRate=row_share,
        validationTol=tolerance,
        seed=seed,
    )
    if validation:
        boosting = boosting.setValidationIndicatorCol(validation)
    return Pipeline(stages=[_assembler(features), boosting])


def logistic_regression(features: Sequence[str]) -> Pipeline:
    regression = LogisticRegression(labelCol="churn", weightCol="weight", maxIter=50)
    return Pipeline(stages=[_assembler(features), regression])


def with_probability(model: PipelineModel, df: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Add ``score``, the probability of churn, and ``prediction`` to model input."""
    scored = model.transform(df).withColumn("score", vector_to_array("probability")[1])
    return scored.drop("features", "rawPrediction", "probability", "prediction").withColumn(
        "prediction", predicted_class("score", threshold)
    )


def prepare(df: DataFrame, features: Sequence[str], test_share: float = 0.2, seed: int = SEED) -> DataFrame:
    """Aligned features with the split mark, staged because fitting reads them often."""
    return stage(stratified_split(model_input(df, features), "churn", "userId", test_share, seed))


def training_parts(rows: int) -> int:
    """Parts of so many training rows."""
    return max(1, -(-rows // max(ROWS_PER_TASK, ROOT_SHARE * math.isqrt(rows))))


def spread(df: DataFrame, key: str = "userId") -> DataFrame:
    """Training rows in even parts and a fixed order.

    Fitting reads the rows many times, so a shuffle up front is cheap.  Row
    sampling depends on where rows lie, so the number of parts follows from the
    number of rows alone: a seed gives the same model on every cluster.

    In every round and for every level of the trees each task sends the statistics of
    all open nodes, however few rows it has, so the parts must grow slower than the rows:
    with their square root, as a task's rows do.
    """
    return df.repartition(training_parts(df.count()), key).sortWithinPartitions(key)


def with_stop_rows(df: DataFrame, key: str = "userId", share: int = 5, seed: int = SEED) -> DataFrame:
    """Add ``is_stop``: one row in ``share``, by hash, that only tells boosting when to stop."""
    return df.withColumn("is_stop", hash_bucket(key, f"-stop-{seed}", share) == 0)


def train_random_forest(
    df: DataFrame, run_id: str = "random_forest", test_share: float = 0.2, **options
) -> tuple[PipelineModel, list[str], DataFrame, DataFrame]:
    """Fit on the training rows; return model, feature list, scored test rows, metrics."""
    features = feature_list(df)
    prepared = prepare(df, features, test_share)
    training = with_balanced_weight(prepared.where(~F.col("is_test")))
    model = random_forest(features, **options).fit(spread(training))
    scored = stage(
        with_probability(model, prepared.where("is_test")).select(
            "userId", "churn", "score", "prediction"
        )
    )
    return model, features, scored, run_metrics(scored, run_id)


def train_gradient_boosting(
    df: DataFrame,
    run_id: str = "gradient_boosting",
    test_share: float = 0.2,
    rounds: int = 1000,
    patience: int | None = 100,
    **options,
) -> tuple[PipelineModel, list[str], DataFrame, DataFrame]:
    """Fit on the training rows, positives weighted up.

    A part of the training rows decides when to stop; the test rows are only scored.
    With ``patience`` the best round by AUC is kept (``boosting.fit_with_patience``);
    without, MLlib's own rule stops at the first round that gains too little.
    """
    features = feature_list(df)
    prepared = prepare(df, features, test_share)
    training = with_stop_rows(with_positive_weight(prepared.where(~F.col("is_test"))))
    if patience is None:
        model = gradient_boosting(features, rounds, **options).fit(spread(training))
    else:
        marked = stage(training)
        model, _ = fit_with_patience(
            lambda n: gradient_boosting(features, n, validation=None, **options),
            spread(marked.where(~F.col("is_stop"))),
            marked.where("is_stop"),
            _inputs(features),
            rounds,
            patience,
        )
    scored = stage(
        with_probability(model, prepared.where("is_test")).select(
            "userId", "churn", "score", "prediction"
        )
    )
    return model, features, scored, run_metrics(scored, run_id)


def feature_importances(model: PipelineModel, features: Sequence[str]) -> list[tuple[str, float]]:
    weights = model.stages[-1].featureImportances.toArray()
    return sorted(zip(features, map(float, weights)), key=lambda pair: (-pair[1], pair[0]))


def save_model(model: PipelineModel, features: Sequence[str], path: str, spark) -> None:
    """Store the model and its ordered feature list under one location."""
    model.write().overwrite().save(f"{path}/model")
    save_feature_list(spark, list(features), f"{path}/features")


def load_model(path: str, spark) -> tuple[PipelineModel, list[str]]:
    return PipelineModel.load(f"{path}/model"), load_feature_list(spark, f"{path}/features")
