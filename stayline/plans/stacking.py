"""Second-level models on out-of-fold scores, without a leak between the levels.

A second-level model of fold k is fitted on the rows outside k and scores fold k.  Its inputs
are the features and the scores of the first-level models.  Were those the usual
out-of-fold scores, the score of a training row in fold j would come from models that have
seen the labels of fold k.  So every two folds j and k have first-level models of their own,
fitted without both: they score fold j for the second level of k and fold k for that of j.
The rows of fold k themselves are scored by the models fitted without k alone.

New rows get the mean of the first-level fold models, and then the mean of the second level's.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.operators.splitting import SEED, with_balanced_weight, with_folds
from stayline.plans.model_search import Builder, Search, load_search, save_search
from stayline.plans.training import (
    NOT_FEATURES,
    feature_list,
    model_input,
    spread,
    with_probability,
    with_stop_rows,
)
from stayline.sources.tables import load_feature_list, save_feature_list
from stayline.staging import stage

FOLDS = 4
SECOND = "SecondLevel"


@dataclass(frozen=True)
class Stack:
    """``first`` is an ordinary search; ``nested`` (model, row_id, left_out, score) fed the second level.

    ``scores`` has the columns of ``first.scores``, out of fold for the second level.
    """

    first: Search
    nested: DataFrame
    second: list[PipelineModel]
    scores: DataFrame
    seconds: float

    @property
    def inputs(self) -> list[str]:
        return [*self.first.features, *level_columns(self.first.models)]


def level_columns(models) -> list[str]:
    return [f"score_{name}" for name in sorted(models)]


def _scored(model: PipelineModel, rows: DataFrame, name: str, left_out: int) -> DataFrame:
    told = with_probability(model, rows).select("row_id", "userId", "churn", "score")
    return told.withColumns({"model": F.lit(name), "left_out": F.lit(left_out)})


def stack(
    df: DataFrame,
    models: dict[str, Builder],
    final: Builder,
    folds: int = FOLDS,
    seed: int = SEED,
    at_once: int = 4,
) -> Stack:
    """Fit both levels; (folds + 1) * folds / 2 fits of every model, and ``folds`` of the last one."""
    if folds < 3:
        raise ValueError("two folds left out must leave a third to fit on")
    features = feature_list(df)
    numbered = model_input(df, features).withColumn("row_id", F.monotonically_increasing_id())
    table = stage(with_stop_rows(with_folds(numbered, "userId", folds, seed), seed=seed))
    fold = F.col("fold")

    def fit(build: Builder, names: Sequence[str], training: DataFrame) -> tuple[PipelineModel, float]:
        started = time.monotonic()
        return build(names).fit(spread(with_balanced_weight(training))), time.monotonic() - started

    missing = [*[(k,) for k in range(folds)], *combinations(range(folds), 2)]
    with ThreadPoolExecutor(at_once) as pool:
        running = {(name, left): pool.submit(fit, build, features, table.where(~fold.isin(*left))) for name, build in models.items() for left in missing}
        done = {key: future.result() for key, future in running.items()}

    parts = []
    for (name, left), (model, _) in done.items():
        if len(left) == 1:
            parts.append(_scored(model, table.where(fold == left[0]), name, left[0]))
        else:
            parts += [_scored(model, table.where(fold == own), name, other) for own, other in (left, left[::-1])]
    nested = stage(reduce(DataFrame.unionByName, parts))

    columns = level_columns(models)
    wide = nested.groupBy("row_id", "left_out").pivot("model", sorted(models)).agg(F.first("score"))
    wide = wide.toDF("row_id", "left_out", *columns)
    joined = table.join(wide, "row_id")
    inputs = [*features, *columns]
    named = joined.select("row_id", "left_out", "fold", "is_stop", "userId", "churn", *_both(len(features), columns))
    named = stage(named)
    with ThreadPoolExecutor(at_once) as pool:
        running = [
            pool.submit(fit, final, inputs, named.where((F.col("left_out") == k) & (fold != k))) for k in range(folds)
        ]
        second = [future.result() for future in running]
    out = [
        _scored(model, named.where((F.col("left_out") == k) & (fold == k)), SECOND, k) for k, (model, _) in enumerate(second)
    ]
    keep = ("model", "row_id", "userId", "churn", "score")
    scores = stage(reduce(DataFrame.unionByName, out).select(*keep))
    plain = nested.join(table.select("row_id", "fold"), "row_id").where(fold == F.col("left_out")).select(*keep)
    seconds = {name: sum(s for (own_name, _), (_, s) in done.items() if own_name == name) for name in models}
    first = Search(features, {name: [done[name, (k,)][0] for k in range(folds)] for name in models}, stage(plain), seconds)
    return Stack(first, nested, [model for model, _ in second], scores, sum(s for _, s in second))


def _both(count: int, columns: Sequence[str]) -> list:
    """The features under the names a model reads, then the first level's scores under the next ones."""
    return [*[F.col(f"_f{k}") for k in range(count)], *[F.col(c).alias(f"_f{count + k}") for k, c in enumerate(columns)]]


def score_rows(found: Stack, df: DataFrame, keep: Sequence[str] = NOT_FEATURES) -> DataFrame:
    """Score new rows by both levels."""
    rows = model_input(df, found.first.features, keep)
    for name, column in zip(sorted(found.first.models), level_columns(found.first.models)):
        fitted = found.first.models[name]
        total = F.lit(0.0)
        for k, model in enumerate(fitted):
            rows = with_probability(model, rows).withColumnRenamed("score", f"_{k}").drop("prediction")
            total = total + F.col(f"_{k}") / F.lit(len(fitted))
        rows = rows.withColumn(column, total).drop(*[f"_{k}" for k in range(len(fitted))])
    columns = level_columns(found.first.models)
    rows = rows.select(*keep, *_both(len(found.first.features), columns))
    total = F.lit(0.0)
    for k, model in enumerate(found.second):
        rows = with_probability(model, rows).withColumnRenamed("score", f"_{k}").drop("prediction")
        total = total + F.col(f"_{k}") / F.lit(len(found.second))
    return rows.select(*keep, total.alias("score"))


def save_stack(found: Stack, path: str, spark: SparkSession) -> None:
    save_search(found.first, {}, f"{path}/first", spark)
    for k, model in enumerate(found.second):
        model.write().overwrite().save(f"{path}/second/{k}")
    found.nested.write.mode("overwrite").parquet(f"{path}/nested")
    found.scores.write.mode("overwrite").parquet(f"{path}/scores")
    row = [(len(found.second), float(found.seconds))]
    spark.createDataFrame(row, "folds INT, seconds DOUBLE").coalesce(1).write.mode("overwrite").json(f"{path}/about")
    save_feature_list(spark, found.inputs, f"{path}/inputs")


def load_stack(path: str, spark: SparkSession) -> Stack:
    first, _ = load_search(f"{path}/first", spark)
    about = spark.read.schema("folds INT, seconds DOUBLE").json(f"{path}/about").first()
    found = Stack(
        first,
        spark.read.parquet(f"{path}/nested"),
        [PipelineModel.load(f"{path}/second/{k}") for k in range(about.folds)],
        spark.read.parquet(f"{path}/scores"),
        about.seconds,
    )
    if load_feature_list(spark, f"{path}/inputs") != found.inputs:
        raise ValueError(f"the inputs stored at {path} are not those of its models")
    return found
