"""Comparison of model families by out-of-fold scores, and their weighted blend."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.operators.metrics import roc_auc, roc_auc_of_counts
from stayline.operators.splitting import SEED, with_balanced_weight, with_folds
from stayline.plans.training import (
    NOT_FEATURES,
    feature_list,
    gradient_boosting,
    logistic_regression,
    model_input,
    random_forest,
    spread,
    training_parts,
    with_probability,
    with_stop_rows,
)
from stayline.sources.tables import load_feature_list, save_feature_list
from stayline.staging import stage

FOLDS = 8
WEIGHT_STEP = 0.05
BLEND = "WeightedEnsemble"
#: Cells along each of two scores in which blends are bounded, and what rounding can shift a blend by.
CELLS, ROUNDING = 256, 1e-9

Builder = Callable[[Sequence[str]], Pipeline]


def candidates(trees: int = 100, rounds: int = 100) -> dict[str, Builder]:
    """Boosting may stop before ``rounds``, on rows of its own part of the training fold."""
    return {
        "RandomForestGini": lambda f: random_forest(f, trees=trees),
        "RandomForestEntr": lambda f: random_forest(f, trees=trees, impurity="entropy"),
        "GradientBoosting": lambda f: gradient_boosting(f, rounds=rounds),
        "LogisticRegression": lambda f: logistic_regression(f),
    }


@dataclass(frozen=True)
class Search:
    """All fold models of a search, the out-of-fold scores and the seconds of fitting."""

    features: list[str]
    models: dict[str, list[PipelineModel]]
    scores: DataFrame
    seconds: dict[str, float]


def search(
    df: DataFrame, models: dict[str, Builder], folds: int = FOLDS, seed: int = SEED, at_once: int | None = None
) -> Search:
    """Fit every model without each fold and score that fold.

    ``scores`` is a long table (model, row_id, userId, churn, score); ``row_id``
    tells a user's rows apart.  Several folds are fitted at once, since one fit
    rarely fills a cluster: at least four, and one per core where a fit is a single task.
    """
    features = feature_list(df)
    numbered = model_input(df, features).withColumn("row_id", F.monotonically_increasing_id())
    table = stage(with_stop_rows(with_folds(numbered, "userId", folds, seed), seed=seed))
    if at_once is None:
        at_once = max(4, df.sparkSession.sparkContext.defaultParallelism // training_parts(table.count()))

    def fit(name: str, fold: int) -> tuple[PipelineModel, float, DataFrame]:
        started = time.monotonic()
        training = with_balanced_weight(table.where(F.col("fold") != fold))
        model = models[name](features).fit(spread(training))
        seconds = time.monotonic() - started
        # A plan's tasks each load all models in it, so every model scores its fold in a job of its own.
        scored = with_probability(model, table.where(F.col("fold") == fold))
        return model, seconds, stage(scored.select(F.lit(name).alias("model"), "row_id", "userId", "churn", "score"))

    with ThreadPoolExecutor(at_once) as pool:
        running = {name: [pool.submit(copy_context().run, fit, name, k) for k in range(folds)] for name in models}
        done = {name: [f.result() for f in fits] for name, fits in running.items()}
    fitted = {name: [model for model, _, _ in fits] for name, fits in done.items()}
    scores = stage(reduce(DataFrame.unionByName, [part for fits in done.values() for _, _, part in fits]))
    return Search(features, fitted, scores, {name: sum(s for _, s, _ in fits) for name, fits in done.items()})


def out_of_fold(
    df: DataFrame, models: dict[str, Builder], folds: int = FOLDS, seed: int = SEED
) -> tuple[DataFrame, dict[str, float]]:
    """Scores of the models that were fitted without a row's fold, and seconds of fitting."""
    found = search(df, models, folds, seed)
    return found.scores, found.seconds


def score_rows(
    found: Search, df: DataFrame, weights: dict[str, float], keep: Sequence[str] = NOT_FEATURES
) -> DataFrame:
    """Score new rows: the weighted mean over models, each the mean of its fold models."""
    rows = model_input(df, found.features, keep)
    total = F.lit(0.0)
    for name, weight in weights.items():
        for fold, model in enumerate(found.models[name]):
            scored = f"_{name}_{fold}"
            rows = with_probability(model, rows).withColumnRenamed("score", scored).drop("prediction")
            total = total + F.lit(weight / len(found.models[name])) * F.col(scored)
    return rows.select(*keep, total.alias("score"))


def save_search(found: Search, weights: dict[str, float], path: str, spark: SparkSession) -> None:
    """Store all fold models, the feature list and the blend under one location."""
    for name, own in found.models.items():
        for fold, model in enumerate(own):
            model.write().overwrite().save(f"{path}/models/{name}/{fold}")
    save_feature_list(spark, found.features, f"{path}/features")
    rows = [(name, len(own), float(weights.get(name, 0.0)), found.seconds[name]) for name, own in found.models.items()]
    frame = spark.createDataFrame(rows, "model STRING, folds INT, weight DOUBLE, seconds DOUBLE")
    frame.coalesce(1).write.mode("overwrite").json(f"{path}/blend")
    found.scores.write.mode("overwrite").parquet(f"{path}/scores")


def load_search(path: str, spark: SparkSession) -> tuple[Search, dict[str, float]]:
    rows = spark.read.schema("model STRING, folds INT, weight DOUBLE, seconds DOUBLE").json(f"{path}/blend").collect()
    models = {r.model: [PipelineModel.load(f"{path}/models/{r.model}/{k}") for k in range(r.folds)] for r in rows}
    seconds = {r.model: r.seconds for r in rows}
    found = Search(load_feature_list(spark, f"{path}/features"), models, spark.read.parquet(f"{path}/scores"), seconds)
    return found, {r.model: r.weight for r in rows if r.weight}


def tested_leaderboard(found: Search, weights: dict[str, float], test: DataFrame) -> DataFrame:
    """Every model and the blend with AUC out of fold and on ``test``, and seconds of fitting and scoring."""
    blend = ensemble_scores(found.scores, weights).withColumn("model", F.lit(BLEND))
    every = found.scores.unionByName(blend.select(*found.scores.columns))
    board = leaderboard(every, {**found.seconds, BLEND: 0.0})
    rows = []
    for name in (*found.models, BLEND):
        started = time.monotonic()
        scored = stage(score_rows(found, test, weights if name == BLEND else {name: 1.0}))
        seconds = time.monotonic() - started
        rows.append((name, roc_auc(scored).collect()[0].roc_auc, seconds))
    tested = test.sparkSession.createDataFrame(rows, "model STRING, score_test DOUBLE, pred_time DOUBLE")
    return board.join(tested, "model").orderBy(F.desc("score_val"), "model")


def leaderboard(scores: DataFrame, seconds: dict[str, float]) -> DataFrame:
    """Models by validation AUC, best first."""
    measured = roc_auc(scores, by=["model"]).select("model", F.col("roc_auc").alias("score_val"))
    fit_times = scores.sparkSession.createDataFrame(
        list(seconds.items()), "model STRING, fit_time DOUBLE"
    )
    return measured.join(fit_times, "model").orderBy(F.desc("score_val"), "model")


def best_model(board: DataFrame) -> DataFrame:
    return board.orderBy(F.desc("score_val"), "model").limit(1)


def _mixed(parts: dict[str, float]) -> Column:
    return reduce(lambda a, b: a + b, [F.lit(w) * F.col(m) for m, w in parts.items()])


def _blend_aucs(wide: DataFrame, blends: dict[str, dict[str, float]]) -> dict[str, float]:
    """Exact AUC of many blends in one job, grouped by the blend's number."""
    mixed = F.array(*[_mixed(parts) for parts in blends.values()])
    rows = wide.select("churn", F.posexplode(mixed).alias("blend", "score"))
    names = list(blends)
    return {names[r.blend]: r.roc_auc or 0.0 for r in roc_auc(rows, by=["blend"]).collect()}


def blend_bounds(
    wide: DataFrame, weights: dict[str, float], others: Sequence[str], shares: Sequence[float], cells: int = CELLS
) -> dict[tuple[str, int], tuple[float, float]]:
    """By (other model, place in ``shares``): bounds of the AUC of the blend that gives the model that share.

    Rows are counted once per model, in cells of the blend so far and the model's score.
    The lowest and highest blend of a cell follow from its corners: AUC is least where
    every positive has the lowest of its cell and every negative the highest, and most
    the other way round.  What is ranked grows with the cells and not with the rows.
    """
    pairs = F.array(*[F.struct(F.lit(k).alias("other"), F.col(m).alias("b")) for k, m in enumerate(others)])
    both = wide.select("churn", _mixed(weights).alias("a"), F.explode(pairs).alias("p")).select("churn", "a", "p.*")
    known = both.where(F.col("a").isNotNull() & F.col("b").isNotNull())
    counted = stage(
        known.groupBy("other", F.floor(F.col("a") * cells).alias("i"), F.floor(F.col("b") * cells).alias("j")).agg(
            *[f(x).alias(f"{f.__name__}_{x}") for f in (F.min, F.max) for x in ("a", "b")],
            F.count_if(F.col("churn") == 1).alias("pos"),
            F.count_if(F.col("churn") == 0).alias("neg"),
        )
    )
    spread_out = counted.withColumn("share", F.explode(F.lit(list(range(len(shares))))))
    share = F.element_at(F.lit(list(shares)), F.col("share") + 1)
    low = (1 - share) * F.col("min_a") + share * F.col("min_b") - ROUNDING
    high = (1 - share) * F.col("max_a") + share * F.col("max_b") + ROUNDING
    none = F.lit(0).cast("long")

    def row(upper: bool, score: Column, positives: Column, negatives: Column) -> Column:
        named = (F.lit(upper).alias("upper"), score.alias("score"), positives.alias("positives"), negatives.alias("negatives"))
        return F.struct(*named)

    pos, neg = F.col("pos"), F.col("neg")
    ends = F.array(row(True, high, pos, none), row(True, low, none, neg), row(False, low, pos, none), row(False, high, none, neg))
    rows = spread_out.select("other", "share", F.explode(ends).alias("e")).select("other", "share", "e.*")
    found = {
        (others[r.other], r.share, r.upper): r.roc_auc
        for r in roc_auc_of_counts(rows, ["other", "share", "upper"]).collect()
    }
    bound = lambda m, i, upper: float(upper) if (auc := found.get((m, i, upper))) is None else auc
    return {(m, i): (bound(m, i, False), bound(m, i, True)) for m in others for i in range(len(shares))}


def ensemble_weights(
    scores: DataFrame, models: Sequence[str], step: float = WEIGHT_STEP
) -> dict[str, float]:
    """Greedy blend: start from the best model, mix in others while the AUC grows.

    Only blends whose upper bound reaches the best lower bound are measured row by row.
    """
    wide = stage(
        scores.groupBy("row_id", "churn").pivot("model", list(models)).agg(F.first("score"))
    )
    singles = _blend_aucs(wide, {m: {m: 1.0} for m in models})
    best = max(sorted(singles), key=lambda m: singles[m])
    weights, reached = {best: 1.0}, singles[best]
    shares = [i * step for i in range(1, round(1 / step))]
    for _ in range(len(models) - 1):
        others = [m for m in models if m not in weights]
        bounds = blend_bounds(wide, weights, others, shares)
        least = max(low for low, _ in bounds.values())
        options = {}
        for (m, i), (_, high) in bounds.items():
            if high >= least and high > reached:
                mixed = {name: w * (1 - shares[i]) for name, w in weights.items()}
                options[f"{m}|{i + 1}"] = {**mixed, m: shares[i]}
        if not options:
            break
        measured = _blend_aucs(wide, options)
        choice = max(sorted(measured), key=lambda o: measured[o])
        if measured[choice] <= reached:
            break
        weights, reached = options[choice], measured[choice]
    return weights


def ensemble_scores(scores: DataFrame, weights: dict[str, float]) -> DataFrame:
    """Weighted mean of the members' scores per row."""
    weight = F.lit(0.0)
    for model, share in weights.items():
        weight = F.when(F.col("model") == model, F.lit(float(share))).otherwise(weight)
    return (
        scores.where(F.col("model").isin(list(weights)))
        .groupBy("row_id", "userId", "churn")
        .agg(F.sum(weight * F.col("score")).alias("score"))
    )
