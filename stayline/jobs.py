"""Batch jobs for spark-submit.

    python -m stayline.jobs featurize --log logs/ --features features/ --levels levels/
    python -m stayline.jobs search    --features features/ --leaderboard board/
    python -m stayline.jobs train     --features features/ --model model/ --metrics metrics/
    python -m stayline.jobs score     --features features/ --model model/ --scores scores/
    python -m stayline.jobs pages     --log logs/
    python -m stayline.jobs ingest    --source incoming/ --log parsed/ --state state/
    python -m stayline.jobs fold      --source incoming/ --store users/ --state state/
    python -m stayline.jobs compact   --store users/ --before 2024-01-01
    python -m stayline.jobs featurize --log users/ --log-format state --features features/
    python -m stayline.jobs monitor   --history history/ --alerts alerts/
    python -m stayline.jobs drift     --before features/ --features today/
    python -m stayline.jobs promote   --features hold-out/ --serving serving/ --candidate model/
"""

from __future__ import annotations

import argparse
import sys
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.operators.cleaning import logged_in
from stayline.operators.drift import ks_drift
from stayline.operators.encoding import alignment_table
from stayline.operators.metrics import pr_curve
from stayline.operators.shift import BASELINE_DAYS, score_histogram, shift_alerts, stability_index
from stayline.operators.significance import REPLICATES
from stayline.operators.splitting import stratified_split
from stayline.operators.summaries import churn_distribution, distinct_pages
from stayline.plans import featurize as feat
from stayline.plans import incremental, model_search, promotion, scoring, training
from stayline.plans.monitoring import append_metrics, append_parameters, append_scores
from stayline.schemas import NUMERIC_FEATURES
from stayline.session import build_session
from stayline.sources.tables import (
    MalformedInput,
    MissingInput,
    load_levels,
    read_activity_log,
    read_features,
    read_parsed_log,
    read_requests,
    save_levels,
    write_features,
)
from stayline.staging import run, stage
from stayline.streaming.ingest import ingest_new_logs, ingest_state


def _log(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.log_format == "parsed":
        return read_parsed_log(spark, args.log)
    return read_activity_log(spark, args.log, args.log_format, args.quarantine, args.bad_share)


def featurize(spark: SparkSession, args: argparse.Namespace) -> None:
    known = load_levels(spark, args.use_levels) if args.use_levels else None
    if args.log_format == "state":
        state = incremental.read_state(spark, args.log, args.until)
        users = stage(incremental.user_features(state, timedelta(days=args.days), args.agents))
        table, levels = feat.encoded(users, known, not args.allow_no_churn)
    else:
        table, levels = feat.featurize(
            _log(spark, args),
            timedelta(days=args.days),
            ua_mode=args.agents,
            levels=known,
            require_churn=not args.allow_no_churn,
        )
    table = stage(table)
    if table.isEmpty():
        print("no churned users were found; the log may be too sparse; nothing written")
        return
    write_features(table, args.features, args.format)
    if args.levels:
        save_levels(spark, levels, args.levels)
    print(f"{table.count()} users, {len(table.columns)} columns")
    churn_distribution(table).orderBy("churn").show()


def search(spark: SparkSession, args: argparse.Namespace) -> None:
    features = read_features(spark, args.features, fmt=args.format)
    offered = model_search.candidates(args.trees, args.rounds)
    split = stratified_split(features) if args.hold_out else None
    fitted_on = split.where(~F.col("is_test")).drop("is_test") if args.hold_out else features
    found = model_search.search(fitted_on, offered, args.folds)
    weights = model_search.ensemble_weights(found.scores, sorted(offered))
    test = split.where("is_test").drop("is_test") if args.hold_out else features
    board = stage(model_search.tested_leaderboard(found, weights, test))
    if args.models:
        model_search.save_search(found, weights, args.models, spark)
    if args.leaderboard:
        board.write.mode("overwrite").parquet(args.leaderboard)
    board.orderBy(F.desc("score_val"), "model").show(truncate=False)
    print(f"best model: {model_search.best_model(board).collect()[0].model}")
    print(f"ensemble weights: {weights}")


def train(spark: SparkSession, args: argparse.Namespace) -> None:
    features = read_features(spark, args.features, fmt=args.format)
    run_id = args.run or f"{args.kind}-{datetime.now(UTC):%Y%m%dT%H%M%S%f}"
    if args.kind == "forest":
        parameters = {"trees": args.trees}
        fitted = training.train_random_forest(features, run_id, **parameters)
    else:
        parameters = {"rounds": args.rounds, "patience": args.patience}
        fitted = training.train_gradient_boosting(features, run_id, **parameters)
    model, names, scored, records = fitted
    training.save_model(model, names, args.model, spark)
    records = stage(records)
    if args.metrics:
        append_metrics(records, args.metrics)
    if args.parameters:
        append_parameters(spark, run_id, {"model_type": args.kind, "features": len(names), **parameters}, args.parameters)
    if args.curve:
        pr_curve(scored).write.mode("overwrite").parquet(args.curve)
    records.orderBy("metric").show(truncate=False)


def score(spark: SparkSession, args: argparse.Namespace) -> None:
    model, names = training.load_model(args.model, spark)
    if args.requests:
        requests = read_requests(spark, args.requests)
        scoring.request_alignment(requests, names).orderBy("status", "column").show(truncate=False)
        scored = scoring.score_requests(requests, model, names)
    else:
        rows = read_features(spark, args.features, fmt=args.format)
        alignment_table(rows, names, training.NOT_FEATURES).orderBy("status", "column").show(truncate=False)
        scored = scoring.score_batch(rows, model, names)
    scored = stage(scored)
    if args.history:
        valid = scored.where(F.col("error").isNull()).withColumnRenamed("churn_probability", "score")
        append_scores(valid.drop("error"), args.history, args.day)
    scored.write.mode("overwrite").parquet(args.scores)


def pages(spark: SparkSession, args: argparse.Namespace) -> None:
    for row in distinct_pages(logged_in(_log(spark, args))).toLocalIterator():
        print(row.page)


def ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    print(f"{ingest_new_logs(spark, args.source, args.log, args.state)} events added")


def fold(spark: SparkSession, args: argparse.Namespace) -> None:
    print(f"{len(ingest_state(spark, args.source, args.store, args.state))} batches added")


def compact(spark: SparkSession, args: argparse.Namespace) -> None:
    print(f"all batches are now {incremental.compact(spark, args.store, args.before)}")
    if args.clean:
        incremental.clean(spark, args.store)


def monitor(spark: SparkSession, args: argparse.Namespace) -> None:
    """Days on which the share of flagged users or the distribution of scores shifted."""
    history = spark.read.parquet(args.history)
    daily = stage(score_histogram(history, ["day"]))
    first = daily.select("day").distinct().orderBy("day").limit(args.baseline)
    index = stability_index(daily, daily.join(first, "day", "left_semi")).drop("scored")
    found = stage(shift_alerts(history, baseline_days=args.baseline).join(index, "day"))
    if args.alerts:
        found.write.mode("overwrite").parquet(args.alerts)
    found.where(F.col("alert").isNotNull() | F.col("shifted")).orderBy("day").show(1000, truncate=False)


def drift(spark: SparkSession, args: argparse.Namespace) -> None:
    """Features whose distribution differs from that of the training table."""
    before, after = (read_features(spark, path, fmt=args.format) for path in (args.before, args.features))
    shared = [f for f in NUMERIC_FEATURES if f in before.columns and f in after.columns]
    found = stage(ks_drift(before, after, shared))
    if args.report:
        found.write.mode("overwrite").parquet(args.report)
    found.show(1000, truncate=False)


def promote(spark: SparkSession, args: argparse.Namespace) -> None:
    """Put the candidate in the serving model's place if it is better beyond doubt on the same labelled rows."""
    rows = read_features(spark, args.features, fmt=args.format)
    decision = promotion.promote(spark, rows, args.serving, args.candidate, args.metric, args.factor, args.replicates)
    if args.decisions:
        append_parameters(spark, f"promote-{datetime.now(UTC):%Y%m%dT%H%M%S%f}", decision, args.decisions)
    print(decision)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="stayline.jobs")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(start, *options: tuple[str, dict]) -> None:
        sub = jobs.add_parser(start.__name__)
        sub.set_defaults(start=start)
        for name, settings in options:
            sub.add_argument(f"--{name}", **settings)

    needed, optional = {"required": True}, {"default": None}
    log_format = (
        "log-format",
        {"default": "json", "choices": ["json", "parquet", "orc", "parsed"]},
    )
    with_state = ("log-format", {**log_format[1], "choices": [*log_format[1]["choices"], "state"]})
    day = {"default": None, "type": date.fromisoformat}
    broken = (("quarantine", optional), ("bad-share", {"type": float, "default": 0.0}))
    table_format = ("format", {"default": "parquet", "choices": ["parquet", "csv"]})
    trees = ("trees", {"type": int, "default": 100})
    job(
        featurize,
        ("log", needed),
        with_state,
        ("until", day),
        *broken,
        ("features", needed),
        table_format,
        ("levels", optional),
        ("use-levels", optional),
        ("allow-no-churn", {"action": "store_true"}),
        ("days", {"type": float, "default": 30.0}),
        ("agents", {"default": "latest", "choices": ["latest", "fanout"]}),
    )
    job(
        search,
        ("features", needed),
        table_format,
        ("leaderboard", optional),
        ("models", optional),
        ("hold-out", {"action": "store_true"}),
        trees,
        ("rounds", {"type": int, "default": 100}),
        ("folds", {"type": int, "default": model_search.FOLDS}),
    )
    job(
        train,
        ("features", needed),
        table_format,
        ("model", needed),
        ("metrics", optional),
        ("parameters", optional),
        ("curve", optional),
        ("run", optional),
        ("kind", {"default": "forest", "choices": ["forest", "boosting"]}),
        trees,
        ("rounds", {"type": int, "default": 1000}),
        ("patience", {"type": int, "default": 100}),
    )
    job(
        score,
        ("features", optional),
        ("requests", optional),
        table_format,
        ("model", needed),
        ("scores", needed),
        ("history", optional),
        ("day", optional),
    )
    job(pages, ("log", needed), log_format, *broken)
    job(fold, ("source", needed), ("store", needed), ("state", needed))
    job(compact, ("store", needed), ("before", day), ("clean", {"action": "store_true"}))
    job(monitor, ("history", needed), ("alerts", optional), ("baseline", {"type": int, "default": BASELINE_DAYS}))
    job(drift, ("before", needed), ("features", needed), table_format, ("report", optional))
    job(
        promote,
        ("features", needed),
        table_format,
        ("serving", needed),
        ("candidate", needed),
        ("metric", {"default": "f1", "choices": ["f1", "roc_auc"]}),
        ("factor", {"type": float, "default": 1.05}),
        ("replicates", {"type": int, "default": REPLICATES}),
        ("decisions", optional),
    )
    job(ingest, ("source", needed), ("log", needed), ("state", needed))
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    if args.job == "score" and bool(args.features) == bool(args.requests):
        parser().error("score takes either --features or --requests")
    if args.job == "score" and args.history and not args.day:
        parser().error("--history needs --day")
    spark = spark or build_session(f"stayline {args.job}")
    try:
        with run(spark):
            args.start(spark, args)
    except (MalformedInput, MissingInput) as error:
        print(f"error: {error}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
