"""What the physical plans must and must not contain."""

import pytest
from logs import random_log
from pyspark.sql import functions as F

from stayline.operators import cleaning, imbalance, metrics, users
from stayline.registry.oracles import ORACLES
from stayline.registry.queries import REGISTERED
from stayline.sources.adapters import events_log
from stayline.staging import stage

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


FITS = {"rf_churn_scores", "gbt_churn_scores", "score_batch", "model_leaderboard"}


@pytest.mark.parametrize("name", sorted(set(ORACLES) - FITS))
def test_no_pair_joins_and_no_python_rows(spark, name):
    plan = plan_of(REGISTERED[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_user_aggregates_push_down_and_hash(spark):
    path = stage(events_log(spark, SF_DIR)).inputFiles()[0].rsplit("/", 1)[0]
    log = cleaning.logged_in(spark.read.parquet(path))
    plan = plan_of(users.user_aggregates(log))
    assert "EqualTo(auth,Logged In)" in plan and "IsNotNull(userId)" in plan
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 2 and sum("tie" in s for s in scans) == 1
    assert "partial_count(song" in plan and "Window" not in plan
    # Events meet hash aggregates only; sorting starts after they are folded.
    for line in plan.splitlines():
        if "partial_count(song" in line or "partial_max(ts" in line:
            assert "HashAggregate" in line


def test_label_scan_reads_no_song_columns(spark):
    path = stage(events_log(spark, SF_DIR)).inputFiles()[0].rsplit("/", 1)[0]
    plan = plan_of(users.user_activity(cleaning.logged_in(spark.read.parquet(path))))
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    columns = scan.split("FileScan parquet [")[1].split("]")[0]
    assert "artist" not in columns and "song" not in columns and "length" not in columns


def test_running_totals_move_rows_once_after_folding(spark):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = stage(
            spark.range(1000).select((F.col("id") % 2).alias("churn"), (F.col("id") / 7).alias("score"))
        )
        plan = plan_of(metrics.roc_auc(df))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    main = plan.split("BroadcastExchange")[0]
    assert main.count("Exchange hashpartitioning") <= 3
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert any("windowspecdefinition(_slot" in w for w in windows)


@pytest.mark.parametrize("one_moment", [False, True])
def test_parts_of_heavy_users_are_even(spark, one_moment):
    log = random_log(spark, events=6000, hot_share=0.9).where("userId is not null")
    if one_moment:
        at = F.expr("TIMESTAMP_NTZ'2020-02-01 00:00:00'")
        log = log.withColumn("ts", F.when((F.col("userId") == 0) & (F.col("tie") % 5 > 0), at).otherwise(F.col("ts")))
    placed = cleaning.placed_by_time(log, "userId", cleaning.EVENT_ORDER, 30)
    sizes = {r["_part"]: r["count"] for r in placed.groupBy("_part").count().collect()}
    assert len(sizes) == 30 and max(sizes.values()) <= 2 * log.count() / 30
    ends = placed.groupBy("_part").agg(
        F.min(F.struct("userId", "ts", "tie")).alias("low"), F.max(F.struct("userId", "ts", "tie")).alias("high")
    )
    rows = ends.orderBy("_part").collect()
    assert all(tuple(a.high) < tuple(b.low) for a, b in zip(rows, rows[1:]))


def jobs_of(spark, build):
    """Jobs started while a query is built, by the session's job group."""
    context = spark.sparkContext
    context.setJobGroup("counted", "counted")
    try:
        built = build()
    finally:
        found = len(context.statusTracker().getJobIdsForGroup("counted"))
        context.setLocalProperty("spark.jobGroup.id", None)
    return built, found


def test_metrics_fold_the_scores_once(spark):
    df = stage(spark.range(5000).select((F.col("id") % 2).alias("churn"), (F.col("id") % 700 / 7).alias("score")))
    built, jobs = jobs_of(spark, lambda: metrics.roc_auc(df))
    assert jobs <= 4
    scans = [line for line in plan_of(built).splitlines() if "FileScan" in line]
    assert 1 <= len(scans) <= 2


def test_cells_are_cut_along_the_axes_that_tell_sites_apart(spark):
    rows = [(i, 0.0, 1.0, float(i % 2), 2.0, 3.0, 4.0, float(i % 67), float(i * 7919 % 1009)) for i in range(2000)]
    names = [f"x{a}" for a in range(8)]
    df = spark.createDataFrame(rows, "key long, " + ", ".join(f"{n} double" for n in names))
    sites = df.select(F.array(*names).alias("at"), F.array("key").alias("keys"))
    placed, _ = imbalance._placed(sites, 8, imbalance._pivots(sites), 100)
    sizes = [r["count"] for r in placed.groupBy("cell").count().collect()]
    assert sum(sizes) == 2000 and max(sizes) <= 100


def test_resampling_scans_little(spark):
    df = spark.range(600).selectExpr("id userId", "cast(id % 5 = 0 as int) churn", "id * 1.0D x", "id % 7 * 1.0D y")
    plan = plan_of(imbalance.smote_resample(stage(df), ["x", "y"]))
    assert sum("FileScan" in line for line in plan.splitlines()) <= 8
