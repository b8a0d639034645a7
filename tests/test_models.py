import json

import pytest
from golden import raw_rows
from logs import rows_of
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from stayline.operators import metrics
from stayline.plans import model_search, monitoring, scoring, training
from stayline.schemas import NUMERIC_FEATURES
from stayline.sources.tables import read_parsed_log, request_rows
from stayline.streaming.ingest import ingest_new_logs

REQUEST = {
    "tenure": 41,
    "total_songs": 77,
    "total_listen_time": 18250.5,
    "num_artists": 63,
    "num_thumbs_up": 4,
    "num_thumbs_down": 9,
    "num_sessions": 11,
    "num_friends_added": 1,
    "num_downgrades": 2,
    "avg_songs_per_session": 7.0,
    "gender_Male": False,
    "os_Linux": True,
}
OTHER_REQUEST = {**REQUEST, "tenure": 3, "total_songs": 0, "last_level_paid": False, "os_Mac_OS_X": True, "os_Linux": False}


@pytest.fixture(scope="module")
def table(spark):
    ids = spark.range(240)
    u = F.col("id")
    columns = {f: (F.pmod(F.hash(u, F.lit(f)), F.lit(100))).cast("double") for f in NUMERIC_FEATURES}
    churn = (columns["tenure"] + columns["total_songs"] / 4 < 35).cast("int")
    return ids.select(
        u.alias("userId"),
        churn.alias("churn"),
        *[c.alias(f) for f, c in columns.items()],
        (u % 2 == 0).alias("gender_M"),
        (u % 3 == 0).alias("last_level_paid"),
    )


@pytest.fixture(scope="module")
def forest(table):
    return training.train_random_forest(table, trees=15, max_depth=5)


def test_forest_learns_and_is_repeatable(table, forest):
    model, features, scored, records = forest
    assert features[0] == "tenure" or "tenure" in features
    assert "userId" not in features
    values = {r.metric: r.value for r in records.collect()}
    assert set(values) == {"AUC_ROC", "F1_Score", "Precision", "Recall", "PR_AUC"}
    assert values["AUC_ROC"] > 0.8
    theirs = BinaryClassificationEvaluator(
        rawPredictionCol="score", labelCol="churn", numBins=0
    ).evaluate(scored)
    assert values["AUC_ROC"] == pytest.approx(theirs, abs=1e-9)
    _, _, again, _ = training.train_random_forest(table, trees=15, max_depth=5)
    assert rows_of(again) == rows_of(scored)
    top = training.feature_importances(model, features)
    assert "tenure" in [name for name, _ in top[:3]]


def test_boosting_learns(table):
    _, _, scored, records = training.train_gradient_boosting(table, rounds=8, step=0.3, max_depth=3)
    values = {r.metric: r.value for r in records.collect()}
    assert values["AUC_ROC"] > 0.8
    assert scored.where("score < 0 or score > 1").count() == 0


def test_model_round_trip_and_batch_scores(spark, table, forest, tmp_path):
    model, features, _, _ = forest
    training.save_model(model, features, str(tmp_path / "m"), spark)
    loaded, names = training.load_model(str(tmp_path / "m"), spark)
    assert names == features
    first = scoring.score_batch(table, model, features)
    second = scoring.score_batch(table, loaded, names)
    assert rows_of(first) == rows_of(second)
    assert first.where("error is not null").count() == 0
    assert first.where("churn_prediction <> cast(churn_probability > 0.5 as int)").count() == 0
    assert first.count() == table.count()


def test_feature_names_with_dots_and_spaces(table):
    odd = table.withColumnRenamed("gender_M", "os_Mac OS X 10.9")
    model, features, scored, _ = training.train_random_forest(odd, trees=3, max_depth=3)
    assert "os_Mac OS X 10.9" in features and scored.count() > 0
    assert scoring.score_batch(odd, model, features).where("error is null").count() == odd.count()


def test_requests(spark, forest):
    model, features, _, _ = forest
    rows = scoring.score_requests(request_rows(spark, [REQUEST, OTHER_REQUEST, {"tenure": 120}]), model, features)
    good, other, bad = sorted(rows.collect(), key=lambda r: r.error or "")
    assert good.error is None and good.churn_prediction in (0, 1) and other.error is None
    assert good.churn_probability != other.churn_probability
    assert 0.0 <= good.churn_probability <= 1.0
    assert bad.error == "Field required: total_songs"
    assert bad.churn_prediction is None and bad.churn_probability is None


def test_request_names_reach_their_features(spark):
    ids = spark.range(300)
    table = ids.selectExpr(
        "id userId", "cast(id % 2 = 1 and id % 10 > 0 as int) churn", "id % 2 = 1 gender_M", "id % 3 = 0 `os_Mac OS X`",
        *[f"cast(id % 7 as double) {f}" for f in NUMERIC_FEATURES],
    )
    model, features, _, _ = training.train_random_forest(table, trees=10, max_depth=4)
    requests = request_rows(spark, [{**REQUEST, "gender_Male": True, "os_Mac_OS_X": True}, {**REQUEST, "gender_Male": False}])
    male, female = (r.churn_probability for r in scoring.score_requests(requests, model, features).collect())
    assert male > female + 0.2
    told = {(r.column, r.status): r.rows for r in scoring.request_alignment(requests, [*features, "browser_IE"]).collect()}
    assert told == {
        ("browser_IE", "missing"): 2, ("last_level_paid", "ignored"): 2, ("os_Linux", "ignored"): 2, ("os_Windows", "ignored"): 0
    }


def test_batch_without_required_fields(table, forest):
    model, features, _, _ = forest
    assert scoring.score_batch(table, model, features, required=()).where("error is not null").count() == 0


def test_fits_do_not_depend_on_the_number_of_cores(spark, table):
    rows = table.count()
    spread = training.spread(table)
    assert spread.rdd.getNumPartitions() == max(1, -(-rows // training.ROWS_PER_TASK))
    again = training.spread(table.repartition(13))
    key = F.spark_partition_id().alias("part")
    assert rows_of(spread.select("userId", key)) == rows_of(again.select("userId", key))


def test_boosting_stops_on_rows_it_is_not_judged_on(table):
    marked = training.with_stop_rows(training.prepare(table, training.feature_list(table)))
    assert 20 < marked.where("is_stop").count() < 80
    assert training.gradient_boosting(["a"]).getStages()[-1].getValidationIndicatorCol() == "is_stop"


def test_scoring_without_model(spark):
    rows = scoring.score_requests(request_rows(spark, [REQUEST]), None, []).collect()
    assert rows[0].error == "Model not loaded." and rows[0].churn_prediction is None


def test_search_ranks_and_blends(spark, table, tmp_path):
    offered = model_search.candidates(trees=5, rounds=3)
    offered = {m: offered[m] for m in ("RandomForestGini", "LogisticRegression")}
    found = model_search.search(table, offered, folds=2)
    scores, seconds = found.scores, found.seconds
    assert scores.count() == 2 * table.count()
    board = model_search.leaderboard(scores, seconds)
    ranked = [r.score_val for r in board.collect()]
    assert ranked == sorted(ranked, reverse=True)
    assert model_search.best_model(board).collect()[0].score_val == ranked[0]
    weights = model_search.ensemble_weights(scores, sorted(offered))
    assert sum(weights.values()) == pytest.approx(1.0)
    blend = model_search.ensemble_scores(scores, weights)
    assert blend.count() == table.count()
    assert metrics.roc_auc(blend).collect()[0].roc_auc >= ranked[0] - 1e-3
    full = model_search.tested_leaderboard(found, weights, table).collect()
    assert {r.model for r in full} == {*offered, model_search.BLEND}
    assert all(0 <= r.score_test <= 1 and r.pred_time > 0 for r in full)
    new = table.where("userId < 20").withColumn("userId", F.col("userId") + 1000)
    first = model_search.score_rows(found, new, weights)
    assert first.count() == 20 and first.where("score < 0 or score > 1").count() == 0
    model_search.save_search(found, weights, str(tmp_path / "search"), spark)
    loaded, kept = model_search.load_search(str(tmp_path / "search"), spark)
    assert kept == weights and rows_of(model_search.score_rows(loaded, new, kept)) == rows_of(first)


def test_blend_of_users_with_several_rows(spark, table):
    scores = spark.createDataFrame(
        [(m, row, 7, 1, s) for row in (1, 2) for m, s in (("a", 0.9), ("b", 0.5 + row / 10))],
        "model string, row_id long, userId long, churn int, score double",
    )
    got = sorted(r.score for r in model_search.ensemble_scores(scores, {"a": 0.5, "b": 0.5}).collect())
    assert got == pytest.approx([0.75, 0.8])
    fanned = table.unionByName(table.where("userId < 40"))
    found = model_search.search(fanned, {"LogisticRegression": model_search.candidates()["LogisticRegression"]}, folds=2)
    blend = model_search.ensemble_scores(found.scores, {"LogisticRegression": 1.0})
    assert blend.count() == fanned.count() and blend.where("score > 1").count() == 0


def test_history_and_delayed_metrics(spark, tmp_path):
    path = str(tmp_path / "history")
    for day, shift in (("2024-01-01", 0.0), ("2024-01-02", 0.4)):
        scored = spark.range(10).select(
            F.col("id").alias("userId"), (F.col("id") / 20 + shift).alias("score")
        )
        monitoring.append_scores(scored.withColumn("score", F.lit(0.9)), path, day)
        monitoring.append_scores(scored, path, day)  # a rerun replaces the day
    history = spark.read.parquet(path)
    share = {str(r.day): r.flagged_share for r in metrics.prediction_share(history).collect()}
    assert share == {"2024-01-01": 0.0, "2024-01-02": 0.7}
    known = spark.range(10).select(F.col("id").alias("userId"), (F.col("id") > 4).cast("int").alias("churn"))
    late = metrics.delayed_metrics(history, known, "day").collect()
    assert [r.roc_auc for r in late] == [1.0, 1.0]


def test_ingest_takes_each_file_once(spark, tmp_path):
    source, target, state = (tmp_path / n for n in ("in", "out", "state"))
    source.mkdir()
    (source / "a.json").write_text("\n".join(json.dumps(r) for r in raw_rows()))
    args = (spark, str(source), str(target), str(state))
    assert ingest_new_logs(*args) == 12
    assert ingest_new_logs(*args) == 0
    (source / "b.json").write_text(json.dumps(raw_rows()[0]))
    assert ingest_new_logs(*args) == 1
    log = read_parsed_log(spark, str(target))
    assert log.count() == 13
    assert log.where("day = date'2018-10-01'").count() == 2
