import numpy as np
import pytest
from logs import rows_of
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from stayline.plans import boosting, training, trees
from stayline.plans.boosting import stopping_round


@pytest.fixture(scope="module")
def points(spark):
    at = lambda salt: F.pmod(F.hash("id", F.lit(salt)), F.lit(100)).cast("double")
    rows = spark.range(400).select(
        F.col("id").alias("userId"), F.when(F.col("id") % 17 != 0, at("a")).alias("a"), at("b").alias("b"), (at("c") > 50).alias("c"), at("noise").alias("_noise")
    )
    churn = (F.coalesce("a", F.lit(10.0)) + F.col("b") / 2 + F.col("_noise") / 2 < 75).cast("int")
    return rows.withColumn("churn", churn).drop("_noise").cache()


@pytest.fixture(scope="module")
def prepared(points):
    features = training.feature_list(points)
    marked = training.with_stop_rows(training.with_positive_weight(training.model_input(points, features)))
    return features, marked.cache()


def build(features):
    return lambda n: training.gradient_boosting(features, n, step=0.3, max_depth=3, validation=None)


@pytest.fixture(scope="module")
def boosted(prepared):
    features, marked = prepared
    return build(features)(12).fit(training.spread(marked.where("not is_stop")))


def inputs(features):
    return training._inputs(features)


def test_trees_of_a_table_score_like_mllib(spark, prepared, boosted):
    features, marked = prepared
    table = trees.tree_table(spark, boosted.stages[-1])
    margins = trees.with_tree_values(marked, table, inputs(features), ["userId"], running=True)
    theirs = boosted.transform(marked).select("userId", vector_to_array("rawPrediction")[1].alias("raw"))
    for r in margins.join(theirs, "userId").collect():
        assert len(r["values"]) == 12 and r["values"][-1] == pytest.approx(r.raw, abs=1e-9)


def test_a_forest_as_a_table_scores_like_mllib(spark, prepared):
    features, marked = prepared
    model = training.random_forest(features, trees=7, max_depth=4).fit(training.spread(marked))
    table = trees.tree_table(spark, model.stages[-1])
    ours = trees.forest_scores(marked, table, inputs(features), ["userId", "churn"])
    theirs = training.with_probability(model, marked).select("userId", F.col("score").alias("theirs"))
    assert all(r.score == pytest.approx(r.theirs, abs=1e-9) for r in ours.join(theirs, "userId").collect())
    assert ours.columns == ["userId", "churn", "score"] and ours.count() == 400
    # the table is data: written and read again it scores the same
    again = spark.createDataFrame(table.collect(), trees.NODES)
    assert rows_of(trees.forest_scores(marked, again, inputs(features), ["userId", "churn"])) == rows_of(ours)


def test_rounds_do_not_depend_on_those_that_follow_and_a_cut_is_a_short_fit(spark, prepared, boosted, tmp_path):
    features, marked = prepared
    short = build(features)(5).fit(training.spread(marked.where("not is_stop")))
    cut = boosting.cut_after(boosted, 5)
    score = lambda model: rows_of(training.with_probability(model, marked).select("userId", "score"))
    assert score(cut) == score(short) != score(boosted)
    cut.write().save(str(tmp_path / "cut"))
    assert score(PipelineModel.load(str(tmp_path / "cut"))) == score(short)


def test_the_kept_round_is_the_best_by_brute_force(spark, prepared, boosted):
    features, marked = prepared
    stopping = marked.where("is_stop")
    judge = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="churn", numBins=0)
    aucs = [judge.evaluate(training.with_probability(boosting.cut_after(boosted, k), stopping)) for k in range(1, 13)]
    margins = trees.with_tree_values(stopping, trees.tree_table(spark, boosted.stages[-1]), inputs(features), ["churn"], running=True)
    found = {r.round: r.roc_auc for r in boosting.staged_auc(margins).collect()}
    assert [found[k] for k in range(1, 13)] == pytest.approx(aucs, abs=1e-9)
    model, table = boosting.fit_with_patience(build(features), training.spread(marked.where("not is_stop")), stopping, inputs(features), rounds=12, patience=4)
    best, _ = stopping_round(aucs, 4)
    assert len(model.stages[-1].trees) == best
    assert [r.round for r in table.collect() if r.is_best] == [best]


@pytest.mark.parametrize(
    ("aucs", "patience", "want"),
    [
        ([0.5, 0.6, 0.7], 2, (3, False)),
        ([0.7, 0.6, 0.6, 0.9], 2, (1, True)),
        ([0.7, 0.6, 0.6, 0.9], 3, (4, False)),
        ([0.7, 0.7, 0.7], 2, (1, True)),
        ([None, None], 1, (2, False)),
        ([None, 0.5, None, 0.4], 5, (2, False)),
        ([], 3, (0, False)),
    ],
)
def test_patience(aucs, patience, want):
    assert stopping_round(aucs, patience) == want


def test_patience_against_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(200):
        aucs, patience = list(rng.integers(0, 6, rng.integers(1, 25)) / 6), int(rng.integers(1, 6))
        best = 0
        for at in range(len(aucs)):
            best = int(np.argmax(aucs[: at + 1]))
            if at - best >= patience:
                break
        assert stopping_round(aucs, patience)[0] == best + 1


def test_training_with_patience(points):
    _, _, scored, records = training.train_gradient_boosting(points, rounds=8, patience=3, step=0.3, max_depth=3)
    assert {r.metric: r.value for r in records.collect()}["AUC_ROC"] > 0.7
    assert scored.where("score < 0 or score > 1").count() == 0
    with pytest.raises(ValueError, match="patience"):
        training.train_gradient_boosting(points, patience=0)


def test_the_churn_query_boosts_with_all_rounds_and_the_full_patience(spark, points, monkeypatch):
    from stayline.registry import queries

    asked = []

    def spy(build, training_rows, stopping, inputs, rounds, patience):
        asked.append((rounds, patience))
        return build(2).fit(training_rows), None

    monkeypatch.setattr(queries, "_commerce_features", lambda spark, sf_dir: points)
    monkeypatch.setattr(training, "fit_with_patience", spy)
    assert queries.gbt_churn_scores(spark, "").where("is_probability and follows_threshold").count() > 0
    assert asked == [(1000, 100)]


def test_hundreds_of_rounds_have_a_folder_to_cut_their_lineage_in(spark, prepared):
    features, marked = prepared
    small = lambda n: training.gradient_boosting(features, min(n, 3), max_depth=1, validation=None)
    boosting.fit_with_patience(small, training.spread(marked.where("not is_stop")), marked.where("is_stop"), inputs(features), rounds=3, patience=3)
    assert spark.sparkContext.getCheckpointDir()
