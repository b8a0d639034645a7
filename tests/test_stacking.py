import pytest
from logs import rows_of
from pyspark.sql import functions as F

from stayline.operators.metrics import roc_auc
from stayline.plans import stacking, training
from stayline.plans.model_search import Search, leaderboard
from stayline.staging import stage

FOLDS = 3


NAMES = ["x", "y", "z", "w"]


def noise(spark):
    """Labels that nothing tells, and features by which a deep tree learns them by heart."""
    lot = F.pmod(F.hash("id", F.lit("label")), F.lit(2))
    value = lambda name: F.pmod(F.hash("id", F.lit(name)), F.lit(100_003)).cast("double").alias(name)
    return spark.range(360).select(F.col("id").alias("userId"), lot.alias("churn"), *[value(n) for n in NAMES])


MODELS = {
    "Deep": lambda f: training.random_forest(f, trees=1, max_depth=12),
    "Flat": lambda f: training.logistic_regression(f),
}
FINAL = lambda f: training.random_forest(f, trees=10, max_depth=4)


@pytest.fixture(scope="module")
def found(spark):
    return stacking.stack(noise(spark), MODELS, FINAL, folds=FOLDS)


def test_every_row_meets_every_second_level_once(found):
    rows = found.nested.groupBy("row_id", "model").agg(F.sort_array(F.collect_list("left_out")).alias("left")).collect()
    assert len(rows) == 360 * 2 and all(r.left == [0, 1, 2] for r in rows)
    assert found.scores.count() == 360 and found.scores.select("row_id").distinct().count() == 360
    assert found.inputs == [*NAMES, "score_Deep", "score_Flat"]


def test_the_first_level_is_an_ordinary_search(found):
    board = leaderboard(found.first.scores, found.first.seconds).collect()
    assert {r.model for r in board} == {"Deep", "Flat"} and found.first.scores.count() == 720
    assert isinstance(found.first, Search) and all(len(m) == FOLDS for m in found.first.models.values())


def test_noise_stays_noise(spark, found):
    """Scores by heart would pass for knowledge; those of the nested fits do not."""
    reached = roc_auc(found.scores).first().roc_auc
    assert 0.38 < reached < 0.62
    # a first level that has seen the rows would give the label away
    table = training.model_input(noise(spark), NAMES).withColumn("weight", F.lit(1.0))
    by_heart = training.with_probability(MODELS["Deep"](NAMES).fit(table), table)
    assert roc_auc(by_heart).first().roc_auc > 0.75


def test_no_fold_sees_its_own_labels(spark, found):
    """Other labels in one fold change nothing that the second level of that fold is fitted on or scores."""
    table = noise(spark)
    folds = stage(stacking.with_folds(table.select("userId"), "userId", FOLDS, stacking.SEED))
    own = folds.where("fold = 1").select("userId")
    flipped = table.join(own.withColumn("own", F.lit(1)), "userId", "left").withColumn("churn", F.when(F.col("own") == 1, 1 - F.col("churn")).otherwise(F.col("churn")))
    same = {"Flat": lambda f: training.random_forest(f, trees=3, max_depth=3)}
    plain = lambda f: training.random_forest(f, trees=3, max_depth=3)
    one = stacking.stack(table, same, plain, folds=FOLDS)
    two = stacking.stack(flipped.drop("own"), same, plain, folds=FOLDS)
    keep = ("userId", "score")
    for frame in ("nested", "scores"):
        a, b = (getattr(s, frame).join(own, "userId", "left_semi") if frame == "scores" else getattr(s, frame).where("left_out = 1") for s in (one, two))
        assert rows_of(a, *keep) == rows_of(b, *keep)
    assert rows_of(one.nested.where("left_out = 0"), *keep) != rows_of(two.nested.where("left_out = 0"), *keep)


def test_saved_and_loaded_it_scores_the_same(spark, found, tmp_path):
    path = str(tmp_path / "stack")
    stacking.save_stack(found, path, spark)
    loaded = stacking.load_stack(path, spark)
    new = noise(spark).withColumn("x", F.col("x") + 1.0)
    scores = stacking.score_rows(found, new)
    assert scores.columns == ["userId", "churn", "score"] and scores.where("score < 0 or score > 1").isEmpty()
    assert rows_of(stacking.score_rows(loaded, new)) == rows_of(scores) and scores.count() == 360
    assert rows_of(loaded.nested) == rows_of(found.nested) and loaded.inputs == found.inputs


def test_a_rule_is_learned_through_both_levels(spark):
    table = noise(spark).withColumn("churn", (F.col("x") < 30_000).cast("int"))
    found = stacking.stack(table, {"Forest": lambda f: training.random_forest(f, trees=5, max_depth=3)}, training.logistic_regression, folds=3)
    assert roc_auc(found.scores).first().roc_auc > 0.95
    with pytest.raises(ValueError, match="third"):
        stacking.stack(table, MODELS, FINAL, folds=2)
