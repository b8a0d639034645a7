"""The forest grown from histograms against MLlib's."""

import numpy as np
import pytest
from logs import rows_of
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.sql import functions as F

from stayline.operators.metrics import roc_auc
from stayline.operators.splitting import with_balanced_weight
from stayline.plans import forests, training


@pytest.fixture(scope="module")
def rows(spark):
    at = lambda salt, n: F.pmod(F.hash("id", F.lit(salt)), F.lit(n)).cast("double")
    table = spark.range(900).select(F.col("id").alias("userId"), F.when(F.col("id") % 13 != 0, at("a", 20)).alias("a"), at("b", 25).alias("b"), (at("c", 2) > 0).alias("c"), at("_n", 30).alias("_n"))
    churn = (2 * F.coalesce("a", F.lit(30.0)) + F.col("b") + F.col("_n") < 40).cast("int")
    named = training.model_input(table.withColumn("churn", churn).drop("_n"), ["a", "b", "c"])
    return with_balanced_weight(named).repartition(3, "userId").sortWithinPartitions("userId").cache()


def theirs(pipeline):
    assembler, own = pipeline.getStages()
    return Pipeline(stages=[assembler, RandomForestClassifier(**{p.name: v for p, v in own._paramMap.items()})])


@pytest.mark.parametrize("impurity", ["gini", "entropy"])
def test_a_tree_of_all_rows_and_features_is_mllibs(rows, impurity):
    rows = rows.where("_f0 is not null")  # MLlib cuts missing values off at a threshold that no row is below
    pipeline = training.random_forest(["a", "b", "c"], trees=1, max_depth=6, impurity=impurity)
    pipeline.getStages()[-1].setBootstrap(False).setFeatureSubsetStrategy("all")
    ours, other = pipeline.fit(rows), theirs(pipeline).fit(rows)
    assert isinstance(pipeline.getStages()[-1], forests.HistogramForest)
    score = lambda m: [(r.userId, r.score) for r in sorted(training.with_probability(m, rows).select("userId", "score").collect())]
    for (a, x), (b, y) in zip(score(ours), score(other), strict=True):
        assert a == b and x == pytest.approx(y, abs=1e-9)
    assert ours.stages[-1].featureImportances.toArray() == pytest.approx(other.stages[-1].featureImportances.toArray(), abs=1e-9)
    assert ours.stages[-1].trees[0].numNodes == other.stages[-1].trees[0].numNodes


def test_a_forest_is_as_good_as_mllibs_and_loads_again(rows, tmp_path):
    train, test = rows.where("userId % 3 > 0"), rows.where("userId % 3 = 0")
    pipeline = training.random_forest(["a", "b", "c"], trees=24, max_depth=6)
    ours, other = pipeline.fit(train), theirs(pipeline).fit(train)
    auc = lambda m: roc_auc(training.with_probability(m, test)).collect()[0].roc_auc
    assert len(ours.stages[-1].trees) == 24 and auc(ours) > auc(other) - 0.02
    ours.stages[-1].write().save(str(tmp_path / "forest"))
    again = RandomForestClassificationModel.load(str(tmp_path / "forest"))
    assert again.toDebugString.split("\n", 1)[1] == ours.stages[-1].toDebugString.split("\n", 1)[1]
    repeated = pipeline.fit(train)
    assert rows_of(training.with_probability(repeated, test).select("userId", "score")) == rows_of(training.with_probability(ours, test).select("userId", "score"))


def test_a_task_holds_the_statistics_of_one_tree(rows):
    block = forests.Block(0, np.array([[0, 3], [2, 1], [4, 3]], "u1"), np.array([1.0, 2.0, 4.0]))
    tree, widths = forests.Tree(), np.array([3, 2])
    subset = forests.chosen(42, 7, 0, 1, 2, 2)
    cells = forests.histogram(tree, block, np.array([1, 0, 2], "u1"), subset, widths)
    assert cells.tolist() == [1, 0, 0, 0, 8, 0, 0, 0, 0, 9]
    bags = [forests.bag(42, 7, k, 100_000, 1.0, True) for k in (0, 0, 1)]
    assert (bags[0] == bags[1]).all() and (bags[0] != bags[2]).any()
    assert bags[0].mean() == pytest.approx(1, abs=0.02) and (bags[0] == 0).mean() == pytest.approx(np.exp(-1), abs=0.01)


def test_thresholds_lie_between_values_or_at_even_counts():
    few = [forests.summary(np.array([1.0, 2.0, np.nan])), forests.summary(np.array([8.0, 2.0]))]
    assert forests.thresholds(few, 32).tolist() == [1.5, 5.0, 8.0]
    many = [forests.summary(np.arange(k, 50_000, 2.0)) for k in (0, 1)]
    cuts = forests.thresholds(many, 32)
    assert len(cuts) == 31 and np.diff(cuts) == pytest.approx(50_000 / 32, rel=0.03)
    assert forests.thresholds([forests.summary(np.array([3.0, 3.0]))], 32).size == 0


def test_labels_and_empty_tables(rows):
    pipeline = training.random_forest(["a", "b", "c"], trees=2)
    with pytest.raises(ValueError, match="no rows"):
        pipeline.fit(rows.where("false"))
    with pytest.raises(ValueError, match="0 and 1"):
        pipeline.fit(rows.withColumn("churn", F.lit(2)))
