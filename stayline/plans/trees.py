"""Tree ensembles as tables of splits, and what every single tree says about a row.

A fitted model's nodes come out as rows, so its trees can be read, stored and compared
like other data, and scored one by one: MLlib itself only tells their sum.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.staging import new_path

#: A node's row goes to ``low`` where its feature is at most ``threshold``; leaves have no feature.
NODES = "tree INT, weight DOUBLE, node INT, feature INT, threshold DOUBLE, low INT, high INT, value DOUBLE"
#: Values held at once: rows of a slice times trees.
_CELLS = 2_000_000


def tree_table(spark: SparkSession, model: RandomForestClassificationModel | GBTClassificationModel) -> DataFrame:
    """``NODES`` of a fitted model.

    ``value`` is a leaf's share of class 1 in a forest and its summand of the margin in
    boosting; the model's score is the weighted mean or the weighted sum over trees.
    """
    path = new_path(spark)
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    weights = spark.createDataFrame(list(enumerate(map(float, model.treeWeights))), "treeID INT, weight DOUBLE")
    leaf = F.col("leftChild") < 0
    stats = F.col("impurityStats")
    share = stats[1] / F.aggregate(stats, F.lit(0.0), lambda total, x: total + x)
    value = F.col("prediction") if isinstance(model, GBTClassificationModel) else share
    cut = F.when(~leaf, F.col("split.leftCategoriesOrThreshold")[0])
    return nodes.join(weights, "treeID").select(
        F.col("treeID").alias("tree"),
        "weight",
        F.col("id").alias("node"),
        F.when(~leaf, F.col("split.featureIndex")).alias("feature"),
        cut.alias("threshold"),
        F.when(~leaf, F.col("leftChild")).alias("low"),
        F.when(~leaf, F.col("rightChild")).alias("high"),
        F.when(leaf, value).alias("value"),
    )


class Trees:
    """The nodes of all trees in arrays; as large as the model, whatever the data."""

    def __init__(self, table: DataFrame) -> None:
        rows = sorted(table.collect(), key=lambda r: (r.tree, r.node))
        place = {(r.tree, r.node): k for k, r in enumerate(rows)}
        told = lambda r, child: place[r.tree, child] if r.feature is not None else place[r.tree, r.node]
        self.feature = np.array([-1 if r.feature is None else r.feature for r in rows])
        self.threshold = np.array([np.nan if r.threshold is None else r.threshold for r in rows])
        self.low = np.array([told(r, r.low) for r in rows])
        self.high = np.array([told(r, r.high) for r in rows])
        self.value = np.array([np.nan if r.value is None else r.value for r in rows])
        roots = [r for r in rows if r.node == 0]
        self.roots = np.array([place[r.tree, 0] for r in roots])
        self.weights = np.array([r.weight for r in roots])

    def values(self, x: np.ndarray) -> np.ndarray:
        """(rows, trees): the value of the leaf that each row reaches; a missing feature goes high, as in MLlib."""
        at = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        rows = np.arange(len(x))[:, None]
        while (inner := self.feature[at] >= 0).any():
            low = x[rows, np.maximum(self.feature[at], 0)] <= self.threshold[at]
            at = np.where(inner, np.where(low, self.low[at], self.high[at]), at)
        return self.value[at]


def with_tree_values(
    df: DataFrame, table: DataFrame, features: Sequence[str], keep: Sequence[str], running: bool = False
) -> DataFrame:
    """``keep`` and ``values``: the weighted value of every tree, in order; their running sums if ``running``."""
    trees = Trees(table)
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", values array<double>"
    inputs = F.array(*[F.col(f).cast("double") for f in features])
    at_once = max(1, _CELLS // max(1, len(trees.roots)))

    def score(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for start in range(0, whole.num_rows, at_once):
                part = whole.slice(start, at_once)
                flat = part.column(len(keep)).flatten().to_numpy(zero_copy_only=False)
                told = trees.values(flat.reshape(part.num_rows, -1)) * trees.weights
                told = np.cumsum(told, 1) if running else told
                offsets = pa.array(np.arange(part.num_rows + 1, dtype=np.int32) * told.shape[1])
                values = pa.ListArray.from_arrays(offsets, pa.array(told.ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], values], names=[*keep, "values"])

    return df.select(*keep, inputs.alias("values")).mapInArrow(score, schema)


def forest_scores(df: DataFrame, table: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """``keep`` and ``score``: the weighted mean of the trees."""
    total = F.aggregate("values", F.lit(0.0), lambda held, x: held + x)
    weight = table.where(F.col("node") == 0).agg(F.sum("weight")).first()[0]
    return with_tree_values(df, table, features, keep).select(*keep, (total / F.lit(weight)).alias("score"))
