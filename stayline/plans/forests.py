"""Random forests grown from histograms, tree by tree in the processor's cache.

MLlib keeps the statistics of all open nodes of all trees in one array and takes every row
through all trees, so each of its steps misses the cache once that array is larger than it.
Here the rows are binned once into blocks of bytes, and a task takes a block through one tree
after the other.  The rest is MLlib's: the number of trees and levels, Poisson bags, a random
subset of features for every node, at most ``maxBins`` bins, weights, both impurities.  What
comes out is MLlib's own model, which scores, saves and loads like any other.

Blocks are the partitions of the data.  Tasks pass on histograms only: they are added up by
tree, in the order of the blocks, so a seed gives the same forest on every cluster.  Bins come from the
distinct values where a block has few of them and else from its quantiles.
"""

from __future__ import annotations

import json
import math
import time
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.staging import new_path

#: Distinct values of a feature that a block tells the driver exactly; above, so many quantiles.
VALUES = 2_000
#: Trees of a task at least, the most groups that trees are dealt into, and tasks that add up histograms.
TREES, GROUPS, SUMS = 8, 8, 4
_DATA = (
    "treeID INT, nodeData STRUCT<id INT, prediction DOUBLE, impurity DOUBLE, impurityStats ARRAY<DOUBLE>, rawCount BIGINT, "
    "gain DOUBLE, leftChild INT, rightChild INT, split STRUCT<featureIndex INT, leftCategoriesOrThreshold ARRAY<DOUBLE>, numCategories INT>>"
)


def subset_size(strategy: str, features: int) -> int:
    """Features that a node chooses from, by MLlib's names for it."""
    named = {"all": features, "auto": math.ceil(math.sqrt(features)), "sqrt": math.ceil(math.sqrt(features)),
             "log2": max(1, math.ceil(math.log2(features))), "onethird": math.ceil(features / 3)}
    if strategy in named:
        return named[strategy]
    if strategy.isdigit():
        return min(int(strategy), features)
    return math.ceil(float(strategy) * features)


def summary(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted values of a feature, a missing one last, and how many rows each stands for."""
    found, counts = np.unique(values, return_counts=True)
    if len(found) <= VALUES:
        return found, counts
    known = len(found) - int(np.isnan(found[-1]))
    upto = np.cumsum(counts[:known])
    places = np.unique(np.searchsorted(upto, np.linspace(0, upto[-1], VALUES + 1)[1:]))
    return np.append(found[places], found[known:]), np.append(np.diff(upto[places], prepend=0), counts[known:])


def thresholds(summaries: Sequence[tuple[np.ndarray, np.ndarray]], bins: int) -> np.ndarray:
    """Where a feature may be split: between all its values if they are few, else at even numbers of rows.

    Missing values lie above all others and have a cut of their own at the largest one.
    """
    values, counts = (np.concatenate(parts) for parts in zip(*summaries))
    known = ~np.isnan(values)
    found, place = np.unique(values[known], return_inverse=True)
    counts, last = counts[known], found[-1:] if not known.all() else found[:0]
    if len(found) < 2:
        return last
    between = found[:-1] + (found[1:] - found[:-1]) / 2
    if len(found) <= bins:
        return np.append(between, last)
    upto = np.cumsum(np.bincount(place, counts))
    wanted = upto[-1] * np.arange(1, bins) / bins
    return np.append(np.unique(between[np.minimum(np.searchsorted(upto, wanted), len(between) - 1)]), last)


def _columns(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        if part.num_rows:
            values = part.column(0).flatten().to_numpy(zero_copy_only=False).astype("f8")
            rest = [part.column(c).to_numpy(zero_copy_only=False).astype("f8") for c in (1, 2)]
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (values, *rest)], names=["values", "label", "weight"])


@dataclass(frozen=True)
class Block:
    """Rows of a partition: by row and feature twice the bin plus the label, and weights."""

    number: int
    codes: np.ndarray
    weight: np.ndarray


@dataclass
class Tree:
    """A growing tree, level by level: of a level's open nodes the feature (-1: none), the last low bin and both children.

    A child is its place among the open nodes of the next level, or -1.  ``nodes`` has rows of
    (id, class weights, gain, low id, high id, feature, bin) for the stored model.
    """

    feature: list[np.ndarray] = field(default_factory=list)
    bin: list[np.ndarray] = field(default_factory=list)
    child: list[np.ndarray] = field(default_factory=list)
    open: int = 1
    ids: np.ndarray = field(default_factory=lambda: np.zeros(1, "i8"))
    stats: np.ndarray | None = None
    nodes: list[tuple] = field(default_factory=list)
    next_id: int = 1


def chosen(seed: int, tree: int, level: int, nodes: int, features: int, size: int) -> np.ndarray:
    """(nodes, size): the features that every open node of a level chooses from."""
    if size >= features:
        return np.broadcast_to(np.arange(features), (nodes, features))
    drawn = np.random.default_rng([seed, 1, tree, level]).random((nodes, features))
    return np.sort(np.argpartition(drawn, size - 1, 1)[:, :size], 1)


def bag(seed: int, tree: int, block: int, rows: int, rate: float, bootstrap: bool) -> np.ndarray:
    """How often every row counts in a tree: Poisson numbers, or 0 and 1 without replacement."""
    if not bootstrap and rate >= 1:
        return np.ones(rows, "u1")
    drawn = np.random.default_rng([seed, 2, tree, block]).random(rows)
    if not bootstrap:
        return (drawn < rate).astype("u1")
    found, upto, share, k = np.zeros(rows, "u1"), 0.0, math.exp(-rate), 0
    while upto + share > upto and k < 200:
        upto += share
        found += drawn >= upto
        k += 1
        share *= rate / k
    return found


def layout(subset: np.ndarray, widths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each (node, slot) begins within its slot's cells, two a bin, and the cells of every slot."""
    cells = 2 * widths[subset]
    ends = np.cumsum(cells, 0)
    return ends - cells, ends[-1]


def reached(tree: Tree, block: Block, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows that are in open nodes, where they begin in the codes, and the places of these nodes."""
    flat, width = block.codes.ravel(), block.codes.shape[1]
    base, pos = rows * width, np.zeros(len(rows), "i8")
    for feature, last, child in zip(tree.feature, tree.bin, tree.child):
        high = flat.take(base + feature.take(pos)) > (2 * last + 1).take(pos)
        pos = child.take(2 * pos + high)
        if (child < 0).any():
            inside = np.flatnonzero(pos >= 0)
            rows, base, pos = rows.take(inside), base.take(inside), pos.take(inside)
    return rows, base, pos


def histogram(tree: Tree, block: Block, counted: np.ndarray, subset: np.ndarray, widths: np.ndarray) -> np.ndarray:
    """Weights by slot, open node, bin and class."""
    rows, base, pos = reached(tree, block, np.flatnonzero(counted))
    begins, cells = layout(subset, widths)
    weight, flat = block.weight.take(rows) * counted.take(rows), block.codes.ravel()
    slots = []
    for k in range(subset.shape[1]):
        if len(subset) == 1:
            cell = flat.take(base + subset[0, k])
        else:
            cell = flat.take(base + subset[:, k].take(pos)) + begins[:, k].take(pos)
        slots.append(np.bincount(cell, weight, int(cells[k])))
    return np.concatenate(slots)


def _impurity(low: np.ndarray, high: np.ndarray, kind: str) -> np.ndarray:
    total = low + high
    with np.errstate(divide="ignore", invalid="ignore"):
        a, b = low / total, high / total
        if kind == "gini":
            return np.where(total > 0, 1 - a * a - b * b, 0.0)
        told = lambda p: np.where(p > 0, -p * np.log2(np.where(p > 0, p, 1.0)), 0.0)
        return np.where(total > 0, told(a) + told(b), 0.0)


def best_splits(cells: np.ndarray, subset: np.ndarray, widths: np.ndarray, kind: str, least: float) -> tuple:
    """Per open node: feature (-1: none), last low bin, gain, class weights of the whole node and of its low child."""
    begins, sizes = layout(subset, widths)
    begins = begins + np.concatenate([[0], np.cumsum(sizes)[:-1]])
    most = int(widths.max())
    inside = np.arange(most) < widths[subset][:, :, None]
    place = np.where(inside, begins[:, :, None] + 2 * np.arange(most), 0)
    upto = np.stack([np.cumsum(np.where(inside, cells[place + c], 0.0), 2) for c in (0, 1)])
    whole = upto[:, :, :, -1]
    other = whole[:, :, :, None] - upto
    left, right = upto.sum(0), other.sum(0)
    total = left + right
    # Sums of floats may leave a trace of a class that is all on the other side.
    other = np.where(other < 1e-9 * whole[:, :, :, None], 0.0, other)
    splits = np.arange(most) < widths[subset][:, :, None] - 1
    valid = splits & (left > 0) & (right > 1e-9 * total)
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = (left * _impurity(upto[0], upto[1], kind) + right * _impurity(other[0], other[1], kind)) / total
    gain = np.where(valid, _impurity(whole[0], whole[1], kind)[:, :, None] - parts, -np.inf)
    nodes = np.arange(len(subset))
    best = gain.reshape(len(subset), -1).argmax(1)
    slot, split = best // most, best % most
    reached_gain = gain[nodes, slot, split]
    found = reached_gain > max(least, 1e-12)
    low, all_ = upto[:, nodes, slot, split], whole[:, nodes, 0]
    rest = other[:, nodes, slot, split]
    return np.where(found, subset[nodes, slot], -1), np.where(found, split, 0), np.where(found, reached_gain, -1.0), all_.T, low.T, rest.T


def extended(tree: Tree, found: tuple, last: bool) -> None:
    """Add a level to a tree; children that are pure, or on the last level, are leaves at once."""
    feature, split, gain, whole, low, high = found
    split_at = feature >= 0
    children = np.full(2 * tree.open, -1, "i8")
    ids = np.full(2 * tree.open, -1, "i8")
    both = np.repeat(split_at, 2)
    ids[both] = tree.next_id + np.arange(both.sum())
    stats = np.empty((2 * tree.open, 2))
    stats[0::2], stats[1::2] = low, high
    grows = both & (stats.min(1) > 0) & (not last)
    children[grows] = np.arange(grows.sum())
    own = whole if tree.stats is None else tree.stats
    tree.nodes.append((tree.ids, own, gain, ids[0::2], ids[1::2], feature, split))
    leaves = both & ~grows
    none = np.full(leaves.sum(), -1, "i8")
    tree.nodes.append((ids[leaves], stats[leaves], none.astype("f8"), none, none, none, none))
    tree.feature.append(np.where(split_at, feature, 0))
    tree.bin.append(np.where(split_at, split, 255))
    tree.child.append(children)
    tree.next_id += int(both.sum())
    tree.open, tree.ids, tree.stats = int(grows.sum()), ids[grows], stats[grows]


def binned(dataset: DataFrame, features: str, label: str, weight: str | None, bins: int) -> tuple[RDD, list[np.ndarray]]:
    """Blocks, kept until unpersisted, and the thresholds of every feature."""
    chosen_ = dataset.select(
        vector_to_array(features).alias("values"), F.col(label).cast("double").alias("label"),
        (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("weight"),
    )
    packed = chosen_.mapInArrow(_columns, "values binary, label binary, weight binary")

    def joined(rows) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        parts = [[np.frombuffer(x) for x in (r.values_, r.label, r.weight)] for r in rows]
        if parts:
            values, told, weights = (np.concatenate(p) for p in zip(*parts))
            yield values.reshape(len(told), -1), told, weights

    raw = packed.withColumnRenamed("values", "values_").rdd.mapPartitions(joined).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        told = raw.map(lambda b: (set(np.unique(b[1])) <= {0.0, 1.0}, [summary(c) for c in b[0].T])).collect()
        if not told:
            raise ValueError("there are no rows to fit on")
        if not all(known for known, _ in told):
            raise ValueError("labels are 0 and 1")
        cuts = [thresholds([held[f] for _, held in told], bins) for f in range(len(told[0][1]))]

        def block(number: int, rows) -> Iterator[Block]:
            for values, own, weights in rows:
                codes = np.empty(values.shape, "u1")
                for f, cut in enumerate(cuts):
                    codes[:, f] = 2 * np.searchsorted(cut, values[:, f]) + own.astype("i8")
                yield Block(number, codes, weights)

        blocks = raw.mapPartitionsWithIndex(block).persist(StorageLevel.MEMORY_AND_DISK)
        blocks.count()
    finally:
        raw.unpersist()
    return blocks, cuts


def grow(blocks: RDD, widths: np.ndarray, trees: int, depth: int, size: int, kind: str, seed: int, rate: float, bootstrap: bool, least: float) -> list[Tree]:
    """All trees, a job a level."""
    context, parts = blocks.context, blocks.getNumPartitions()
    # A task costs a tenth of a second whatever it does, so trees are dealt over tasks only while cores would idle.
    groups = max(1, min(GROUPS, trees // TREES, 3 * context.defaultParallelism // parts))
    tasks = context.union([blocks] * groups)
    grown = [Tree() for _ in range(trees)]
    for level in range(depth):
        growing = {t: Tree(g.feature, g.bin, g.child, g.open) for t, g in enumerate(grown) if g.open}
        if not growing:
            break
        sent = context.broadcast(growing)

        def told(task: int, held, sent=sent, level=level):
            for block in held:
                for t, tree in sent.value.items():
                    if t % groups == task // parts:
                        subset = chosen(seed, t, level, tree.open, len(widths), size)
                        counted = bag(seed, t, block.number, len(block.weight), rate, bootstrap)
                        yield t, (block.number, histogram(tree, block, counted, subset, widths))

        def splits(pair, sent=sent, level=level):
            t, held = pair
            cells = sum(h for _, h in sorted(held, key=lambda h: h[0]))
            return t, best_splits(cells, chosen(seed, t, level, sent.value[t].open, len(widths), size), widths, kind, least)

        found = tasks.mapPartitionsWithIndex(told).groupByKey(max(1, min(SUMS, trees // TREES))).map(splits).collect()
        for t, split in found:
            extended(grown[t], split, level + 1 == depth)
        sent.unpersist()
    return grown


def merged(columns: Sequence[np.ndarray]) -> list[np.ndarray]:
    """The nodes of a tree by id; as in MLlib, two leaves of one parent that call the same class become one."""
    order = np.argsort(columns[0])
    ids, stats, gain, low, high, feature, split = (c[order].copy() for c in columns)
    call, kept = (stats[:, 1] > stats[:, 0]).tolist(), np.ones(len(ids), bool)
    children = list(zip(low.tolist(), high.tolist()))
    for k in range(len(ids) - 1, -1, -1):
        a, b = children[k]
        if a >= 0 and children[a][0] < 0 and children[b][0] < 0 and call[a] == call[b]:
            children[k] = (-1, -1)
            kept[[a, b]] = False
    low, high = np.array(children).T
    leaf = low < 0
    gain[leaf], feature[leaf], split[leaf] = -1.0, -1, -1
    place = np.append(np.cumsum(kept) - 1, -1)
    return [c[kept] for c in (place[ids], stats, gain, place[low], place[high], feature, split)]


def _node_rows(trees: Sequence[Tree], cuts: Sequence[np.ndarray], kind: str) -> pa.Table:
    """MLlib's table of nodes."""
    whole = [merged([np.concatenate(column) for column in zip(*tree.nodes)]) for tree in trees]
    number = np.repeat(np.arange(len(trees)), [len(columns[0]) for columns in whole])
    ids, stats, gain, low, high, feature, split = (np.concatenate(column) for column in zip(*whole))
    inner = feature >= 0
    at = np.array([cuts[f][s] for f, s in zip(feature[inner], split[inner])], "f8")
    offsets = np.concatenate([[0], np.cumsum(inner)])
    i4 = lambda x: pa.array(x.astype("i4"))
    splits = pa.StructArray.from_arrays(
        [i4(feature), pa.ListArray.from_arrays(i4(offsets), pa.array(at)), i4(np.full(len(ids), -1))],
        names=["featureIndex", "leftCategoriesOrThreshold", "numCategories"],
    )
    pairs = pa.ListArray.from_arrays(i4(2 * np.arange(len(ids) + 1)), pa.array(stats.ravel()))
    columns = {
        "id": i4(ids), "prediction": pa.array((stats[:, 1] > stats[:, 0]).astype("f8")), "impurity": pa.array(_impurity(stats[:, 0], stats[:, 1], kind)),
        "impurityStats": pairs, "rawCount": pa.array(np.rint(stats.sum(1)).astype("i8")), "gain": pa.array(gain),
        "leftChild": i4(low), "rightChild": i4(high), "split": splits,
    }
    return pa.table({"treeID": i4(number), "nodeData": pa.StructArray.from_arrays(list(columns.values()), names=list(columns))})


def _stored(spark: SparkSession, forest: RandomForestClassifier, trees: Sequence[Tree], cuts: Sequence[np.ndarray]) -> str:
    """Write a forest as MLlib does."""
    path = new_path(spark)
    set_, default = ({p.name: v for p, v in held.items()} for held in (forest._paramMap, forest._defaultParamMap))
    about = {"timestamp": int(time.time() * 1000), "sparkVersion": spark.version}
    of_tree = lambda held: {k: v for k, v in held.items() if k not in ("numTrees", "featureSubsetStrategy", "subsamplingRate", "bootstrap")}
    tree = {"class": "org.apache.spark.ml.classification.DecisionTreeClassificationModel", **about, "paramMap": of_tree(set_), "defaultParamMap": of_tree(default)}
    rows = [(k, json.dumps({**tree, "uid": f"{forest.uid}_{k}"}), 1.0) for k in range(len(trees))]
    metadata = {
        "class": "org.apache.spark.ml.classification.RandomForestClassificationModel", **about, "uid": forest.uid, "paramMap": set_,
        "defaultParamMap": default, "numFeatures": len(cuts), "numClasses": 2, "numTrees": len(trees),
    }
    spark.createDataFrame([(json.dumps(metadata),)], "value STRING").coalesce(1).write.text(f"{path}/metadata")
    spark.createDataFrame(rows, "_1 INT, _2 STRING, _3 DOUBLE").coalesce(1).write.parquet(f"{path}/treesMetadata")
    nodes = spark.createDataFrame(_node_rows(trees, cuts, forest.getImpurity()), _DATA)
    nodes.coalesce(1).write.parquet(f"{path}/data")
    return path


class HistogramForest(RandomForestClassifier):
    """MLlib's random forest of two classes, with its parameters and its model, grown from histograms."""

    def _fit(self, dataset: DataFrame) -> RandomForestClassificationModel:
        if self.getMinInstancesPerNode() != 1 or self.getMinWeightFractionPerNode() or self.getMaxBins() > 128:
            return super()._fit(dataset)
        weight = self.getWeightCol() if self.isDefined(self.weightCol) else None
        blocks, cuts = binned(dataset, self.getFeaturesCol(), self.getLabelCol(), weight, self.getMaxBins())
        try:
            widths = np.array([len(c) + 1 for c in cuts])
            size = subset_size(self.getFeatureSubsetStrategy() if self.getNumTrees() > 1 else "all", len(cuts))
            trees = grow(
                blocks, widths, self.getNumTrees(), self.getMaxDepth(), size, self.getImpurity(),
                self.getSeed() % 2**32, self.getSubsamplingRate(), self.getBootstrap(), self.getMinInfoGain(),
            )
        finally:
            blocks.unpersist()
        return RandomForestClassificationModel.load(_stored(dataset.sparkSession, self, trees, cuts))
