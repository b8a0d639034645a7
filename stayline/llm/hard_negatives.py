"""Hard negatives by a secondary sort: scores in the key, negatives read off the sorted stream.

The score of a row for an anchor is the inner product of their components, each
``floor(scale * x)`` first.  An anchor's positives are the first rows of its own label;
for each of them come the first rows of other labels whose score lies between two
percentages of the positive's.  Higher scores come first, ties by the smaller id.

Every pair of an anchor and a row is scored, in blocks of anchors against blocks of
rows that meet in one group each.  A block tells only what it cannot rule out: of an
anchor's own label the first few rows, and, once the positives are known, the first few
rows inside each of their windows.  What is left is packed into keys (anchor, descending
score, positive before negative, id) and goes through
``repartitionAndSortWithinPartitions``; an iterator opens a window at each positive and
passes negatives out while it is open.  It holds the open windows of one anchor and
nothing else, and the sort spills.

Cases: rows with a null id, label or vector or with a null or non-finite component take
no part; rows of one id count once, the smallest by label and vector; vectors of
different lengths do not score; an anchor without positives, or a positive without rows
in its window, gives no row; a positive of negative score has an empty window and one of
score 0 takes rows of score 0; empty vectors score 0; an empty table gives an empty
result; other columns are not read.  A score that no long holds stops the job.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.llm.blocks import whole_groups
from stayline.staging import stage

#: Anchor, descending score, 0 for a positive, id: big-endian and moved above zero, so bytes sort as the numbers do.
KEY = struct.Struct(">QQBQ")
_FIELDS = np.dtype([("anchor", ">u8"), ("score", ">u8"), ("negative", "u1"), ("id", ">u8")])
_MIDDLE = 1 << 63
#: Inner products below this are exact in doubles.
_EXACT = float(1 << 53)

FOUND = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


@dataclass(frozen=True)
class Mining:
    """Percentages are of the positive's score; ``anchors_at_once`` and ``rows_at_once`` bound one block."""

    scale: int = 256
    positives: int = 5
    negatives: int = 10
    low: int = 30
    high: int = 90
    anchors_at_once: int = 256
    rows_at_once: int = 4_096


def packed(anchor: np.ndarray, score: np.ndarray, negative: bool, ids: np.ndarray) -> pa.Array:
    """Keys of pairs as binary values."""
    if not all(-_MIDDLE <= s < _MIDDLE for s in (score.min(), score.max())):
        raise OverflowError("a score does not fit a long")
    keys = np.empty(len(ids), _FIELDS)
    keys["anchor"] = anchor.astype(np.int64).view(np.uint64) ^ np.uint64(_MIDDLE)
    keys["score"] = ~(score.astype(np.int64).view(np.uint64) ^ np.uint64(_MIDDLE))
    keys["negative"] = negative
    keys["id"] = ids.astype(np.int64).view(np.uint64) ^ np.uint64(_MIDDLE)
    return pa.Array.from_buffers(pa.binary(KEY.size), len(ids), [None, pa.py_buffer(keys.tobytes())]).cast(pa.binary())


def unpacked(key: bytes) -> tuple[int, int, int, int]:
    """(anchor, score, negative, id) of a key."""
    anchor, score, negative, row = KEY.unpack(key)
    return anchor - _MIDDLE, _MIDDLE - 1 - score, negative, row - _MIDDLE


def first_of(keys: Iterable[bytes], most: int) -> Iterator[tuple[int, int, int]]:
    """(anchor, id, score) of the first ``most`` keys of every anchor."""
    anchor, left = None, 0
    for key in keys:
        own, score, _, row = unpacked(key)
        if own != anchor:
            anchor, left = own, most
        if left:
            left -= 1
            yield own, row, score


def through_windows(keys: Iterable[bytes], mining: Mining) -> Iterator[tuple[int, int, int, int, int, int]]:
    """Rows of ``FOUND`` from sorted keys; only the windows of one anchor are held."""
    anchor, windows = None, []
    for key in keys:
        own, score, negative, row = unpacked(key)
        if own != anchor:
            anchor, windows = own, []
        if not negative:
            if len(windows) < mining.positives:
                windows.append([row, score, 0])
            continue
        for window in windows:
            positive, its_score, given = window
            if given < mining.negatives and mining.low * its_score <= 100 * score <= mining.high * its_score:
                window[2] += 1
                yield own, positive, given + 1, row, its_score, score


def usable(rows: DataFrame, scale: int) -> DataFrame:
    """(vec_id, label, v): one row per id, components as whole numbers."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    kept = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite)
    kept = kept.select(F.col("vec_id").cast("long"), F.struct(F.col("label").cast("long").alias("label"), whole.alias("v")).alias("row"))
    return kept.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.label", "row.v")


def _met(rows: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int, mining: Mining) -> DataFrame:
    """Blocks of anchors (side 0) and of rows (side 1), each two blocks in a group (dim, ab, rb) of their own.

    ``anchors`` has a column ``windows`` beside those of ``rows``.
    """
    blocks_a = max(1, -(-n_anchors // mining.anchors_at_once))
    blocks_r = max(1, -(-n_rows // mining.rows_at_once))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    own = lambda n, salt: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(n)).cast("int")
    told = ("vec_id", "label", "v", "windows")
    left = anchors.withColumns({"ab": own(blocks_a, "anchor"), "rb": every(blocks_r), "side": F.lit(0)})
    right = rows.withColumn("windows", F.lit(None).cast("array<long>"))
    right = right.withColumns({"rb": own(blocks_r, "row"), "ab": every(blocks_a), "side": F.lit(1)})
    shape = lambda t: t.select(F.size("v").alias("dim"), "ab", "rb", "side", *told)
    groups = shape(left).unionByName(shape(right)).repartition(min(blocks_a * blocks_r, 20_000), "dim", "ab", "rb")
    return groups.sortWithinPartitions("dim", "ab", "rb", "side", "vec_id")


def _products(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products; Python's whole numbers where doubles would round."""
    if not anchors.shape[1]:
        return np.zeros((len(anchors), len(rows)), np.int64)
    largest = float(np.abs(anchors.astype(float)).max()) * float(np.abs(rows.astype(float)).max()) * anchors.shape[1]
    if largest < _EXACT:
        return (anchors.astype(float) @ rows.T.astype(float)).astype(np.int64)
    return anchors.astype(object) @ rows.T.astype(object)


def _scored(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(anchor id, its label, its windows, ids, labels, scores) of every anchor in every group; ids ascend."""
    for table, groups in whole_groups(parts, 3):
        bounds = np.append(np.flatnonzero(np.append(True, groups[1:] != groups[:-1])), len(groups))
        side, ids, labels = (table.column(c).to_numpy() for c in ("side", "vec_id", "label"))
        vectors, dims = table.column("v").combine_chunks(), table.column("dim").to_numpy()
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            middle = a + int((side[a:b] == 0).sum())
            if middle in (a, b):
                continue
            both = vectors.slice(a, b - a).flatten().to_numpy(zero_copy_only=False).reshape(b - a, dims[a])
            scores = _products(both[: middle - a], both[middle - a :])
            windows = table.column("windows").slice(a, middle - a).to_pylist()
            for k in range(middle - a):
                yield ids[a + k], labels[a + k], windows[k], ids[middle:b], labels[middle:b], scores[k]


def _first_positives(mining: Mining):
    """Keys of the first rows of an anchor's own label in every block."""

    def tell(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for anchor, label, _, ids, labels, scores in _scored(parts):
            at = np.flatnonzero((labels == label) & (ids != anchor))
            at = at[np.argsort(-scores[at], kind="stable")[: mining.positives]]
            if len(at):
                yield pa.RecordBatch.from_arrays([packed(np.full(len(at), anchor), scores[at], False, ids[at])], names=["key"])

    return tell


def _first_in_windows(mining: Mining):
    """Keys of the first rows of other labels inside each window of an anchor, each row once, in every block."""

    def tell(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for anchor, label, windows, ids, labels, scores in _scored(parts):
            at = np.flatnonzero(labels != label)
            at = at[np.argsort(-scores[at], kind="stable")]
            falling = -100 * scores[at]
            told = set()
            for positive in windows:
                first = int(np.searchsorted(falling, -mining.high * positive, "left"))
                last = int(np.searchsorted(falling, -mining.low * positive, "right"))
                told.update(range(first, min(last, first + mining.negatives)))
            if told:
                at = at[sorted(told)]
                yield pa.RecordBatch.from_arrays([packed(np.full(len(at), anchor), scores[at], True, ids[at])], names=["key"])

    return tell


def _sorted_keys(keys: DataFrame, parts: int):
    """The keys of each anchor in one partition, in order."""
    pairs = keys.rdd.map(lambda row: (bytes(row[0]), None))
    return pairs.repartitionAndSortWithinPartitions(parts, lambda key: zlib.crc32(key[:8]))


def mine(rows: DataFrame, is_anchor: Column, mining: Mining = Mining()) -> DataFrame:
    """Columns of ``FOUND``; ``rows`` holds vec_id, label (whole numbers) and embedding."""
    spark = rows.sparkSession
    table = stage(usable(rows, mining.scale))
    anchors = stage(table.where(is_anchor))
    n_rows, n_anchors = table.count(), anchors.count()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    met = _met(table, anchors.withColumn("windows", F.lit(None).cast("array<long>")), n_rows, n_anchors, mining)
    keys = met.mapInArrow(_first_positives(mining), "key binary")
    found = _sorted_keys(keys, parts).mapPartitions(lambda pairs: first_of((key for key, _ in pairs), mining.positives))
    positives = stage(spark.createDataFrame(found, "vec_id long, id long, score long"))

    windows = positives.groupBy("vec_id").agg(F.collect_list("score").alias("windows"))
    met = _met(table, anchors.join(windows, "vec_id"), n_rows, n_anchors, mining)
    negatives = met.mapInArrow(_first_in_windows(mining), "key binary")

    def keyed(part: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in part:
            if batch.num_rows:
                anchor, ids, score = (batch.column(k).to_numpy() for k in range(3))
                yield pa.RecordBatch.from_arrays([packed(anchor, score, False, ids)], names=["key"])

    keys = positives.mapInArrow(keyed, "key binary").unionByName(negatives)
    found = _sorted_keys(keys, parts).mapPartitions(lambda pairs: through_windows((key for key, _ in pairs), mining))
    return spark.createDataFrame(found, FOUND)
