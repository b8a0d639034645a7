"""Groups inside Arrow streams: whole groups per batch, pairs within groups, local components.

A large group is cut into blocks by a hash of its members, and every two blocks meet
in a group of their own, so no task holds more than two blocks however large the
group is.  ``side`` tells the blocks apart; a block that meets itself has side 0 only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def in_blocks(members: DataFrame, member: str, size: str, block: int) -> DataFrame:
    """Rows of ``members``, each once for every block that its own block meets: ``low``, ``high`` and ``side``.

    ``size`` names the column with the number of members of the group.
    """
    n = F.greatest(F.ceil(F.col(size) / block), F.lit(1)).cast("int")
    own = F.pmod(F.xxhash64(member, F.lit("block")), n).cast("int")
    rows = members.withColumn("own", own).withColumn("met", F.explode(F.sequence(F.lit(0), n - 1)))
    low, high = F.least("own", "met"), F.greatest("own", "met")
    side = F.when((low != high) & (F.col("own") == high), 1).otherwise(0)
    return rows.withColumns({"low": low, "high": high, "side": side}).drop("own", "met")


def whole_groups(parts: Iterator[pa.RecordBatch], keys: int, rows: int = 4_096) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of about ``rows`` rows that end where a group ends, with each row's group number.

    The stream is sorted by its first ``keys`` columns, which hold no nulls.
    """

    def starts(table: pa.Table) -> np.ndarray:
        change = np.zeros(table.num_rows, bool)
        change[:1] = True
        for k in range(keys):
            column = table.column(k).to_numpy()
            change[1:] |= column[1:] != column[:-1]
        return change

    held: list[pa.RecordBatch] = []
    count = 0
    for part in parts:
        for at in range(0, part.num_rows, rows):
            held.append(part.slice(at, rows))
            count += held[-1].num_rows
            if count < rows:
                continue
            table = pa.Table.from_batches(held)
            first = starts(table)
            cut = int(np.flatnonzero(first)[-1])
            if cut:
                yield table.slice(0, cut), np.cumsum(first[:cut]) - 1
            rest = table.slice(cut).combine_chunks().to_batches()
            held, count = rest, table.num_rows - cut
    if held:
        table = pa.Table.from_batches(held)
        if table.num_rows:
            yield table, np.cumsum(starts(table)) - 1


def pairs(groups: np.ndarray, side: np.ndarray, at_once: int = 200_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of the pairs that meet: across the sides of a group that has two, else within it."""
    bounds = np.append(np.flatnonzero(np.append(True, groups[1:] != groups[:-1])), len(groups))
    left: list[np.ndarray] = []
    right: list[np.ndarray] = []
    held = 0
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a < 2:
            continue
        members = np.arange(a, b)
        other = side[a:b] == 1
        if other.any():
            i, j = (x.ravel() for x in np.meshgrid(members[~other], members[other], indexing="ij"))
        else:
            i, j = np.triu_indices(b - a, 1)
            i, j = i + a, j + a
        left.append(i)
        right.append(j)
        held += len(i)
        if held >= at_once:
            yield np.concatenate(left), np.concatenate(right)
            left, right, held = [], [], 0
    if left:
        yield np.concatenate(left), np.concatenate(right)


def local_components(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of ``n`` rows the smallest row that the pairs connect it with."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, label[i], low)
        np.minimum.at(label, label[j], low)
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if (label == before).all():
            break
    return label
