"""Near-duplicate embeddings by NN-descent: a neighbour graph refined through neighbours of neighbours.

Equal vectors are one class.  Lists of ``k`` neighbours start from cells that random
planes through a bounded sample cut.  Then every vector's neighbours and those that
name it as neighbour are compared with each other, and each keeps the best it met.
Candidates are compared on vectors rounded to bytes; every link that is reported has
been computed in double precision.

A list whose entries all reach the threshold is saturated and may hide more.  It is
enlarged to everything its saturated region hangs together with: the members meet in
blocks of bounded size and every pair is compared exactly.  Its lists may hide another
region as well, so two regions also meet whole wherever their mean directions and
widest angles allow a link.  Other links are verified one by one.

Recall is audited: the links of a bounded set of queries, drawn by a hash from all vectors
and again from those with few links, are counted against all vectors.  Each query counts
the same among those with about as many links, and the worst of these groups decides, so
a large cluster hides no missed small ones.  Refinement goes on until the audit reaches
``recall``; if the turns end before, all vectors meet in blocks.

Cases: null vectors, zero vectors and vectors with null or non-finite components link
with nothing; vectors of different lengths never link; equal vectors link with each
other; null ids have a row too and are no component's name unless nothing else is in
it; repeated rows are copies; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stayline.llm.blocks import in_blocks, local_components, whole_groups
from stayline.llm.graphs import components
from stayline.staging import stage

#: Added to angles that decide what meets, so that rounding never keeps a link apart.
SLACK = 1e-6


@dataclass(frozen=True)
class Descent:
    threshold: float = 0.9
    k: int = 10
    tables: int = 4
    cell: int = 160
    sample: int = 2_000
    rounds: int = 2
    more_rounds: int = 4
    queries: int = 512
    recall: float = 0.98
    block: int = 512
    told: int = 5
    margin: float = 0.02


def _stack(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """The vectors of a list column as rows."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(flat, pa.ChunkedArray):
        flat = pa.concat_arrays(flat.chunks)
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision; scaled first, so no square overflows."""
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def _bytes(rows: np.ndarray) -> np.ndarray:
    return np.rint(rows * (127 / np.abs(rows).max(1, keepdims=True))).astype(np.int8)


def _lengths(column) -> np.ndarray:
    return np.array([len(v) for v in column.to_pylist()])


def classes_of(vectors: DataFrame) -> DataFrame:
    """One row per different usable vector: number, unit vector, rows that hold it, smallest id."""
    valid = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = vectors.select("vec_id", _normal("embedding").alias("v")).where(valid)
    grouped = rows.groupBy("v").agg(F.count("*").alias("copies"), F.min("vec_id").alias("first"))
    return grouped.select(F.monotonically_increasing_id().alias("node"), F.size("v").alias("dim"), "v", "copies", "first", *_keys("v"))


def _normal(column: str):
    """Doubles, with one zero."""
    return F.transform(F.col(column), lambda x: x.cast("double") + F.lit(0.0))


def _keys(column: str) -> list:
    return [F.xxhash64(column).alias("key"), F.xxhash64(F.lit(1), F.col(column)).alias("key2")]


def _planes(classes: DataFrame, tables: int, bits: int, sample: int, seed: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each length of the sample's vectors: normals and offsets of the planes halfway between two vectors."""
    drawn = classes.orderBy(F.xxhash64("node", F.lit(seed)), "node").limit(sample).select("dim", "v").collect()
    by_dim: dict[int, list] = {}
    for row in drawn:
        by_dim.setdefault(row["dim"], []).append(row["v"])
    rng, found = np.random.default_rng(seed), {}
    for dim, rows in sorted(by_dim.items()):
        u = unit(np.array(rows))
        a, b = (u[rng.integers(0, len(u), tables * bits)] for _ in range(2))
        normal = np.where((a == b).all(1, keepdims=True), rng.normal(size=a.shape), a - b)
        found[dim] = (normal, (normal * (a + b) / 2).sum(1))
    return found


def coded(classes: DataFrame, planes: dict, tables: int, bits: int) -> DataFrame:
    """(node, dim, q, codes): the vector as bytes and the cell it falls into in every table."""

    def code(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        power = 1 << np.arange(bits, dtype=np.int64)
        for part in parts:
            lengths = part.column(1).to_numpy()
            for dim in np.unique(lengths):
                few = part.filter(pa.array(lengths == dim))
                u = unit(_stack(few.column(2), dim))
                normal, offset = planes.get(int(dim), (np.zeros((tables * bits, dim)), np.zeros(tables * bits)))
                cells = ((u @ normal.T > offset).reshape(-1, tables, bits) * power).sum(2)
                columns = [few.column(0), few.column(1), pa.array([q.tobytes() for q in _bytes(u)], pa.binary()), pa.array(list(cells), pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "dim", "q", "codes"])

    return classes.select("node", "dim", "v").mapInArrow(code, "node long, dim int, q binary, codes array<long>")


def _runs(parts: Iterator[pa.RecordBatch], keys: int, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(nodes, byte vectors) of runs of rows with equal keys, ``most`` rows at a time; dims come last among the keys."""
    held: list[pa.RecordBatch] = []

    def cut(rows: list[pa.RecordBatch], last: bool) -> Iterator[tuple[int, int]]:
        table = pa.Table.from_batches(rows).combine_chunks()
        change = np.zeros(table.num_rows, bool)
        for k in range(keys):
            column = table.column(k).to_numpy()
            change[1:] |= column[1:] != column[:-1]
        starts = np.append(0, np.flatnonzero(change))
        ends = np.append(starts[1:], table.num_rows)
        keep = table.num_rows
        if not last and table.num_rows - starts[-1] < most:
            keep = starts[-1]
        nodes, dims = table.column(keys).to_numpy(), table.column(keys - 1).to_numpy()
        packed = table.column(keys + 1).to_pylist()
        for a, b in zip(starts, ends, strict=True):
            for at in range(a, min(b, keep), most):
                to = min(at + most, b)
                if to - at > 1:
                    yield nodes[at:to], np.frombuffer(b"".join(packed[at:to]), np.int8).reshape(-1, dims[at])
        held[:] = table.slice(keep).to_batches()

    for part in parts:
        if part.num_rows:
            held.append(part)
            if sum(p.num_rows for p in held) >= 8 * most:
                yield from cut(list(held), False)
    if held:
        yield from cut(list(held), True)


def _best(nodes: np.ndarray, q: np.ndarray, told: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row the ``told`` most similar other rows: (node, other, similarity)."""
    f = q.astype(np.float32)
    dots = (f @ f.T).astype(np.float64)  # whole numbers below 2**24, so the same whatever the order
    length = np.sqrt(np.diag(dots))
    similar = dots / np.outer(length, length)
    similar[nodes[:, None] == nodes[None, :]] = -2
    top = np.argpartition(-similar, min(told, len(nodes) - 1) - 1, axis=1)[:, : min(told, len(nodes) - 1)]
    row = np.repeat(np.arange(len(nodes)), top.shape[1])
    value = similar[row, top.ravel()]
    fine = value > -1.5
    return nodes[row[fine]], nodes[top.ravel()[fine]], value[fine]


def _compared(rows: DataFrame, keys: list[str], told: int, most: int) -> DataFrame:
    """(node, other, similarity) from comparing runs of rows with equal keys; rows hold the keys, node and q."""

    def compare(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        for nodes, q in _runs(parts, len(keys), most):
            found.append(_best(nodes, q, told))
            if len(found) >= 256:
                yield packed(found)
                found = []
        if found:
            yield packed(found)

    def packed(found: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(np.concatenate(x)) for x in zip(*found, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=["node", "other", "similarity"])

    order = F.xxhash64("node", F.lit("order"))
    dealt = rows.withColumn("order", order).repartitionByRange(*keys, "order").sortWithinPartitions(*keys, "order")
    return dealt.select(*keys, "node", "q").mapInArrow(compare, "node long, other long, similarity double")


def _shortened(candidates: DataFrame, k: int) -> DataFrame:
    """The ``k`` best different neighbours of each node; most rows go before the shuffle."""
    best = Window.partitionBy("node").orderBy(F.desc("similarity"), "other")
    ranked = candidates.withColumn("rank", F.dense_rank().over(best)).where(F.col("rank") <= k)
    return ranked.groupBy("node", "other").agg(F.max("similarity").alias("similarity"))


def start_lists(cells: DataFrame, descent: Descent) -> DataFrame:
    """Lists from the cells of every table."""
    rows = cells.select("dim", F.posexplode("codes").alias("cut", "code"), "node", "q")
    rows = rows.select("cut", "code", "dim", "node", "q")
    return _shortened(_compared(rows, ["cut", "code", "dim"], descent.told, descent.block), descent.k)


def refined(lists: DataFrame, cells: DataFrame, descent: Descent) -> DataFrame:
    """One round: the neighbours of each node, in both directions, are compared with each other."""
    forward = lists.select(F.col("node").alias("owner"), F.col("other").alias("node"))
    members = forward.unionByName(forward.select(F.col("node").alias("owner"), F.col("owner").alias("node"))).distinct()
    rows = members.join(cells.select("node", "dim", "q"), "node").select("owner", "dim", "node", "q")
    met = _compared(rows, ["owner", "dim"], descent.told, 8 * descent.k)
    return _shortened(lists.unionByName(met), descent.k)


def _vectors(classes: DataFrame) -> DataFrame:
    return classes.select("node", "dim", "v", "copies")


FOUND = "node long, linked long, smallest long"


def _links(blocks: DataFrame, keys: list[str], threshold: float, across: bool) -> DataFrame:
    """What ``exact_links`` returns, from the pairs of each group of ``keys``; ``across``: only those of the two sides."""

    def meet(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, group in whole_groups(parts, len(keys), 1_024):
            nodes, side, copies, dims = (table.column(c).to_numpy() for c in ("node", "side", "copies", "dim"))
            linked, label = np.zeros(len(nodes), np.int64), np.arange(len(nodes))
            bounds = np.append(np.flatnonzero(np.append(True, group[1:] != group[:-1])), len(group))
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                split = a + int((side[a:b] == 0).sum())
                if across and split in (a, b):
                    continue
                u = unit(_stack(table.column("v").slice(a, b - a), dims[a]))
                left, right = (np.arange(a, split), np.arange(split, b)) if split < b else (np.arange(a, b),) * 2
                linked_here = u[left - a] @ u[right - a].T >= threshold
                if split == b:
                    np.fill_diagonal(linked_here, False)
                    linked[left] += linked_here @ copies[left]
                else:
                    linked[left] += linked_here @ copies[right]
                    linked[right] += linked_here.T @ copies[left]
                i, j = np.nonzero(linked_here)
                label[a:b] = a + local_components(b - a, left[i] - a, right[j] - a)
            some = np.flatnonzero(linked)
            columns = [pa.array(x[some]) for x in (nodes, linked, nodes[label])]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "linked", "smallest"])

    rows = blocks.select(*keys, "node", "side", "dim", "copies", "v")
    return rows.repartition(*keys).sortWithinPartitions(*keys, "side", "node").mapInArrow(meet, FOUND)


def links_within(members: DataFrame, descent: Descent) -> DataFrame:
    """Every pair of each component; rows hold component, members (their number), node, dim, v and copies."""
    return _links(in_blocks(members, "node", "members", descent.block), ["component", "low", "high"], descent.threshold, False)


def balls(members: DataFrame) -> DataFrame:
    """(component, dim, members, centre, radius): the mean direction of each component and the widest angle from it."""

    def summed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, group in whole_groups(parts, 1, 1_024):
            first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
            ends = np.append(first[1:], len(group))
            dims = table.column("dim").to_numpy()[first]
            totals = [unit(_stack(table.column("v").slice(a, b - a), d)).sum(0) for a, b, d in zip(first, ends, dims, strict=True)]
            columns = [table.column("component").take(pa.array(first)).combine_chunks(), pa.array(totals, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["component", "total"])

    rows = members.select("component", "dim", "v", "node").repartitionByRange("component", "node").sortWithinPartitions("component")
    totals = rows.mapInArrow(summed, "component long, total array<double>").select("component", F.posexplode("total").alias("at", "x"))
    totals = totals.groupBy("component", "at").agg(F.sum("x").alias("x")).groupBy("component")
    centres = totals.agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "x"))), lambda c: c["x"]).alias("centre"))
    # vectors that cancel each other out have no mean direction: any will do
    centres = stage(centres.withColumn("centre", F.when(F.exists("centre", lambda x: F.abs(x) > 1e-9), F.col("centre")).otherwise(F.transform("centre", lambda x: F.lit(1.0)))))
    angles = _angles(members.join(centres, "component").select("component", "members", "dim", "v", "centre"), ["component", "members"])
    return angles.groupBy("component", "dim", "members").agg(F.max("angle").alias("radius")).join(centres, "component")


def _angles(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` without ``centre``, but with the angle between it and ``v``."""
    kept = [*keys, "dim", "v"]

    def measure(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            lengths = part.column(len(keys)).to_numpy()
            for dim in np.unique(lengths):
                few = part.filter(pa.array(lengths == dim))
                u, w = (unit(_stack(few.column(len(keys) + k), dim)) for k in (1, 2))
                angle = pa.array(np.arccos(np.clip((u * w).sum(1), -1, 1)))
                yield pa.RecordBatch.from_arrays([*few.columns[:-1], angle], names=[*kept, "angle"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*kept).schema)
    return rows.select(*kept, "centre").mapInArrow(measure, f"{schema}, angle double")


def close_balls(found: DataFrame, descent: Descent) -> DataFrame:
    """(one, two): the pairs of components, ``one`` smaller, of which some members could be linked."""
    reach = float(np.arccos(descent.threshold)) + SLACK

    def close(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, group in whole_groups(parts, 3, 1_024):
            names, radius, side = (table.column(c).to_numpy() for c in ("component", "radius", "side"))
            bounds = np.append(np.flatnonzero(np.append(True, group[1:] != group[:-1])), len(group))
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                u = unit(_stack(table.column("centre").slice(a, b - a), int(table.column("dim")[int(a)].as_py())))
                angle = np.arccos(np.clip(u @ u.T, -1, 1))
                near = angle <= radius[a:b, None] + radius[None, a:b] + reach
                split = int((side[a:b] == 0).sum())
                i, j = np.nonzero(near[:split, split:] if split < b - a else np.triu(near, 1))
                one, two = names[a + i], names[a + j + (split if split < b - a else 0)]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(one, two)), pa.array(np.maximum(one, two))], names=["one", "two"])

    counted = found.join(found.groupBy("dim").agg(F.count("*").alias("balls")), "dim")
    met = in_blocks(counted, "component", "balls", descent.block).select("dim", "low", "high", "side", "component", "radius", "centre")
    met = met.repartition("dim", "low", "high").sortWithinPartitions("dim", "low", "high", "side", "component")
    return met.mapInArrow(close, "one long, two long")


def links_across(members: DataFrame, descent: Descent) -> DataFrame:
    """Every link between members of different components.

    Two components meet only if their balls allow a link, and of each only the members
    that the other's ball allows one; by the triangle inequality of angles none is lost.
    """
    found = stage(balls(members))
    close = stage(close_balls(found, descent))
    if close.isEmpty():
        return members.sparkSession.createDataFrame([], FOUND)
    reach = float(np.arccos(descent.threshold)) + SLACK
    sides = []
    for side, (own, other) in enumerate((("one", "two"), ("two", "one"))):
        away = found.select(F.col("component").alias(other), "centre", "radius", F.col("members").alias("others"))
        rows = members.withColumnRenamed("component", own).join(close.join(away, other), own)
        keys = ["one", "two", "node", "copies", "members", "others", "radius"]
        rows = _angles(rows.select(*keys, "dim", "v", "centre"), keys).where(F.col("angle") <= F.col("radius") + reach)
        n, m = (F.ceil(F.col(c) / descent.block).cast("int") for c in ("members", "others"))
        rows = rows.withColumn("own", F.pmod(F.xxhash64("node", F.lit("block")), n).cast("int"))
        rows = rows.withColumn("met", F.explode(F.sequence(F.lit(0), m - 1)))
        low, high = ("own", "met") if side == 0 else ("met", "own")
        sides.append(rows.select("one", "two", F.col(low).alias("low"), F.col(high).alias("high"), F.lit(side).alias("side"), "node", "dim", "copies", "v"))
    return _links(sides[0].unionByName(sides[1]), ["one", "two", "low", "high"], descent.threshold, True)


def exact_links(lists: DataFrame, classes: DataFrame, descent: Descent) -> DataFrame:
    """(node, linked, smallest): copies linked with in a block or by a pair, and a smaller node it hangs together with."""
    near = lists.where(F.col("similarity") >= descent.threshold - descent.margin)
    full = near.groupBy("node").agg(F.count("*").alias("n")).where(F.col("n") >= descent.k).select(F.col("node").alias("full"))
    edges = near.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
    marked = edges.join(full.withColumnRenamed("full", "a").withColumn("a_full", F.lit(True)), "a", "left")
    marked = stage(marked.join(full.withColumnRenamed("full", "b").withColumn("b_full", F.lit(True)), "b", "left"))
    dense = F.coalesce("a_full", "b_full", F.lit(False))
    regions = stage(components(marked.where(dense).select("a", "b")))

    sizes = regions.groupBy("component").agg(F.count("*").alias("members"))
    members = stage(regions.join(sizes, "component").join(_vectors(classes), "node"))
    one, two = (regions.select(F.col("node").alias(c), F.col("component").alias(f"in_{c}")) for c in "ab")
    apart = marked.where(~dense).join(one, "a", "left").join(two, "b", "left")
    apart = apart.where(F.col("in_a").isNull() | F.col("in_b").isNull()).select("a", "b")  # within and across regions all pairs meet
    ends = [_vectors(classes).select(F.col("node").alias(c), F.col("v").alias(f"v_{c}"), F.col("copies").alias(f"n_{c}")) for c in "ab"]
    pairs = apart.join(ends[0], "a").join(ends[1], "b").where(F.size("v_a") == F.size("v_b"))

    def between(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            lengths = _lengths(part.column(2))
            for dim in np.unique(lengths):
                few = part.filter(pa.array(lengths == dim))
                u, w = (unit(_stack(few.column(c), dim)) for c in (2, 3))
                true = (u * w).sum(1) >= descent.threshold
                a, b, m, n = (few.column(c).to_numpy()[true] for c in (0, 1, 4, 5))
                columns = [np.concatenate(x) for x in ((a, b), (n, m), (a, a))]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["node", "linked", "smallest"])

    sparse = pairs.select("a", "b", "v_a", "v_b", "n_a", "n_b").mapInArrow(between, FOUND)
    return links_within(members, descent).unionByName(links_across(members, descent)).unionByName(sparse)


def audit(classes: DataFrame, found: DataFrame, descent: Descent) -> float:
    """Mean share of a query's links that were found, of the worst group of queries; groups by the doublings of their true links."""
    counted = stage(found.groupBy("node").agg(F.sum("linked").alias("linked")))
    few = classes.join(counted.where(F.col("linked") >= descent.k), "node", "left_anti")
    order = F.xxhash64("node", F.lit("audit"))
    drawn = [rows.select("node", "dim", "v").orderBy(order, "node").limit(descent.queries).collect() for rows in (classes, few)]
    drawn = list({r["node"]: r for rows in drawn for r in rows}.values())
    by_dim: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for dim in {r["dim"] for r in drawn}:
        own = [r for r in drawn if r["dim"] == dim]
        by_dim[dim] = np.array([r["node"] for r in own]), unit(np.array([r["v"] for r in own]))

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            lengths = part.column(1).to_numpy()
            for dim in np.unique(lengths):
                if int(dim) in by_dim:
                    nodes, u = by_dim[int(dim)]
                    few = part.filter(pa.array(lengths == dim))
                    near = u @ unit(_stack(few.column(2), dim)).T >= descent.threshold
                    near &= nodes[:, None] != few.column(0).to_numpy()[None, :]
                    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(near @ few.column(3).to_numpy())], names=["node", "true"])

    truth = _vectors(classes).mapInArrow(count, "node long, true long").groupBy("node").agg(F.sum("true").alias("true"))
    both = truth.where(F.col("true") > 0).join(counted, "node", "left")
    share = F.least("true", F.coalesce("linked", F.lit(0))) / F.col("true")
    groups = both.groupBy(F.floor(F.log2("true")).alias("doublings")).agg(F.avg(share).alias("share"))
    worst = groups.agg(F.min("share").alias("worst")).first()["worst"]
    return 1.0 if worst is None else worst


def all_links(classes: DataFrame, descent: Descent) -> DataFrame:
    """What ``exact_links`` returns, from every pair of vectors of equal length."""
    sizes = classes.groupBy("dim").agg(F.count("*").alias("members"))
    members = _vectors(classes).join(F.broadcast(sizes), "dim").withColumn("component", F.col("dim").cast("long"))
    return links_within(members, replace(descent, block=4 * descent.block))


def near_duplicates(vectors: DataFrame, descent: Descent = Descent()) -> DataFrame:
    """(vec_id, n_links, component_id, kept, recall) of every row; ``recall`` is the audit's, 1 if all vectors met."""
    classes = stage(classes_of(vectors))
    size = classes.count()
    bits = max(1, int(np.ceil(np.log2(max(2.0, size / descent.cell)))))
    cells, lists, found, recall = None, None, None, 0.0
    for turn in range(1 + descent.more_rounds):
        planes = _planes(classes, descent.tables, bits, descent.sample, turn)
        cells = stage(coded(classes, planes, descent.tables, bits))
        begun = start_lists(cells, descent)
        lists = stage(begun if lists is None else _shortened(lists.unionByName(begun), descent.k))
        for _ in range(descent.rounds):
            lists = stage(refined(lists, cells, descent))
        found = stage(exact_links(lists, classes, descent))
        recall = audit(classes, found, descent)
        if recall >= descent.recall:
            break
    else:
        found, recall = stage(all_links(classes, descent)), 1.0
    links = found.groupBy("node").agg(F.sum("linked").alias("linked"))
    whole = components(found.select(F.col("node").alias("a"), F.col("smallest").alias("b")))
    named = classes.select("node", "key", "key2", "copies", "first").join(whole, "node", "left").join(links, "node", "left")
    named = stage(named.withColumn("component", F.coalesce("component", "node")))
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    told = named.join(smallest, "component").select("key", "key2", "copies", "linked", "component_id")
    rows = vectors.select("vec_id", _normal("embedding").alias("v")).select("vec_id", *_keys("v"))
    joined = rows.join(told, ["key", "key2"], "left")
    known = F.col("component_id").isNotNull()
    component = F.when(known, F.col("component_id")).otherwise(F.col("vec_id"))
    return joined.select(
        "vec_id",
        F.coalesce(F.col("copies") - 1 + F.coalesce("linked", F.lit(0)), F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
        F.lit(recall).alias("recall"),
    )
