"""Minority oversampling: exact nearest neighbours and synthetic rows.

The neighbour search never pairs the whole minority class with itself:

1. Equal points are folded to one *site*; only a site's k+1 smallest keys can be
   anyone's neighbour.
2. Beside its axes a site gets its distance to each of a few *pivots*.  On all these
   coordinates two sites differ by at most their distance, so each can prune.
3. Sites are cut into cells, each along the coordinate on which it spreads most,
   until no cell is over the limit; two sites differ on some axis, so this ends.
4. Each cell finds the nearest candidates among its own sites.
5. A site whose ball of that radius reaches over its cell's edge visits the cells it
   touches, level by level: a cell is left out as soon as the box of its sites, or its
   range of distances to any pivot, lies beyond the ball.  What is nearer there
   replaces the farthest.

Every site within the k-th distance is thus seen, so the result is exact.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stayline.functions import hash_bucket, hash_fraction
from stayline.operators.splitting import SEED, smallest_by_hash
from stayline.staging import stage

NEIGHBORS = 5
CELL_SITES = 2_000
# Most and fewest children of one cut; a cell that is still too large is cut again.  The more
# axes there are, the fewer, so that cells get narrow along several of them and not along one.
FAN_OUT, LEAST_FAN_OUT = 64, 4
#: Sites whose distances serve as further coordinates, and the hash sample they are chosen from.
PIVOTS, PIVOT_SAMPLE = 8, 1_000
# Synthetic rows of one minority row that are made by one task.
COPIES_AT_ONCE = 10_000

# Share of a coordinate that rounding can hide at most.
ROUNDING = 1e-13

CANDIDATES = "array<struct<d2: double, key: bigint, at: array<double>>>"


def _on_axis(axis: str = "axis") -> Column:
    return F.element_at("on", F.col(axis) + 1)


def _pivots(sites: DataFrame) -> list[list[float]]:
    """Far-apart sites of a bounded hash sample: each the one farthest from those before it."""
    import numpy as np

    drawn = sites.select("at").orderBy(F.xxhash64("at"), "at").limit(PIVOT_SAMPLE).collect()
    at = np.array([r["at"] for r in drawn], dtype=float)
    if not len(at):
        return []
    nearest = np.square(at - at.mean(axis=0)).sum(axis=1)
    chosen: list[int] = []
    while len(chosen) < min(PIVOTS, len(at)):
        farthest = int(nearest.argmax())
        d2 = np.square(at - at[farthest]).sum(axis=1)
        nearest = np.minimum(nearest, d2) if chosen else d2
        chosen.append(farthest)
    return at[chosen].tolist()


def _coordinates(axes: int, pivots: list[list[float]]) -> Column:
    """The axes of ``at``, then its distance to each pivot."""
    far = []
    for pivot in pivots:
        steps = [F.col("at")[a] - F.lit(pivot[a]) for a in range(axes)]
        far.append(F.sqrt(reduce(lambda x, y: x + y, [step * step for step in steps])))
    return F.array(*[F.col("at")[a] for a in range(axes)], *far)


def _measured(placed: DataFrame, coordinates: int) -> DataFrame:
    """Cells with their number of sites, and by coordinate the range and spread (-1: all equal)."""
    x = [F.col("on")[c] for c in range(coordinates)]
    spread = [F.when(F.min(c) == F.max(c), F.lit(-1.0)).otherwise(F.nanvl(F.stddev_pop(c), F.lit(0.0))) for c in x]
    return stage(
        placed.groupBy("cell").agg(
            F.count("*").alias("n"),
            F.array(*[F.min(c) for c in x]).alias("lows"),
            F.array(*[F.max(c) for c in x]).alias("highs"),
            F.array(*spread).alias("spread"),
        )
    )


def _fan_out(axes: int) -> int:
    return max(LEAST_FAN_OUT, min(FAN_OUT, round(FAN_OUT ** (2 / axes))))


def _cuts_of(placed: DataFrame, cells: DataFrame, fan_out: int, cell_sites: int) -> DataFrame:
    """(cell, axis, splits) for each cell that is still too large."""
    axis = (F.array_position("spread", F.array_max("spread")) - 1).cast("int")
    large = cells.where(F.col("n") > cell_sites).select("cell", "n", axis.alias("axis"), "lows")
    large = large.select("cell", "n", "axis", _low().alias("low"))
    x = _on_axis()
    steps = [i / fan_out for i in range(1, fan_out)]
    grid = (
        placed.join(large, "cell")
        .groupBy("cell", "axis", "n", "low")
        .agg(
            F.percentile_approx(x, steps, 10 * FAN_OUT).alias("grid"),
            F.min(F.when(x > F.col("low"), x)).alias("above"),
        )
    )
    parts = F.least(F.lit(fan_out), F.ceil(F.col("n") / cell_sites)).cast("int")
    chosen = F.transform(
        F.sequence(F.lit(1), parts - 1),
        lambda i: F.element_at("grid", F.greatest(F.lit(1), F.floor(i * fan_out / parts).cast("int"))),
    )
    # a cell of which most sites share the least value is cut just above it
    splits = F.array_sort(F.array_distinct(F.filter(chosen, lambda s: s > F.col("low"))))
    found = F.when(F.size(splits) > 0, splits).otherwise(F.array("above"))
    return stage(grid.select("cell", "axis", found.alias("splits")))


def _low() -> Column:
    return F.element_at("lows", F.col("axis") + 1)


def _touched(axes: int, coordinates: int, reach: Column) -> Column:
    """Whether the ball around ``on`` reaches the box of a cell and all of its ranges of pivot distances."""
    gaps = []
    for c in range(coordinates):
        x = F.col("on")[c]
        gap = F.greatest(F.col("lows")[c] - x, x - F.col("highs")[c]) - F.abs(x) * ROUNDING
        gaps.append(F.greatest(gap, F.lit(0.0)))
    box = reduce(lambda a, b: a + b, [gap * gap for gap in gaps[:axes]])
    return reduce(lambda a, b: a & b, [gap <= reach for gap in gaps[axes:]], box <= reach * reach)


def _descend(df: DataFrame, cuts: DataFrame, reach: Column) -> DataFrame:
    """Move rows from their cell to every child cell their ball may touch; uncut cells stay."""
    joined = df.join(cuts, "cell", "left")
    x = _on_axis()
    # more than what rounding can hide, and nothing for a row that only looks for its own cell
    wide = F.when(reach > 0, reach + F.abs(x) * ROUNDING).otherwise(F.lit(0.0))
    child = lambda at: F.size(F.filter("splits", lambda s: s <= at))
    children = F.when(F.col("splits").isNotNull(), F.sequence(child(x - wide), child(x + wide)))
    moved = joined.withColumn("_child", F.explode(F.coalesce(children, F.array(F.lit(None).cast("int")))))
    path = F.when(F.col("_child").isNull(), F.col("cell")).otherwise(F.concat_ws(".", "cell", "_child"))
    return moved.withColumn("cell", path).drop("splits", "axis", "_child")


def _nearest(points, limits, at, keys, rows, wanted: int):
    """For each point the ``wanted`` nearest candidates within its limit, by distance then key.

    ``keys`` is sorted and ``rows`` tells whose place in ``at`` a key has.  Returns
    the number found per point, then distances and candidate numbers in order.
    """
    import numpy as np

    counts, distances, numbers = [], [], []
    here = at[rows]
    block = max(1, 4_000_000 // max(1, len(keys)))
    for start in range(0, len(points), block):
        chunk = points[start : start + block]
        d2 = np.zeros((len(chunk), len(keys)))
        for axis in range(at.shape[1]):
            step = chunk[:, axis, None] - here[None, :, axis]
            d2 += step * step
        far = limits[start : start + block]
        if len(keys) > wanted:
            far = np.minimum(far, np.partition(d2, wanted - 1, axis=1)[:, wanted - 1])
        point, number = np.nonzero(d2 <= far[:, None])
        distance = d2[point, number]
        order = np.lexsort((number, distance, point))
        point, number, distance = point[order], number[order], distance[order]
        first = np.searchsorted(point, np.arange(len(chunk)))
        kept = np.arange(len(point)) - first[point] < wanted
        counts.append(np.bincount(point[kept], minlength=len(chunk)))
        distances.append(distance[kept])
        numbers.append(number[kept])
    return np.concatenate(counts), np.concatenate(distances), np.concatenate(numbers)


def _stacked(column):
    """A column of equally long lists as a matrix."""
    import numpy as np

    return np.array(column.to_pylist(), dtype=float)


def _answer(points, limits, sites, wanted: int):
    """The candidates of ``points`` among ``sites`` as an Arrow list column."""
    import numpy as np
    import pyarrow as pa

    at = _stacked(sites.column("at"))
    lists = sites.column("keys").to_pylist()
    keys = np.concatenate([np.asarray(k, dtype="int64") for k in lists])
    rows = np.repeat(np.arange(len(lists)), [len(k) for k in lists])
    order = np.argsort(keys, kind="stable")
    keys, rows = keys[order], rows[order]
    counts, distances, numbers = _nearest(points, limits, at, keys, rows, wanted)
    places = at[rows[numbers]]
    ends = np.arange(0, len(numbers) * at.shape[1] + 1, at.shape[1], dtype="int32")
    found = pa.StructArray.from_arrays(
        [pa.array(distances), pa.array(keys[numbers]), pa.ListArray.from_arrays(ends, pa.array(places.ravel()))],
        names=["d2", "key", "at"],
    )
    return pa.ListArray.from_arrays(np.append(0, np.cumsum(counts)).astype("int32"), found)


def _nothing():
    """No candidates, in the columns of an answer."""
    import pyarrow as pa

    place = pa.list_(pa.float64())
    candidate = pa.struct([("d2", pa.float64()), ("key", pa.int64()), ("at", place)])
    return pa.table({"at": pa.array([], place), "near": pa.array([], pa.list_(candidate))})


def _placed(sites: DataFrame, axes: int, pivots: list[list[float]], cell_sites: int) -> tuple[DataFrame, list]:
    """Sites in cells of at most ``cell_sites``, and each level's cuts with the cells they gave."""
    coordinates = axes + len(pivots)
    placed = stage(sites.withColumns({"on": _coordinates(axes, pivots), "cell": F.lit("0")}))
    levels = []
    cells = _measured(placed, coordinates)
    while not (cuts := _cuts_of(placed, cells, _fan_out(axes), cell_sites)).isEmpty():
        placed = stage(_descend(placed, cuts, F.lit(0.0)))
        cells = _measured(placed, coordinates)
        levels.append((cuts, cells))
    return placed, levels


def _visits(local: DataFrame, axes: int, pivots: list[list[float]], levels: list, wanted: int) -> DataFrame:
    """(cell, at, limit): every other cell that may hold something nearer than what a site has."""
    # The distance to the farthest candidate; without enough of them, no limit.
    limit = F.when(
        F.size("near") >= wanted, F.try_element_at("near", F.lit(wanted))["d2"]
    ).otherwise(F.lit(float("inf")))
    visits = local.select("at", F.col("cell").alias("home"), limit.alias("limit"))
    reach = F.sqrt("limit") * 1.000000001 + 1e-12
    visits = visits.withColumns({"cell": F.lit("0"), "_reach": reach, "on": _coordinates(axes, pivots)})
    for cuts, cells in levels:
        visits = _descend(visits, cuts, F.col("_reach")).join(cells.select("cell", "lows", "highs"), "cell")
        visits = visits.where(_touched(axes, axes + len(pivots), F.col("_reach"))).drop("lows", "highs")
    return visits.where(F.col("cell") != F.col("home")).select("cell", "at", "limit")


def _site_neighbors(sites: DataFrame, axes: int, wanted: int, cell_sites: int) -> DataFrame:
    """The ``wanted`` nearest candidates of each site, by distance then key."""
    pivots = _pivots(sites)
    placed, levels = _placed(sites, axes, pivots, cell_sites)

    def in_cell(group):
        import numpy as np
        import pyarrow as pa

        points = _stacked(group.column("at"))
        near = _answer(points, np.full(len(points), np.inf), group, wanted)
        return pa.table({"at": group.column("at"), "cell": group.column("cell"), "near": near})

    at_home = placed.select("at", "keys", "cell").groupBy("cell")
    local = at_home.applyInArrow(in_cell, f"at array<double>, cell string, near {CANDIDATES}")
    if not levels:
        return local.select("at", "near")
    local = stage(local)
    visits = _visits(local, axes, pivots, levels, wanted)

    # A cell with many visitors is answered by several tasks, each with its sites.
    crowd = visits.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(4 * cell_sites)).alias("tasks"))
    visits = visits.join(crowd, "cell").select(
        "cell", "at", "limit", F.pmod(F.xxhash64("at"), F.col("tasks")).alias("task")
    )
    numbered = crowd.select(  # the alias keeps it apart from the cell of ``visits``
        F.col("cell").alias("cell"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tasks") - 1)).alias("task"),
    )
    hosts = placed.join(numbered, "cell").select("cell", "at", "keys", "task")

    def on_visit(visitors, group):
        import pyarrow as pa

        if visitors.num_rows == 0 or group.num_rows == 0:
            return _nothing()
        limits = visitors.column("limit").to_numpy()
        near = _answer(_stacked(visitors.column("at")), limits, group, wanted)
        return pa.table({"at": visitors.column("at"), "near": near})

    foreign = (
        visits.groupBy("cell", "task")
        .cogroup(hosts.groupBy("cell", "task"))
        .applyInArrow(on_visit, f"at array<double>, near {CANDIDATES}")
    )
    each = (
        local.select("at", "near")
        .unionByName(foreign)
        .select("at", F.explode("near").alias("c"))
    )
    order = W.partitionBy("at").orderBy("c.d2", "c.key")
    return (
        each.withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") <= wanted)
        .groupBy("at")
        .agg(F.array_sort(F.collect_list("c")).alias("near"))
    )


def _neighbor_lists(
    df: DataFrame, features: Sequence[str], label: str, key: str, k: int, minority: int, cell_sites: int
) -> DataFrame:
    """(key, at, others): the k nearest minority rows of each minority row, in order."""
    refuse = F.raise_error(F.lit("a feature is null")).cast("double")
    at = F.array(*[F.coalesce(F.col(f).cast("double"), refuse) for f in features])
    points = stage(
        df.where(F.col(label) == minority).select(F.col(key).cast("bigint").alias("key"), at.alias("at"))
    )
    first = W.partitionBy("at").orderBy("key")
    sites = stage(
        points.withColumn("_n", F.row_number().over(first))
        .where(F.col("_n") <= k + 1)
        .groupBy("at")
        .agg(F.sort_array(F.collect_list("key")).alias("keys"))
    )
    near = _site_neighbors(sites, len(features), k + 1, cell_sites)
    others = F.slice(F.filter("near", lambda c: c["key"] != F.col("key")), 1, k)
    return points.join(near, "at").select("key", "at", others.alias("others"))


def smote_neighbors(
    df: DataFrame,
    features: Sequence[str],
    label: str = "churn",
    key: str = "userId",
    k: int = NEIGHBORS,
    minority: int = 1,
    cell_sites: int = CELL_SITES,
) -> DataFrame:
    """The k nearest minority rows of each minority row, itself excluded.

    Euclidean distance on the features as they are, not scaled; equal distances
    go to the smaller key.  A null feature is an error, not a dropped row.
    Columns: key, rank, neighbor, distance2, at, neighbor_at.
    """
    listed = _neighbor_lists(df, features, label, key, k, minority, cell_sites)
    return listed.select("key", "at", F.posexplode("others").alias("_pos", "c")).select(
        F.col("key").alias(key),
        (F.col("_pos") + 1).cast("int").alias("rank"),
        F.col("c.key").alias("neighbor"),
        F.col("c.d2").alias("distance2"),
        "at",
        F.col("c.at").alias("neighbor_at"),
    )


def smote_resample(
    df: DataFrame,
    features: Sequence[str],
    label: str = "churn",
    key: str = "userId",
    k: int = NEIGHBORS,
    seed: int = SEED,
    cell_sites: int = CELL_SITES,
) -> DataFrame:
    """All rows, and synthetic rows of the smaller class (0 or 1) until both are equal.

    Each synthetic row lies between a minority row and one of its neighbours, both
    drawn by hash.  Draws are spread evenly: every minority row serves
    floor(missing / minority) times, and hash-chosen ones once more.  Neighbours
    join a row before it is multiplied, and its copies are made in blocks.
    Whole-number features stay whole, rounded towards zero.  ``copy`` is 0 on
    original rows.
    """
    df = stage(df.select(key, *features, label))
    counted = {r[label]: r["count"] for r in df.where(F.col(label).isin(0, 1)).groupBy(label).count().collect()}
    original = df.select(key, F.lit(0).alias("copy"), *features, label)
    sizes = {flag: counted.get(flag, 0) for flag in (0, 1)}
    minority = 1 if sizes[1] <= sizes[0] else 0
    rows, missing = sizes[minority], sizes[1 - minority] - sizes[minority]
    if not missing or not rows:
        return original
    if rows == 1:
        raise ValueError("one minority row has no neighbour to interpolate with")
    own = df.where(F.col(label) == minority).select(F.col(key).cast("bigint").alias("key"), label)
    served = smallest_by_hash(own, "key", F.lit(missing % rows), label, seed)
    served = served.select("key", (F.lit(missing // rows) + F.col("_chosen").cast("int")).alias("copies"))
    lists = _neighbor_lists(df, features, label, key, k, minority, cell_sites).join(served, "key")
    blocks = F.sequence(F.lit(0), F.ceil(F.col("copies") / COPIES_AT_ONCE).cast("int") - 1)
    spread = lists.where("copies > 0").withColumn("_block", F.explode(blocks)).repartition("key", "_block")
    start = F.col("_block") * COPIES_AT_ONCE
    copies = F.sequence(start + 1, F.least(start + COPIES_AT_ONCE, F.col("copies")))
    draws = spread.withColumn("copy", F.explode(copies)).withColumn("copy", F.col("copy").cast("int"))
    draws = draws.withColumn("_draw", F.concat_ws("-", "key", "copy")).withColumns(
        {
            "_rank": (hash_bucket("_draw", f"-near-{seed}", min(k, rows - 1)) + 1).cast("int"),
            "_gap": hash_fraction("_draw", f"-gap-{seed}"),
        }
    )
    to = F.element_at("others", F.col("_rank"))["at"]
    values = []
    for i, f in enumerate(features):
        value = F.col("at")[i] + F.col("_gap") * (to[i] - F.col("at")[i])
        values.append(value.cast(df.schema[f].dataType).alias(f))
    synthetic = draws.select(
        F.col("key").alias(key), "copy", *values, F.lit(minority).cast(df.schema[label].dataType).alias(label)
    )
    return original.unionByName(synthetic)
