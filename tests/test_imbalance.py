import random

import pytest
from pyspark.sql import functions as F

from stayline.operators import imbalance


def points(spark, n=120, axes=2, spread=30, copies=0.0, seed=4):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        at = [0.0] * axes if rng.random() < copies else [float(rng.randrange(spread)) for _ in range(axes)]
        rows.append((i, int(i % 3 == 0 or rng.random() < 0.3), *at))
    names = [f"x{a}" for a in range(axes)]
    schema = "userId long, churn int, " + ", ".join(f"{x} double" for x in names)
    return spark.createDataFrame(rows, schema), names


def brute(rows, names, k):
    minority = [r for r in rows if r.churn == 1]
    found = {}
    for a in minority:
        d = sorted(
            (sum((a[x] - b[x]) ** 2 for x in names), b.userId) for b in minority if b.userId != a.userId
        )
        found[a.userId] = d[:k]
    return found


@pytest.mark.parametrize(
    "n,axes,spread,copies,cell",
    [
        (120, 2, 30, 0.0, 2_000),
        (400, 2, 200, 0.0, 8),
        (400, 2, 12, 0.4, 5),
        (300, 3, 40, 0.0, 6),
        (200, 1, 400, 0.0, 7),
        (250, 8, 10, 0.0, 20),
        (60, 2, 3, 0.6, 2),
    ],
)
def test_neighbors_match_brute_force(spark, n, axes, spread, copies, cell):
    df, names = points(spark, n, axes, spread, copies)
    near = imbalance.smote_neighbors(df, names, cell_sites=cell)
    found = {}
    for r in near.orderBy("userId", "rank").collect():
        found.setdefault(r.userId, []).append((r.distance2, r.neighbor))
    assert found == brute(df.collect(), names, 5)


def test_neighbors_of_heavy_copies(spark):
    df, names = points(spark, 300, 2, 20, 0.6)
    near = imbalance.smote_neighbors(df, names, cell_sites=4)
    found = {}
    for r in near.orderBy("userId", "rank").collect():
        found.setdefault(r.userId, []).append((r.distance2, r.neighbor))
    assert found == brute(df.collect(), names, 5)


def test_few_minority_rows_use_all_others(spark):
    df, names = points(spark, 6, 2)
    df = df.withColumn("churn", (F.col("userId") < 3).cast("int"))
    assert imbalance.smote_neighbors(df, names).count() == 3 * 2


def test_resampled_classes_are_equal_and_rows_lie_between_parents(spark):
    df, names = points(spark, 200, 2, 50)
    df = df.withColumn("churn", (F.col("userId") % 7 == 0).cast("int"))
    out = imbalance.smote_resample(df, names, cell_sites=6)
    sizes = {r.churn: r.n for r in out.groupBy("churn").agg(F.count("*").alias("n")).collect()}
    assert sizes[0] == sizes[1]
    assert out.where("copy = 0").count() == 200
    near = brute(df.collect(), names, 5)
    at = {r.userId: [r[x] for x in names] for r in df.collect()}
    for r in out.where("copy > 0").collect():
        a = at[r.userId]
        ok = False
        for _, neighbor in near[r.userId]:
            b = at[neighbor]
            inside = all(min(a[i], b[i]) - 1e-9 <= r[names[i]] <= max(a[i], b[i]) + 1e-9 for i in (0, 1))
            cross = (b[0] - a[0]) * (r[names[1]] - a[1]) - (b[1] - a[1]) * (r[names[0]] - a[0])
            ok = ok or (inside and abs(cross) < 1e-6)
        assert ok
    again = imbalance.smote_resample(df.repartition(5), names, cell_sites=6)
    assert out.exceptAll(again).count() == 0


@pytest.mark.parametrize("smaller", [0, 1])
def test_whichever_class_is_smaller_grows(spark, smaller):
    df, names = points(spark, 100, 2)
    df = df.withColumn("churn", F.when(F.col("userId") < 10, smaller).otherwise(1 - smaller).cast("int"))
    out = imbalance.smote_resample(df, names)
    assert {r.churn: r["count"] for r in out.groupBy("churn").count().collect()} == {0: 90, 1: 90}
    assert {r.churn for r in out.where("copy > 0").collect()} == {smaller}


def test_two_rows_against_very_many(spark):
    df = spark.range(300_000).selectExpr("id userId", "cast(id < 2 as int) churn", "cast(id as double) x")
    out = imbalance.smote_resample(df, ["x"])
    sizes = out.where("churn = 1").agg(F.count("*").alias("n"), F.max("copy").alias("most"), F.min("x"), F.max("x")).first()
    assert sizes.n == 299_998 and sizes.most <= 149_999 and 0 <= sizes[2] <= sizes[3] <= 1


def test_flags_before_real_features(spark):
    df = spark.range(400).selectExpr(
        "id userId", "1 churn", "0.0D f0", "1.0D f1", "cast(id % 2 as double) f2", "0.0D f3", "0.0D f4", "1.0D f5",
        "cast(id * 37 % 101 as double) x", "cast(id * 53 % 211 as double) y",
    )
    names = ["f0", "f1", "f2", "f3", "f4", "f5", "x", "y"]
    found = {}
    for r in imbalance.smote_neighbors(df, names, cell_sites=20).orderBy("userId", "rank").collect():
        found.setdefault(r.userId, []).append((r.distance2, r.neighbor))
    assert found == brute(df.collect(), names, 5)


def test_balanced_input_is_unchanged(spark):
    df, names = points(spark, 20, 2)
    df = df.withColumn("churn", (F.col("userId") < 10).cast("int"))
    assert imbalance.smote_resample(df, names).count() == 20


def test_single_minority_row_is_refused(spark):
    df, names = points(spark, 20, 2)
    with pytest.raises(ValueError):
        imbalance.smote_resample(df.withColumn("churn", (F.col("userId") == 3).cast("int")), names)


def test_null_features_are_refused(spark):
    df, names = points(spark, 20, 2)
    with pytest.raises(Exception, match="a feature is null"):
        imbalance.smote_neighbors(df.withColumn("x0", F.lit(None).cast("double")), names).collect()


def groups_of_twelve_axes(spark, n=1_200, groups=12, seed=8):
    """Points of twelve real axes around a few centres, with some copies."""
    rng = random.Random(seed)
    names = [f"x{a}" for a in range(12)]
    centres = [[rng.gauss(0, 30) for _ in names] for _ in range(groups)]
    rows = []
    for i in range(n):
        centre = rng.choice(centres)
        at = rows[-1][2:] if i and rng.random() < 0.1 else [x + rng.gauss(0, 1) for x in centre]
        rows.append((i, int(rng.random() < 0.8), *at))
    return spark.createDataFrame(rows, "userId long, churn int, " + ", ".join(f"{x} double" for x in names)), names


def test_neighbors_on_twelve_real_axes_match_brute_force(spark):
    df, names = groups_of_twelve_axes(spark)
    found = {}
    for r in imbalance.smote_neighbors(df, names, cell_sites=40).orderBy("userId", "rank").collect():
        found.setdefault(r.userId, []).append(r.neighbor)
    at = {r.userId: [r[x] for x in names] for r in df.where("churn = 1").collect()}
    for key, own in at.items():
        order = sorted((sum((x - y) * (x - y) for x, y in zip(own, b)), k) for k, b in at.items() if k != key)
        assert found[key] == [k for _, k in order[:5]]


def test_sites_visit_few_cells_where_points_form_groups(spark):
    df, names = groups_of_twelve_axes(spark)
    sites = df.groupBy(F.array(*names).alias("at")).agg(F.collect_list("userId").alias("keys"))
    pivots = imbalance._pivots(sites)
    assert len(pivots) == imbalance.PIVOTS
    placed, levels = imbalance._placed(sites, 12, pivots, 40)
    sizes = [r["n"] for r in placed.groupBy("cell").agg(F.count("*").alias("n")).collect()]
    assert max(sizes) <= 40 and sum(sizes) == sites.count()
    # every site within a group's width of six others: the ball that a site's own cell usually gives
    local = placed.select("at", "cell", F.array_repeat(F.struct(F.lit(36.0).alias("d2")), 6).alias("near"))
    visits = imbalance._visits(local, 12, pivots, levels, 6).groupBy("at").count()
    assert visits.agg(F.avg("count")).first()[0] < len(sizes) / 4


def test_a_cell_of_mostly_equal_values_is_still_cut(spark):
    rows = [(i, 1, 0.0 if i % 50 else 10.0 ** (i % 100), float(i)) for i in range(300)]
    df = spark.createDataFrame(rows, "userId long, churn int, x0 double, x1 double")
    found = {}
    for r in imbalance.smote_neighbors(df, ["x0", "x1"], cell_sites=7).collect():
        found.setdefault(r.userId, []).append((r.distance2, r.neighbor))
    want = brute(df.collect(), ["x0", "x1"], 5)
    assert {k: [n for _, n in sorted(v)] for k, v in found.items()} == {k: [n for _, n in v] for k, v in want.items()}
