import math
import random
from datetime import date, timedelta

import numpy as np
import pytest
from logs import rows_of
from pyspark.sql import functions as F

from stayline.operators import encoding, quantiles, shift, significance, summaries
from stayline.sources.tables import write_bucketed


def history(spark, shares, users=200, seed=1):
    rng = random.Random(seed)
    rows = [(u, date(2024, 1, 1) + timedelta(days=d), 0.9 if rng.random() < s else 0.1) for d, s in enumerate(shares) for u in range(users)]
    return spark.createDataFrame(rows, "userId long, day date, score double")


def cusum(moves, slack):
    out, held = [], 0.0
    for m in moves:
        held = max(0.0, held + m - slack)
        out.append(held)
    return out


def test_sums_equal_the_recursion_and_a_jump_is_an_alert(spark):
    found = sorted(shift.shift_alerts(history(spark, [0.05] * 12 + [0.2] * 3)).collect())
    base = sum(r.flagged for r in found[:7]) / sum(r.scored for r in found[:7])
    moves = [(r.flagged_share - base) / math.sqrt(base * (1 - base) / r.scored) for r in found[7:]]
    assert [r.raised for r in found[7:]] == pytest.approx(cusum(moves, shift.SLACK))
    assert [r.lowered for r in found[7:]] == pytest.approx(cusum([-m for m in moves], shift.SLACK))
    assert {r.alert for r in found[:12]} == {None} and found[12].alert == "up"


def test_a_fall_and_a_flat_history(spark):
    found = sorted(shift.shift_alerts(history(spark, [0.5] * 8 + [0.2] * 2)).collect())
    assert found[-1].alert == "down"
    flat = shift.shift_alerts(history(spark, [0.0] * 9), baseline_days=3)
    assert {(r.baseline_share, r.alert) for r in flat.collect()} == {(0.0, None)}
    assert shift.shift_alerts(history(spark, [])).collect() == []


def test_stability_index(spark):
    table = history(spark, [0.1] * 5 + [0.6])
    daily = shift.score_histogram(table, ["day"])
    found = sorted(shift.stability_index(daily, daily.where("day < '2024-01-04'")).collect())
    scores = [r.score for r in table.where("day < '2024-01-04'").collect()]
    q = (np.bincount([min(int(s * 10), 9) for s in scores], minlength=10) + 0.5) / (len(scores) + 5)
    for r in found:
        own = [x.score for x in table.where(F.col("day") == F.lit(r.day)).collect()]
        p = (np.bincount([min(int(s * 10), 9) for s in own], minlength=10) + 0.5) / (len(own) + 5)
        assert r.psi == pytest.approx(float(((p - q) * np.log(p / q)).sum()))
    assert [r.shifted for r in found] == [False] * 5 + [True]


def scored(spark, gain, n=300):
    rng = random.Random(5)
    rows = []
    for u in range(n):
        churn = int(rng.random() < 0.3)
        rows.append((u, churn, min(max(0.35 + 0.2 * churn + rng.gauss(0, 0.2), 0.0), 1.0), min(max(0.35 + (0.2 + gain) * churn + rng.gauss(0, 0.2), 0.0), 1.0)))
    return spark.createDataFrame(rows, "userId long, churn int, current double, candidate double")


def test_weights_are_poisson(spark):
    counts = spark.range(20_000).withColumn("b", F.lit(3)).select(significance.poisson_weight("id", "b").alias("w")).groupBy("w").count()
    for r in counts.collect():
        assert r["count"] == pytest.approx(20_000 * math.exp(-1) / math.factorial(r.w), rel=0.2, abs=12)


@pytest.mark.parametrize("metric", ["f1", "roc_auc"])
def test_bootstrap_equals_brute_force(spark, metric):
    table = scored(spark, 0.1, 120)
    found = significance.paired_bootstrap(table, metric=metric, replicates=15, level=0.8).first()
    drawn = table.crossJoin(spark.range(15).withColumnRenamed("id", "b")).withColumn("w", significance.poisson_weight("userId", "b")).collect()

    def value(rows, name):
        if metric == "f1":
            tp = sum(w for c, s, w in rows if s > 0.5 and c)
            fp = sum(w for c, s, w in rows if s > 0.5 and not c)
            fn = sum(w for c, s, w in rows if s <= 0.5 and c)
            return 2 * tp / (2 * tp + fp + fn)
        won = total = 0
        for c, s, w in rows:
            for d, t, v in rows:
                if c and not d:
                    won += w * v * ((s > t) + 0.5 * (s == t))
                    total += w * v
        return won / total

    differences = []
    for b in range(15):
        own = [r for r in drawn if r.b == b]
        differences.append(value([(r.churn, r.candidate, r.w) for r in own], "c") - value([(r.churn, r.current, r.w) for r in own], "o"))
    differences.sort()
    assert (found.low, found.high) == pytest.approx((differences[1], differences[-2]))
    assert found.share_better == pytest.approx(sum(d > 0 for d in differences) / 15)
    plain = [(r.churn, r.current, 1) for r in table.collect()]
    assert found.current_value == pytest.approx(value(plain, "o"))


def test_the_gate_asks_for_both(spark):
    good = significance.significant_gate(significance.paired_bootstrap(scored(spark, 0.4))).first()
    assert good.promote and good.low > 0
    same = scored(spark, 0.0).withColumn("candidate", F.col("current"))
    row = significance.significant_gate(significance.paired_bootstrap(same, replicates=20)).first()
    assert not row.promote and row.low == row.high == 0
    empty = significance.significant_gate(significance.paired_bootstrap(same.limit(0), replicates=5)).first()
    assert not empty.promote
    with pytest.raises(ValueError):
        significance.paired_bootstrap(same, metric="gain")


def test_merged_sketches_are_exact_while_small_and_bounded_beyond(spark):
    rows = spark.range(60_000).select((F.col("id") % 7).alias("day"), (F.col("id") % 2).alias("cohort"), F.pmod(F.hash("id"), F.lit(10_007)).cast("double").alias("v"))
    shares = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    values = {c: sorted(r.v for r in rows.where(F.col("cohort") == c).collect()) for c in (0, 1)}
    for k in (200, 1_000):
        merged = quantiles.merged_sketches(quantiles.quantile_sketches(rows, "v", ["day", "cohort"], k), ["cohort"], k)
        for r in quantiles.quantiles_of(merged, shares).collect():
            own = values[r.cohort]
            assert r.n == len(own)
            for name, share in shares.items():
                low, high = np.searchsorted(own, r[name], "left") / len(own), np.searchsorted(own, r[name], "right") / len(own)
                assert max(low - share, share - high, 0) < 3 * 2.3 / k
    few = rows.where("v < 20")
    n = few.groupBy("cohort").agg(F.sort_array(F.collect_list("v")).alias("s")).collect()
    got = {r.cohort: r for r in quantiles.quantiles_of(quantiles.quantile_sketches(few, "v", ["cohort"]), shares).collect()}
    assert all(got[r.cohort].median == r.s[math.ceil(0.5 * len(r.s)) - 1] for r in n)
    nothing = spark.createDataFrame([(1, None), (1, float("nan"))], "cohort int, v double")
    assert quantiles.quantile_sketches(nothing, "v", ["cohort"]).collect() == []


def test_scatter_sample(spark):
    users = spark.range(900).select(F.col("id").alias("userId"), (F.col("id") % 3 == 0).cast("int").alias("churn"), F.col("id").alias("x"))
    small, large = summaries.scatter_sample(users, 50), summaries.scatter_sample(users, 400)
    assert sorted((r.churn, r["count"]) for r in small.groupBy("churn").count().collect()) == [(0, 50), (1, 50)]
    assert sorted((r.churn, r["count"]) for r in large.groupBy("churn").count().collect()) == [(0, 400), (1, 300)]
    assert small.columns == users.columns and set(rows_of(small)) <= set(rows_of(large))


def test_levels_are_limited_before_they_are_collected(spark):
    table = spark.range(50).select(F.col("id").cast("string").alias("many"), (F.col("id") % 2).cast("string").alias("two"), F.lit(None).cast("string").alias("none"))
    assert encoding.level_counts(table, ["many", "two", "none"]) == {"many": 50, "two": 2, "none": 0}
    assert encoding.fit_levels(table, ["two", "none"], 2) == {"two": ["0", "1"], "none": []}
    assert len(encoding.fit_levels(table, ["many"], 50)["many"]) == 50
    with pytest.raises(encoding.TooManyLevels, match="many.*sparse_one_hot"):
        encoding.fit_levels(table, ["many", "two"], 49)


def test_bucketed_tables_join_without_moving_rows(spark, tmp_path):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("scores", "labels"):
            rows = spark.range(2_000).select(F.col("id").alias("userId"), (F.col("id") % 5).alias(name))
            write_bucketed(rows, f"bucketed_{name}", str(tmp_path / name), buckets=8)
        joined = spark.table("bucketed_scores").join(spark.table("bucketed_labels"), "userId").groupBy("userId").agg(F.max("scores").alias("s"))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == 2_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for name in ("scores", "labels"):
            spark.sql(f"DROP TABLE IF EXISTS bucketed_{name}")
