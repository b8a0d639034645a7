import random

import pytest

from stayline.plans import model_search


def scored(spark, n, seed, noise):
    """Out-of-fold rows of three models; the third knows nothing, some scores tie."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        churn = int(rng.random() < 0.3)
        for model, blur in zip("abc", noise):
            score = min(1.0, max(0.0, 0.5 + 0.2 * (2 * churn - 1) * (blur < 1) + rng.gauss(0, blur)))
            rows.append((i, f"u{i}", churn, model, round(score, 3)))
    return spark.createDataFrame(rows, "row_id long, userId string, churn int, model string, score double")


def auc(pairs):
    up, down = ([s for c, s in pairs if c == k] for k in (1, 0))
    return sum((p > q) + (p == q) / 2 for p in up for q in down) / (len(up) * len(down))


def by_row(scores):
    rows = {}
    for r in scores.collect():
        rows.setdefault(r.row_id, {"churn": r.churn})[r.model] = r.score
    return list(rows.values())


@pytest.mark.parametrize("seed,noise", [(1, (0.2, 0.25, 1.0)), (2, (0.4, 0.4, 0.4)), (3, (0.05, 0.5, 1.0))])
def test_bounds_hold_and_the_blend_is_the_one_of_all_blends(spark, seed, noise):
    scores = scored(spark, 150, seed, noise)
    rows = by_row(scores)
    shares = [i * 0.05 for i in range(1, 20)]
    wide = scores.groupBy("row_id", "churn").pivot("model", list("abc")).sum("score")
    mixed = lambda parts: auc([(r["churn"], sum(w * r[m] for m, w in parts.items())) for r in rows])
    for (m, i), (low, high) in model_search.blend_bounds(wide, {"a": 1.0}, ["b", "c"], shares, 16).items():
        exact = mixed({"a": 1 - shares[i], m: shares[i]})
        assert low <= exact + 1e-12 and exact <= high + 1e-12

    single = {m: mixed({m: 1.0}) for m in "abc"}
    best = max("abc", key=lambda m: single[m])
    weights, reached = {best: 1.0}, single[best]
    for _ in range(2):
        options = [
            {**{k: w * (1 - s) for k, w in weights.items()}, m: s} for m in "abc" if m not in weights for s in shares
        ]
        top = max(map(mixed, options))
        if top <= reached:
            break
        weights, reached = next(o for o in options if mixed(o) == top), top
    found = model_search.ensemble_weights(scores, list("abc"))
    assert sum(found.values()) == pytest.approx(1) and mixed(found) == pytest.approx(reached, abs=1e-12)


def test_hopeless_blends_are_ruled_out(spark):
    scores = scored(spark, 400, 5, (0.08, 0.08, 1.0))
    wide = scores.groupBy("row_id", "churn").pivot("model", list("abc")).sum("score")
    shares = [i * 0.05 for i in range(1, 20)]
    bounds = model_search.blend_bounds(wide, {"a": 1.0}, ["b", "c"], shares)
    least = max(low for low, _ in bounds.values())
    ruled_out = [k for k, (_, high) in bounds.items() if high < least]
    assert len(ruled_out) >= 8 and all(m == "c" for m, _ in ruled_out if _ > 9)


def test_scores_of_one_class_or_with_gaps(spark):
    rows = [(0, "u", 1, "a", 0.5), (1, "v", 1, "a", 0.7), (0, "u", 1, "b", 0.5)]
    scores = spark.createDataFrame(rows, "row_id long, userId string, churn int, model string, score double")
    assert model_search.ensemble_weights(scores, ["a", "b"]) == {"a": 1.0}
