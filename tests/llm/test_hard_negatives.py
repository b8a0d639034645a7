import random
from math import floor

import pytest
from pyspark.sql import functions as F

from stayline.llm import hard_negatives as hn

SCHEMA = "vec_id long, label int, embedding array<float>, `key` string, windows string, `row` string"


def table(spark, rows):
    return spark.createDataFrame([(*row, "x", "y", "z") for row in rows], SCHEMA)


def brute(rows, mining=hn.Mining(), every=100):
    by_id = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or x != x or abs(x) == float("inf") for x in v):
            continue
        row = (label, [floor(mining.scale * x) for x in v])
        by_id[i] = min(by_id.get(i, row), row)
    out = []
    for anchor, (label, v) in by_id.items():
        if anchor % every:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), i, own) for i, (own, w) in by_id.items() if i != anchor and len(w) == len(v)]
        scored.sort()
        for ps, positive, _ in [s for s in scored if s[2] == label][: mining.positives]:
            near = [s for s in scored if s[2] != label and mining.low * -ps <= 100 * -s[0] <= mining.high * -ps]
            out += [(anchor, positive, k + 1, s[1], -ps, -s[0]) for k, s in enumerate(near[: mining.negatives])]
    return sorted(out)


def found(frame):
    assert frame.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in frame.collect())


def rows_of(seed, n=700, few=False):
    rng = random.Random(seed)
    value = (lambda: rng.choice((0.0, 0.5, 1.0))) if few else (lambda: rng.gauss(0.4, 1))
    return [(i, rng.choice((0, 0, 0, 1, 2, 3)), [value() for _ in range(6)]) for i in range(n)]


@pytest.mark.parametrize("few", [False, True], ids=["spread", "ties"])
@pytest.mark.parametrize("blocks", [(256, 4096), (3, 50)])
def test_equals_brute_force(spark, few, blocks):
    rows = rows_of(3, few=few)
    mining = hn.Mining(anchors_at_once=blocks[0], rows_at_once=blocks[1])
    assert found(hn.mine(table(spark, rows), F.col("vec_id") % 100 == 0, mining)) == brute(rows)


def test_zero_and_negative_positives(spark):
    rows = [(0, 1, [1.0, 0.0]), (5, 1, [0.0, 1.0]), (6, 1, [-1.0, 0.0])]
    rows += [(1, 2, [0.0, 3.0]), (2, 2, [0.0, 1.0]), (3, 2, [-0.5, 0.0]), (9, 2, [0.0, 9.0])]
    got = found(hn.mine(table(spark, rows), F.col("vec_id") % 100 == 0))
    # negatives 1 and 2 tie with positive 5 at score 0 and have smaller ids
    assert got == brute(rows) and [r[3] for r in got] == [1, 2, 9]


def test_rows_that_take_no_part_and_repeated_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = rows_of(4, 210)
    rows += rows[:40] + [(200, 9, [0.0] * 6), (None, 0, [1.0] * 6), (300, None, [1.0] * 6), (400, 0, None)]
    rows += [(500, 0, [nan] + [1.0] * 5), (501, 1, [inf] * 6), (502, 1, [None] * 6), (503, 0, [1.0] * 3), (600, 2, []), (601, 2, []), (602, 3, [])]
    assert found(hn.mine(table(spark, rows), F.col("vec_id") % 100 == 0)) == brute(rows)


def test_scores_beyond_doubles_are_exact(spark):
    rng = random.Random(8)
    rows = [(i, i % 2, [float(rng.randrange(1 << 19)) * 8 for _ in range(3)]) for i in range(60)]
    assert found(hn.mine(table(spark, rows), F.col("vec_id") % 10 == 0)) == brute(rows, every=10)
    assert max(r[4] for r in brute(rows, every=10)) > 1 << 53


def test_empty_table(spark):
    assert found(hn.mine(table(spark, []), F.col("vec_id") % 100 == 0)) == []
    assert found(hn.mine(table(spark, [(100, 1, [1.0])]), F.col("vec_id") % 100 == 0)) == []


def test_keys_sort_like_their_parts():
    rng = random.Random(1)
    parts = [(rng.randrange(-9, 9), rng.randrange(-(1 << 60), 1 << 60), rng.randrange(2), rng.randrange(-5, 5)) for _ in range(300)]
    import numpy as np

    keys = [hn.packed(np.array([a]), np.array([s]), bool(n), np.array([i]))[0].as_py() for a, s, n, i in parts]
    assert [hn.unpacked(k) for k in keys] == parts
    assert [hn.unpacked(k) for k in sorted(keys)] == sorted(parts, key=lambda p: (p[0], -p[1], p[2], p[3]))


def test_windows_are_streamed():
    import numpy as np

    def endless():
        yield hn.packed(np.array([7]), np.array([100]), False, np.array([1]))[0].as_py()
        for k in range(1 << 40):
            yield hn.packed(np.array([7]), np.array([80]), True, np.array([k]))[0].as_py()

    stream = hn.through_windows(endless(), hn.Mining())
    assert [next(stream) for _ in range(10)] == [(7, 1, k + 1, k, 100, 80) for k in range(10)]
