import numpy as np
import pytest

from stayline.llm import knn_graph as kg

SCHEMA = "vec_id long, embedding array<float>, node int, v string"


def corpus():
    rng = np.random.default_rng(7)
    vectors = [rng.normal(size=32) for _ in range(500)]
    for size, noise in ((2, 0.03), (2, 0.05), (5, 0.06), (30, 0.05), (150, 0.04), (40, 0.075)):
        centre = rng.normal(size=32)
        vectors += [centre + noise * np.linalg.norm(centre) / 5.6 * 4 * rng.normal(size=32) for _ in range(size)]
    vectors += [vectors[3] * 2.5, vectors[3], vectors[3], -vectors[4], vectors[5] * 1e30]
    rows = [(k, [float(x) for x in v]) for k, v in enumerate(vectors)]
    odd = [None, [], [0.0] * 32, [float("nan")] + [1.0] * 31, [float("inf")] + [1.0] * 31, [None] + [1.0] * 31, [-0.0] * 32]
    rows += [(2000 + k, v) for k, v in enumerate(odd)]
    rows += [(3000, [1.0, 0.0]), (3001, [1.0, 0.1]), (3002, [-0.0, 1.0]), (3003, [0.0, 1.0]), (None, rows[9][1]), (17, rows[17][1])]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)


def brute(rows):
    unit = {}
    for k, (_, v) in enumerate(rows):
        x = np.array([np.nan if c is None else np.float32(c) for c in v or []], float)
        if len(x) and np.isfinite(x).all() and x.any():
            x = x / np.abs(x).max()
            unit[k] = x / np.linalg.norm(x)
    links, parent = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(unit)
    for n, j in enumerate(keys):
        for i in keys[:n]:
            if len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.9:
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    names = {}
    for k, (key, _) in enumerate(rows):
        if key is not None:
            names[find(k)] = min(names.get(find(k), key), key)
    return sorted((-1 if key is None else key, links[k], names.get(find(k), -1)) for k, (key, _) in enumerate(rows))


def told(got):
    return sorted((-1 if r.vec_id is None else r.vec_id, r.n_links, -1 if r.component_id is None else r.component_id) for r in got)


@pytest.mark.parametrize("descent", [kg.Descent(), kg.Descent(k=4, block=16, cell=40)])
def test_links_and_components_equal_brute_force(spark, descent):
    rows = corpus()
    got = kg.near_duplicates(frame(spark, rows), descent).collect()
    assert told(got) == brute(rows)
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)
    assert got[0].recall >= 0.98


def clumps():
    """Two clumps of 30, about 0.98 inside and 0.93 across, and a third that only touches the second."""
    rng = np.random.default_rng(11)
    axes = np.linalg.qr(rng.normal(size=(32, 32)))[0]
    apart = np.arccos(0.949)
    rows = []
    for n in range(3):
        for _ in range(30):
            noise = rng.normal(size=32)
            rows.append(np.cos(n * apart) * axes[0] + np.sin(n * apart) * axes[1] + 0.143 * noise / np.linalg.norm(noise))
    rows += [rng.normal(size=32) for _ in range(100)]
    return [(k, [float(x) for x in v]) for k, v in enumerate(rows)]


@pytest.mark.parametrize("block", [512, 16])
def test_clumps_that_fill_each_others_lists_are_linked(spark, block):
    rows = clumps()
    got = kg.near_duplicates(frame(spark, rows), kg.Descent(block=block)).collect()
    assert told(got) == brute(rows)
    assert max(links for _, links, _ in brute(rows)) >= 59


def test_audit_sees_missing_links(spark):
    rows = corpus()
    classes = kg.stage(kg.classes_of(frame(spark, rows)))
    none = spark.createDataFrame([], "node long, linked long")
    assert kg.audit(classes, none, kg.Descent(queries=10_000)) == 0
    assert kg.audit(classes.limit(0), none, kg.Descent()) == 1


def test_audit_sees_small_groups_beside_a_large_one(spark):
    rng = np.random.default_rng(5)
    centres = [rng.normal(size=32)] * 80 + [x for x in rng.normal(size=(10, 32)) for _ in range(2)]
    rows = [(k, [float(x) for x in centre + 0.05 * rng.normal(size=32)]) for k, centre in enumerate(centres)]
    classes = kg.stage(kg.classes_of(frame(spark, rows)))
    everything = kg.all_links(classes, kg.Descent(block=8)).groupBy("node").sum("linked").toDF("node", "linked")
    assert kg.audit(classes, everything, kg.Descent()) == 1
    assert kg.audit(classes, everything.where("linked > 1"), kg.Descent()) == 0


def test_all_vectors_meet_where_the_turns_do_not_suffice(spark):
    rows = corpus()
    descent = kg.Descent(k=1, tables=1, cell=2, rounds=0, more_rounds=0, told=1)
    got = kg.near_duplicates(frame(spark, rows), descent).collect()
    assert told(got) == brute(rows)
    assert got[0].recall == 1


def test_empty_and_unusable_tables(spark):
    assert kg.near_duplicates(frame(spark, [])).count() == 0
    got = kg.near_duplicates(frame(spark, [(1, None), (2, [0.0])])).collect()
    assert told(got) == [(1, 0, 1), (2, 0, 2)]
