import random

import numpy as np
import pyarrow as pa

from stayline.llm import blocks
from stayline.llm.graphs import components


def brute(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def test_components_of_random_chain_and_hub_graphs(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)]
    edges += [(1000 + k, 1001 + k) for k in range(64)] + [(5000, 5001 + k) for k in range(300)]
    edges += [(7, 7)] + edges[:20]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    want = brute([e for e in edges if e[0] != e[1]])
    assert {r.node: r.component for r in got} == want and len(got) == len(want)


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
    assert components(spark.createDataFrame([(3, 3)], "a long, b long")).collect() == []


def test_every_pair_of_a_group_meets_in_exactly_one_block(spark):
    rows = [(g, m, n) for g, n in ((1, 90), (2, 3), (3, 1)) for m in range(n)]
    placed = blocks.in_blocks(spark.createDataFrame(rows, "g long, m long, n long"), "m", "n", 16)
    placed = placed.select("g", "low", "high", "m", "side").orderBy("g", "low", "high").collect()
    groups = np.cumsum([0] + [a[:3] != b[:3] for a, b in zip(placed, placed[1:])])
    side = np.array([r.side for r in placed])
    met = [(placed[x].g, *sorted((placed[x].m, placed[y].m))) for i, j in blocks.pairs(groups, side, 50) for x, y in zip(i, j)]
    assert len(met) == len(set(met)) and set(met) == {(g, a, b) for g, n in ((1, 90), (2, 3)) for b in range(n) for a in range(b)}
    assert max(np.bincount(groups)) <= 64


def test_streams_are_cut_between_groups():
    keys = np.repeat(np.arange(60), np.random.default_rng(1).integers(1, 40, 60))
    table = pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.arange(len(keys)))], names=["k", "v"])
    parts = [table.slice(a, 37) for a in range(0, len(keys), 37)]
    seen = []
    for cut, groups in blocks.whole_groups(iter(parts), 1, 64):
        own = cut.column("k").to_numpy()
        assert len(set(own)) == groups[-1] + 1 and not set(own) & {k for k, _ in seen}
        seen += zip(own.tolist(), cut.column("v").to_pylist())
    assert [v for _, v in seen] == list(range(len(keys)))


def test_local_components_equal_brute_force():
    rng = np.random.default_rng(2)
    i, j = rng.integers(0, 200, 120), rng.integers(0, 200, 120)
    want = brute(zip(i.tolist(), j.tolist()))
    assert blocks.local_components(200, i, j).tolist() == [want.get(k, k) for k in range(200)]
