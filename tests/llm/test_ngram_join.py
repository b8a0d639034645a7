import random
from collections import defaultdict

import numpy as np
import pytest

from stayline.llm import ngram_join as nj

SCHEMA = "doc_id long, text string, copy string, key string, class int, kept string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", 3, "c") for r in rows], SCHEMA)


def grams(text):
    words = nj._WORD.findall((text or "").lower())
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def no(key):
    return -1 if key is None else key


def brute(rows):
    sets = [grams(t) for _, t in rows]
    links, parent = defaultdict(int), list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for j, b in enumerate(sets):
        for i, a in enumerate(sets[:j]):
            if a and b and 5 * len(a & b) >= 4 * len(a | b):
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    smallest = defaultdict(list)
    for k, (key, _) in enumerate(rows):
        smallest[find(k)].append((key is not None, key))
    return sorted((no(k), no(min(smallest[find(i)])[1]), links[i]) for i, (k, _) in enumerate(rows))


def corpus():
    rng = random.Random(6)
    words = [f"w{k}" for k in range(4000)]
    rows = []

    def add(text):
        rows.append((len(rows), text))

    for _ in range(40):
        add(" ".join(rng.choices(words, k=rng.randint(5, 150))))
    for _ in range(8):  # groups of near copies around the threshold
        first = rng.choices(words, k=rng.randint(60, 140))
        for _ in range(12):
            other = list(first)
            for _ in range(rng.randint(0, 4)):
                other[rng.randrange(len(other))] = rng.choice(words)
            add(" ".join(other))
    passage = " ".join(rng.choices(words, k=60))
    for _ in range(25):
        add(passage + " " + " ".join(rng.choices(words, k=rng.randint(5, 60))))
    for text in ("", None, "  \n", "one", "one two", "One  TWO", "a b c d e", "A\tb\nc d e"):
        add(text)
        add(text)
    rows += [(None, "no id at all here"), (None, "no id at all here"), (3, rows[3][1]), (3, "w w w " * 5000)]
    return rows


def test_classes_and_links_equal_brute_force(spark):
    rows = corpus()
    got = nj.join(frame(spark, rows)).collect()
    assert sorted((no(r.doc_id), no(r.class_id), r.n_links) for r in got) == brute(rows)


def test_blocks_give_the_same_result(spark):
    rows = corpus()
    got = nj.join(frame(spark, rows), nj.Search(block=4)).collect()
    assert sorted((no(r.doc_id), no(r.class_id), r.n_links) for r in got) == brute(rows)


def test_one_of_each_class_stays_with_all_columns(spark):
    rows = corpus()
    docs = frame(spark, rows)
    kept = nj.one_of_each(docs).collect()
    assert docs.columns == nj.one_of_each(docs).columns
    ids = [r.doc_id for r in kept]
    empties = [k for k, t in rows if not grams(t)]
    assert set(empties) <= set(ids)  # a text without words is a copy of nothing
    assert ids.count(None) == 1
    texts = [r.text for r in kept if grams(r.text)]
    assert all(5 * len(grams(a) & grams(b)) < 5 * len(grams(a) | grams(b)) for k, a in enumerate(texts) for b in texts[:k])


def test_empty_table(spark):
    assert nj.join(frame(spark, [])).count() == 0
    assert nj.one_of_each(frame(spark, [])).count() == 0


def test_posterior_thresholds():
    steps = nj.Search().least_matches()
    assert [n for n, _ in steps] == [32, 64, 96, 128]
    # a pair at the threshold is dropped with a chance of the order of the tolerance
    from math import comb

    for n, m in steps:
        p = 0.8 + 0.2 / 256
        assert sum(comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(m)) < 1e-4
        assert m > 0.35 * n


@pytest.mark.parametrize("n", [3, 400])
def test_intersections(n):
    rng = np.random.default_rng(n)
    sets = [np.unique(rng.integers(0, 300, 120).astype(np.uint64)) for _ in range(40)]
    i, j = rng.integers(0, 40, n), rng.integers(0, 40, n)
    assert nj.intersections(sets, i, j).tolist() == [len(np.intersect1d(sets[a], sets[b])) for a, b in zip(i, j)]


def test_one_of_each_keeps_columns_of_any_name(spark):
    rows = [(1, "some words to say here", "a", "b", "c"), (2, "some words to say here", "a", "b", "c"), (3, None, "a", "b", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `__copy` string, copy string, doc string")
    out = nj.one_of_each(docs)
    assert out.schema == docs.schema and sorted(tuple(r)[1:] for r in out.collect() if r.text) == [rows[0][1:]]
    assert out.count() == 2
