import random
import re
from collections import defaultdict

import pytest

from stayline.llm import substrings
from stayline.llm.substrings import Automaton, Repeats, covered

SCHEMA = "doc_id long, text string, id string, t string, `hash` string, spans string"


def table(spark, rows):
    return spark.createDataFrame([(*row, "a", "b", "c", "d") for row in rows], SCHEMA)


def brute(rows, window):
    """Rows by (doc_id, n_words, n_removed, kept); ids are different or rows equal."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", text or "") for _, text in rows]
    first = {}
    for (doc_id, _), ws in zip(rows, words):
        for k in range(len(ws) - window + 1):
            key = tuple(ws[k : k + window])
            first[key] = min(first.get(key, (doc_id, k)), (doc_id, k))
    out = []
    for (doc_id, _), ws in zip(rows, words):
        gone = {p for k in range(len(ws) - window + 1) if first[tuple(ws[k : k + window])] < (doc_id, k) for p in range(k, k + window)}
        out.append((doc_id, len(ws), len(gone), " ".join(w for p, w in enumerate(ws) if p not in gone)))
    return sorted(out)


def found(spark, rows, repeats=Repeats()):
    frame = substrings.without_repeats(table(spark, rows), repeats)
    assert frame.columns == ["doc_id", "n_words", "n_removed", "spans", "kept"]
    got = frame.collect()
    for r in got:
        assert sum(s.stop - s.start for s in r.spans) == r.n_removed
        assert all(a.stop < b.start for a, b in zip(r.spans, r.spans[1:]))
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got), key=str)


def corpus(seed, n=80, alphabet=3000, passages=6):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(alphabet)}" + rng.choice(("", "é", "."))
    shared = [[word() for _ in range(rng.randrange(15, 60))] for _ in range(passages)]
    rows = []
    for i in range(n):
        ws = []
        for _ in range(rng.randrange(1, 5)):
            ws += [word() for _ in range(rng.randrange(0, 40))]
            passage = list(rng.choice(shared))
            if rng.random() < 0.3:
                passage[rng.randrange(len(passage))] = word()
            ws += passage[rng.randrange(5) :]
        rows.append((i, rng.choice((" ", "\n", "\t ", "\x0b")).join(ws)))
    rows += [(n + k, rows[rng.randrange(n)][1].replace("\n", "  ")) for k in range(10)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = corpus(seed)
    assert found(spark, rows) == sorted(brute(rows, 20), key=str)


def test_few_different_words(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randrange(0, 60)))) for i in range(60)]
    repeats = Repeats(window=6, gram=2)
    assert found(spark, rows, repeats) == sorted(brute(rows, 6), key=str)


@pytest.mark.parametrize("most", [1, 2, 7])
def test_full_shards_are_dealt_by_windows(spark, most):
    rng = random.Random(most)
    line = [f"the{k}" for k in range(14)]
    rows = []
    for i in range(120):
        tail = [f"x{rng.randrange(3)}" for _ in range(25)]
        rows.append((i, " ".join([f"u{i}", *line, *tail, f"v{i % 7}", *line])))
    assert found(spark, rows, Repeats(most=most)) == sorted(brute(rows, 20), key=str)


def test_nulls_empty_and_repeated_rows(spark):
    long = " ".join(f"q{k}" for k in range(30))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "a b"), (5, "a b"), (6, long), (6, long), (7, long + " z"), (8, long.replace(" ", "\n"))]
    assert found(spark, rows) == sorted(brute(rows, 20), key=str)
    # rows without an id come last; equal ones are one document
    got = found(spark, [(9, long), (None, long + " tail"), (None, "only " + long[::-1]), (None, "only " + long[::-1])])
    assert (9, 30, 0, long) in got and (None, 31, 30, "tail") in got
    # a short text is one word here, so it stays
    other = "only " + long[::-1]
    assert got.count((None, 31, 0, other)) == 2
    assert found(spark, []) == []


def test_repeats_within_one_text(spark):
    period = " ".join(f"p{k % 7}" for k in range(100))
    block = " ".join(f"b{k}" for k in range(25))
    rows = [(1, period), (2, f"{block} mid {block} end {block}")]
    assert found(spark, rows) == sorted(brute(rows, 20), key=str)


def test_very_long_text(spark):
    rng = random.Random(2)
    ws = [f"{rng.randrange(10**9):x}" for _ in range(300_000)]
    ws[200_000:200_050] = ws[100:150]
    ws.append("y" * 2_500_000)
    got = found(spark, [(1, " ".join(ws)), (2, " ".join(ws[250_000:250_030]))])
    assert [r[2] for r in got] == [50, 30]


def test_statistics_equal_brute_force():
    rng = random.Random(9)
    for _ in range(60):
        known = [[rng.choice((b"a", b"b", b"c")) for _ in range(rng.randrange(0, 15))] for _ in range(4)]
        stretches = {tuple(ws[a:b]) for ws in known for a in range(len(ws)) for b in range(a + 1, len(ws) + 1)}
        automaton = Automaton()
        for ws in known:
            automaton.add(ws)
        text = [rng.choice((b"a", b"b", b"c", b"d")) for _ in range(20)]
        want = [max((n for n in range(1, k + 2) if tuple(text[k + 1 - n : k + 1]) in stretches), default=0) for k in range(20)]
        assert [*automaton.statistics(text)] == want


def test_covered_stretches_are_maximal():
    lengths = [1, 2, 3, 4, 1, 2, 3, 0, 1, 1, 2, 3]
    inside = defaultdict(bool)
    for at, n in enumerate(lengths):
        if n >= 3:
            for p in range(at - 2, at + 1):
                inside[p] = True
    got = [*covered(iter(lengths), 3)]
    assert {p for a, b in got for p in range(a, b)} == {p for p in inside}
    assert got == [(0, 7), (9, 12)]
