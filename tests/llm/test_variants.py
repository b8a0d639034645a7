import random
import re
import zlib
from collections import Counter

import pytest

from stayline.llm import variants
from stayline.llm.variants import Spelling, near_pairs

SCHEMA = "doc_id long, text string, word string, n string, `key` string, side string"


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def counts(rows, spelling):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            lot = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if spelling.garble and lot % spelling.garble == 0:
                run = run[: lot % len(run)] + run[lot % len(run) + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= spelling.least_chars and n >= spelling.least_count}


def brute(rows, spelling):
    words = counts(rows, spelling)
    near = {w: [x for x in words if is_near(w, x)] for w in words}
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda x: (-words[x], x))
            if words[best] >= spelling.times * words[w]:
                form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), words.get(form.get(w))))
    return sorted(out)


def found(spark, rows, spelling):
    frame = spark.createDataFrame([(*row, "a", "b", "c", "d") for row in rows], SCHEMA)
    got = variants.group_variants(frame, spelling)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(tuple(r) for r in got.collect())


def corpus(seed, letters="abcdé×"):
    rng = random.Random(seed)
    base = ["".join(rng.choice(letters) for _ in range(rng.randrange(6, 12))) for _ in range(60)]
    rows = []
    for i in range(150):
        ws = []
        for _ in range(40):
            w = base[min(int(rng.expovariate(0.15)), 59)]
            if rng.random() < 0.2:
                k = rng.randrange(len(w))
                w = rng.choice((w[:k] + w[k + 1 :], w[:k] + rng.choice(letters) + w[k:], w[:k] + rng.choice(letters) + w[k + 1 :]))
            ws.append(rng.choice((w, w, w.upper())))
        rows.append((i, rng.choice((" ", "9", "-")).join(ws)))
    return rows


@pytest.mark.parametrize("spelling", [Spelling(times=3), Spelling(times=2, garble=5), Spelling(times=2, most=2), Spelling(least_chars=4, least_count=1, times=2, most=6)])
def test_equals_brute_force(spark, spelling):
    rows = corpus(len(repr(spelling)))
    got = found(spark, rows, spelling)
    assert got == brute(rows, spelling)
    assert sum(r[1] is not None for r in got) > 20


def test_every_list_dealt_again(spark):
    rows = [(i, " ".join(["aaaaaaa" + "b" * (i % 4) + "c" * (i % 3), "ababab" + "a" * (i % 5)])) for i in range(60)]
    assert found(spark, rows, Spelling(times=2, most=1)) == brute(rows, Spelling(times=2))


def test_nulls_empties_repeats_and_long_texts(spark):
    rows = [(1, None), (2, ""), (None, "Variant variant VARIANT varient"), (None, "varient 123 a b c"), (3, "short words only")]
    rows += [(4, "variant " * 50_000)] * 2 + [(5, "x" * 300_000 + " " + "x" * 300_000)]
    got = found(spark, rows, Spelling())
    assert got == brute(rows, Spelling())
    assert ("varient", "variant", "variant", 2, 1, 100_003) in got
    assert found(spark, [], Spelling()) == []


def test_roots_follow_forms_to_the_last(spark):
    chain = ["aaaaaaaa"]
    for k in range(5):
        chain.append(chain[-1][:k] + "b" + chain[-1][k + 1 :])
    rows = [(k, f"{word} " * 2 * 3**k) for k, word in enumerate(chain)]
    got = {r[0]: r for r in found(spark, rows, Spelling(times=3))}
    assert all(got[w][2] == chain[-1] for w in chain) and got[chain[0]][1] == chain[1]


def test_sorted_scan_equals_brute_force():
    rng = random.Random(1)
    for _ in range(150):
        words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 7))) for _ in range(40)})
        want = {(i, j) for j in range(len(words)) for i in range(j) if is_near(words[i], words[j])}
        got = [*near_pairs(words)]
        assert set(got) == want and len(got) == len(want)
        assert {*near_pairs(["xy" + w for w in words], 2)} == want
    assert [*near_pairs([])] == [] and [*near_pairs(["a"])] == []


def test_forms_must_be_more_frequent():
    with pytest.raises(ValueError):
        Spelling(times=1)
