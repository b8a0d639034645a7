import random
import re

from stayline.llm import line_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    repeated = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(repeated)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, source string, row int, lines string")


TEXTS = [
    None,
    "",
    " \t\n\x0b\x0c\r ",
    "a b c a b c a b c",
    "one\none\n one\none \n\nTwo two",
    "a\x0bb\x0cc\rd\te  f\n#*$%&|<> é😀 a b",
    "a a a a",
    "x y z\nq x y z",
    "b b b\nb b b\nB b b",
]


def test_base_counts_equal_brute_force(spark):
    rng = random.Random(4)
    texts = TEXTS + ["".join(rng.choice("ab \n\t#é") for _ in range(rng.randint(0, 80))) for _ in range(150)]
    texts.append(" ".join(rng.choice(["the", "of", "and", "to"]) for _ in range(2000)))
    rows = frame(spark, [(k, t, "s") for k, t in enumerate(texts)])
    got = {r.doc_id: r for r in line_rules.judge(rows).collect()}
    for k, text in enumerate(texts):
        r = got[k]
        told = base(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == told, text
        assert r.base_failed == (told[0] < 50 or 100 * told[4] > 50 * told[0])


def prose(k, n=60):
    return " ".join(f"w{k}x{i}" for i in range(n))


def test_lines_of_many_documents_go_and_depleted_documents_are_rejected(spark):
    notice = "  All Rights   reserved here " + " ".join(f"n{i}" for i in range(30))
    same = " all rights reserved HERE " + " ".join(f"n{i}" for i in range(30))
    rows = [(k, f"{prose(k)}\n{notice if k % 2 else same}", "a") for k in range(20)]
    rows += [(100 + k, f"{prose(100 + k, 40)}\n{notice}", "a") for k in range(3)]
    rows += [(200 + k, f"{prose(200 + k, 40)}\n{notice}", "b") for k in range(3)]  # too few on this host
    rows += [(300 + k, prose(999), "c") for k in range(40)]  # copies are one document
    rows += [(400, prose(400), None), (None, prose(401), None)]
    docs = frame(spark, rows)
    got = {(r.doc_id, r.n_words_left): r.kept for r in line_rules.judge(docs).collect()}
    assert all(got[k, 60] for k in range(20))
    assert not any(got[100 + k, 40] for k in range(3))
    assert all(got[200 + k, 74] for k in range(3))
    assert all(got[300 + k, 60] for k in range(40)) and got[400, 60] and got[None, 60]
    frequent = line_rules.frequent_lines(line_rules.profile(docs)).collect()
    assert [(r.source, r.docs) for r in frequent] == [("a", 23)]


def test_remove_lines_keeps_everything_else(spark):
    rows = [(k, f"first {k}\n\nNotice  HERE\nlast\n", "a") for k in range(15)] + [(99, None, "a"), (98, "", "a"), (97, "notice here", "b")]
    docs = frame(spark, rows)
    frequent = line_rules.frequent_lines(line_rules.profile(docs))
    got = {r.doc_id: r for r in line_rules.remove_lines(docs, frequent).collect()}
    assert got[3].text == "first 3\n\n" and got[3].lines == "x" and got[3].row == 1
    assert got[99].text is None and got[98].text == "" and got[97].text == "notice here"


def test_repeated_rows_and_empty_table(spark):
    got = line_rules.judge(frame(spark, [(1, prose(1), "a")] * 3)).collect()
    assert [r.kept for r in got] == [True] * 3
    assert line_rules.judge(frame(spark, [])).count() == 0


def test_plan_is_native(spark):
    plan = line_rules.judge(frame(spark, [(1, "a", "s")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_the_limit_does_not_grow_with_the_host(spark):
    line = "shared boilerplate " + " ".join(f"b{i}" for i in range(8))
    rows = [(k, f"{prose(k)}\n{line if k < 20 else prose(-k, 3)}", "big") for k in range(5_000)]
    frequent = line_rules.frequent_lines(line_rules.profile(frame(spark, rows))).collect()
    assert [(r.source, r.docs) for r in frequent] == [("big", 20)]


def test_remove_lines_leaves_columns_of_any_name_alone(spark):
    rows = [(k, f"own {k}\nnotice here", "a", 7, 8, "d", "k") for k in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, `__row` int, `row` int, doc string, kept_lines string")
    out = line_rules.remove_lines(docs, line_rules.frequent_lines(line_rules.profile(docs)))
    assert out.columns == docs.columns
    assert {tuple(r)[1:] for r in out.collect()} == {(f"own {k}", "a", 7, 8, "d", "k") for k in range(12)}
