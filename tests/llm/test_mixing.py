import hashlib
import random
from fractions import Fraction

from stayline.llm import mixing

SCHEMA = "doc_id long, text string, lang string, source string, domain string, n_tokens string, copies int, tokens int, place string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "own", 9, 1, "p") for r in rows], SCHEMA)


def share_out(children, budget):
    """Budgets by water level: {name: (weight, capacity)}."""
    open_names, got, left = sorted(children, key=lambda n: (Fraction(children[n][1], children[n][0]), n)), {}, budget
    while open_names:
        name, total = open_names[0], sum(children[n][0] for n in open_names)
        weight, capacity = children[name]
        if capacity * total <= left * weight:
            got[name], left = capacity, left - capacity
            open_names.pop(0)
        else:
            got |= {n: min(left * children[n][0] // total, children[n][1]) for n in open_names}
            break
    return got


def brute(rows, mix):
    words = lambda t: len((t or "").replace("\x85", "x").split())
    leaves = {}
    for doc in rows:
        leaves.setdefault((doc[4] or "", doc[2] or "", doc[3] or ""), []).append(doc)
    tokens = {leaf: sum(words(d[1]) for d in docs) for leaf, docs in leaves.items()}
    budgets = {(): min(sum(tokens.values()) * mix.share // 100, sum(tokens.values()) * mix.max_epochs)}
    for depth in (1, 2, 3):
        below = {}
        for path, budget in budgets.items():
            children = {}
            for leaf, n in tokens.items():
                if leaf[: depth - 1] == path:
                    weight, capacity = children.get(leaf[:depth], (mix.weights.get("/".join(leaf[:depth]), mix.default), 0))
                    children[leaf[:depth]] = weight, capacity + n * mix.max_epochs
            below |= share_out(children, budget)
        budgets = below
    found = []
    for leaf, docs in leaves.items():
        epochs, rest = divmod(budgets[leaf], tokens[leaf]) if tokens[leaf] else (0, 0)

        def place(doc):
            told = "|".join(str(x) for x in (mix.seed, epochs, doc[0], hashlib.md5((doc[1] or "").encode()).hexdigest()) if x is not None)
            return int(hashlib.md5(told.encode()).hexdigest()[:15], 16)

        for doc in docs:
            before = sum(words(d[1]) for d in docs if place(d) < place(doc))
            found.append((-1 if doc[0] is None else doc[0], words(doc[1]), epochs + (before < rest)))
    return sorted(found)


def corpus():
    rng = random.Random(3)
    rows = []
    for k in range(600):
        source = "s0" if rng.random() < 0.35 else f"s{rng.randint(1, 6)}"
        lang = rng.choices(["en", "de", None], [7, 2, 1])[0]
        rows.append((k, " ".join(["w"] * rng.choice([0, 1, 5, 40, 300])) or rng.choice([None, "", " \n"]), lang, source, "crawl" if source == "s0" else "books"))
    rows += [(5, "same words here", "en", "s1", "books")] * 3 + [(None, "no id", "fr", None, None), (1000, None, "xx", "s9", "books")]
    return rows


def told(got):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.copies) for r in got)


def test_copies_equal_brute_force(spark):
    rows = corpus()
    for mix in (
        mixing.Mix(),
        mixing.Mix(weights={"crawl": 10, "books": 90, "books/de": 5, "books/en": 1, "books/en/s2": 7}, share=130, max_epochs=2),
        mixing.Mix(weights={"crawl": 1}, default=3, share=900, max_epochs=3),
    ):
        docs = frame(spark, rows)
        assert told(mixing.copies(docs, mix).collect()) == brute(rows, mix), mix


def test_shortages_go_to_siblings_before_ancestors(spark):
    rows = [(k, "w " * 10, "en", "a", "x") for k in range(1)] + [(100 + k, "w " * 10, "de", "a", "x") for k in range(50)]
    rows += [(200 + k, "w " * 10, "en", "a", "y") for k in range(50)]
    mix = mixing.Mix(share=50, max_epochs=1)
    got = {r.doc_id: r.copies for r in mixing.copies(frame(spark, rows), mix).collect()}
    in_x, in_y = (sum(v for k, v in got.items() if (k < 200) == flag) for flag in (True, False))
    assert got[0] == 1 and abs(in_x - in_y) <= 1 and 25 <= in_y <= 26


def test_mixed_repeats_rows_and_keeps_columns(spark):
    rows = corpus()
    mix = mixing.Mix(share=250)
    docs = frame(spark, rows)
    out = mixing.mixed(docs, mix)
    assert out.columns == docs.columns and out.schema == docs.schema
    got = out.collect()
    assert len(got) == sum(c for _, _, c in brute(rows, mix))
    assert {(r.n_tokens, r.copies, r.place) for r in got} == {("own", 9, "p")}


def test_empty_table_and_native_plan(spark):
    empty = frame(spark, [])
    assert mixing.copies(empty, mixing.Mix()).count() == 0 and mixing.mixed(empty, mixing.Mix()).count() == 0
    plan = mixing.copies(frame(spark, corpus()), mixing.Mix())._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_columns_of_any_name_stay(spark):
    names = ("__tokens", "__print", "__epochs", "__cut", "__copy", "__level0", "__root", "doc", "tokens", "copies", "n_tokens")
    schema = "doc_id long, text string, domain string, lang string, source string, " + ", ".join(f"`{n}` string" for n in names)
    rows = [(k, f"words of text {k}", "d", "en", "s", *names) for k in range(20)]
    docs = spark.createDataFrame(rows, schema)
    out = mixing.mixed(docs, mixing.Mix(share=100))
    assert out.schema == docs.schema and sorted(map(tuple, out.collect())) == sorted(rows)
    told = mixing.copies(docs, mixing.Mix(share=100)).collect()
    assert all(r.copies == 1 and r.n_tokens == 4 and r["__tokens"] == "__tokens" for r in told)
