import hashlib
import random
import re

from stayline.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SCHEMA = "doc_id long, text string, base string, n_chars int, marks int"


def brute(text):
    found = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        luhn = sum(n if k % 2 == 0 else sum(divmod(2 * n, 10)) for k, n in enumerate(digits[::-1])) % 10 == 0
        if 12 <= len(digits) <= 19 and luhn:
            found.append((m.start(), 2, m.end()))
    return sorted(found + [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15])


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1, 2) for r in rows], SCHEMA)


def test_base_spans_equal_the_patterns():
    rng = random.Random(3)
    pools = ["0123456789..@@a-b é+() ÀZ%", "0123456789 -+.", "ab@.@@.é1"]
    for n in range(30_000):
        text = "".join(rng.choice(pools[n % 3]) for _ in range(rng.randint(0, 32)))
        assert pii.base_spans(text) == brute(text), text
    assert pii.base_spans("9" * 50_000 + ".1.1.1") == brute("9" * 4 + ".1.1.1") == []


def corpus():
    rows = [(k, f"Some words of the day about nothing {k} at all. Reach me by phone: +1 (555) 010-{1000 + k} thanks and then more.") for k in range(30)]
    rows += [(100 + k, f"Other words here é. Reach me by phone: QX-{70000 + 37 * k} thanks and then more.") for k in range(8)]
    rows += [(200 + k, f"The model number ZZ-{50000 + k} is sold in a shop, and of the day 2020-10-1{k} too.") for k in range(9)]
    rows += [(300, None), (301, ""), (None, "mail a.b@c.org now"), (302, "mail a.b@c.org now"), (302, "mail a.b@c.org now")]
    return [*rows, (400, "filler words " * 50_000 + "by phone: RR-88123 thanks and")]


def test_contexts_discover_identifiers_and_leave_others_alone(spark):
    rows = corpus()
    got = pii.find(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        base = brute(texts[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(pii.written(base).encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == n for _, k, _ in base) for n in range(4))
        spans = [x.split(":") for x in r.spans.split(",")] if r.spans else []
        assert set(pii.written(base).split(",")) - {""} <= set(r.spans.split(","))
        extra = [texts[r.doc_id][int(a) : int(b)] for _, a, b in spans if (int(a), int(b)) not in {(x, y) for x, _, y in base}]
        assert extra == (re.findall(r"(?:QX|RR)-\d+", texts[r.doc_id] or "")), r.doc_id
    patterns, instances = pii.patterns_of(pii.scan(frame(spark, rows)))
    assert "by phone: _" in {r.wording for r in patterns.collect()} and instances.count() == 9


def test_common_words_are_no_patterns(spark):
    rng = random.Random(2)
    words = "the of and to in".split()
    text = lambda: " ".join(rng.choices(words, k=20))
    rows = [(k, f"{text()} user{k}@mail.org {text()} AB-{10000 + k} {text()}") for k in range(60)]
    assert pii.find(frame(spark, rows)).where("n_found > 0").count() == 0


def test_redact(spark):
    rows = corpus()
    docs = frame(spark, rows)
    out = pii.redact(docs)
    assert out.schema == docs.schema
    got = out.collect()
    assert len(got) == len(rows)
    by_key = {r.doc_id: r for r in got}
    assert by_key[101].text == "Other words here é. Reach me by phone: [PHONE] thanks and then more."
    assert by_key[302].text == "mail [EMAIL] now" and by_key[302].n_chars == 16 and by_key[302].base == "clash"
    assert by_key[300].text is None and by_key[301].text == "" and by_key[200].text == dict(rows)[200]
    assert pii.redact(frame(spark, [])).count() == 0 and pii.find(frame(spark, [])).count() == 0


def test_very_many_identifiers_in_one_text(spark):
    text = " ".join(f"a{k}@mail.org AB-{100000 + k}" for k in range(3000))
    docs = frame(spark, [(1, text), (2, "AB-1234567")])
    assert pii.scan(docs).where("doc_id = 1").count() == 6
    got = {r.doc_id: r for r in pii.find(docs).collect()}
    assert len(got) == 2 and got[1].n_email == 3000 and got[2].spans == ""


def test_masks_join_overlaps():
    assert pii.masked("a 1.2.3.4 b", [(2, 1, 9)]) == "a [IP] b"
    assert pii.masked("+1.2.3.456", [(0, 3, 10), (1, 1, 8)]) == "[PHONE]"
    assert pii.masked("0123456789", [(0, 2, 6), (4, 3, 8)]) == "[CARD]89"


def spans_by_text(spark, rows):
    texts = dict(rows)
    return {r.doc_id: [texts[r.doc_id][int(x.split(":")[1]) : int(x.split(":")[2])] for x in r.spans.split(",") if x] for r in pii.find(frame(spark, rows)).collect()}


def test_contexts_find_groups_of_digits_and_at_signs_and_then_every_place(spark):
    rows = [(k, f"Some words of the day about nothing {k} at all. Reach me by phone: +1 (555) 010-{1000 + k} thanks and then more.") for k in range(30)]
    told = ["030 12 34 56", "alice@intranet", "(555) 010-1234", "QX-70037", "DE89 3704 0044 0532"]
    rows += [(100 + k, f"Other words here. Reach me by phone: {x} thanks and then more.") for k, x in enumerate(told)]
    rows += [(200, "We saw QX-70037 again"), (201, "QX-70037"), (202, "Nobody knows ZZ-70038 here"), (203, "on 2020 10 12 it rained"), (204, "alice@intranet wrote")]
    got = spans_by_text(spark, rows)
    for k, x in enumerate(told):
        assert got[100 + k] == [x], x
    assert got[200] == got[201] == ["QX-70037"] and got[202] == got[203] == [] and got[204] == ["alice@intranet"]
    texts = {r.doc_id: r.text for r in pii.redact(frame(spark, rows)).collect()}
    assert texts[200] == "We saw [PHONE] again" and texts[100] == "Other words here. Reach me by phone: [PHONE] thanks and then more."


def test_chains_are_followed_to_their_end(spark):
    """Each context is learned from identifiers that the one before it found: six of them, one after the other."""
    filler = "some words of the day that say nothing at all and go on"
    sizes, texts = [96, 48, 24, 12, 6, 3, 1], []
    names = [[f"+1 555 010-{2000 + k}" for k in range(sizes[0])]] + [[f"ID{hop}-{80_000 + k}" for k in range(n)] for hop, n in enumerate(sizes[1:])]
    for hop in range(6):
        texts += [f"{filler} hop{chr(97 + hop)} code{chr(97 + hop)}: {name} {filler}" for name in (*names[hop], *names[hop + 1])]
    got = spans_by_text(spark, list(enumerate(texts)))
    held = set(sum(got.values(), []))
    assert held == set(sum(names, []))


def test_long_runs_of_digits_take_linear_time():
    import time

    start = time.perf_counter()
    text = "7" * 10_000_000
    assert pii.base_spans(text) == [] and [*pii._candidates(text, [])] == [(0, len(text))]
    assert time.perf_counter() - start < 30


def test_columns_of_any_name_stay(spark):
    schema = "doc_id long, text string, `__key` string, doc string, text_key string, extra string"
    docs = spark.createDataFrame([(1, "mail a.b@c.org", "a", "b", "c", "d"), (None, None, "a", "b", "c", "d")], schema)
    out = pii.redact(docs)
    assert out.schema == docs.schema
    assert sorted(map(str, out.collect())) == sorted(map(str, spark.createDataFrame([(1, "mail [EMAIL]", "a", "b", "c", "d"), (None, None, "a", "b", "c", "d")], schema).collect()))
