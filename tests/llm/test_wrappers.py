from stayline.llm import wrappers

SCHEMA = "page_id long, url string, html string, text string, host int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)


def text_of(html):
    return wrappers.main_text(wrappers.parse(html), set())


def test_parts_around_the_article_go():
    html = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><article>";</script></head>
    <body><header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></ul></nav><div class="cookie-notice">We use</div>
    <!-- ad <p>x</p> --><div id="ads">Buy</div><article><header><h1>Head &amp; line</h1></header><p>One <b>bold</b>
    and&nbsp;two<br>three<p>Un<i>closed</i> &lt;b&gt; &#233;<div class="share">Share</div><form><p>Name</p><input></form>
    <ul><li>item<li>next</ul><pre>a
       b</pre><section class="comments"><p>Nice!</p></section></article><aside><p>More</p></aside>
    <div role="contentinfo">me</div><footer>&copy; me</footer><noscript><p>no</p></noscript></body></html>"""
    assert text_of(html) == "Head & line\n\nOne bold and two three\n\nUnclosed <b> é\n\nitem\n\nnext\n\na b"


def test_odd_markup():
    assert text_of("") == "" and text_of("plain text") == "plain text"
    assert text_of("<p>a < b and c > d</p>") == "a < b and c > d"
    assert text_of("<div><p>one</div>two</p>three") == "one\n\ntwo\n\nthree" or text_of("<div><p>one</div>two") == "one\n\ntwo"
    assert text_of("<p>x<script>never closed <p>y") == "x"
    assert text_of("<p title='a>b' data-x=\"</p>\">in</p>") == "in"
    assert text_of("<table><tr><td>1<td>2<tr><td>3</table>") == "1 2\n\n3"
    assert text_of('<p>a<span class="ad">b</span>c') == "ac"


def test_names_that_hide_the_article_are_not_believed():
    assert text_of('<div class="layout with-sidebar"><article><p>in</p><p class="ad">x</p></article></div><div class=menu>m</div>') == "in"
    assert text_of('<div class="sidebar"><p>side</p></div><main><p>in</p></main>') == "in"
    assert text_of('<article class="comment"><p>nice</p></article><div><p>text</p></div>') == "text"


def page(k, body, extra=""):
    return f"<body><div>Welcome to the site</div><div><p>{body}</p>{extra}</div><div>Read our other pieces</div></body>"


def test_constant_nodes_are_template_and_slots_are_content(spark):
    rows = [(k, f"http://h.example/{k}", page(k, f"body {k}", "<p>shared by two</p>" if k < 2 else "")) for k in range(12)]
    rows += [(100, "http://lone.example/", page(100, "lone"))]
    rows += [(200 + k, f"http://copy.example/{k}", page(0, "same everywhere")) for k in range(8)]
    got = {r.page_id: r for r in wrappers.extract(frame(spark, rows)).collect()}
    assert got[0].text == "body 0\n\nshared by two" and got[5].text == "body 5" and got[5].n_chars == 6
    assert got[100].text == "Welcome to the site\n\nlone\n\nRead our other pieces"  # nothing to align with
    assert "same everywhere" in got[203].text


def test_every_page_of_a_large_host_and_defined_cases(spark):
    rows = [(k, "https://big.example/x", page(k, f"text {k}")) for k in range(400)]
    rows += [(1000, None, None), (1001, "not a url", "<p>odd</p>"), (None, "http://n.example", "<p>null id</p>"), (1002, "http://r", ""), (1002, "http://r", "")]
    rows += [(1003, "http://long.example", "<article>" + "".join(f"<p>par {k}</p>" for k in range(20_000)) + "</article>")]
    got = wrappers.extract(frame(spark, rows)).collect()
    texts = {r.page_id: r.text for r in got}
    assert len(got) == len(rows) and all(texts[k] == f"text {k}" for k in range(400))
    assert texts[1000] == "" and texts[1001] == "odd" and texts[None] == "null id" and texts[1002] == ""
    assert texts[1003].count("\n\n") == 19_999
    assert wrappers.extract(frame(spark, [])).count() == 0


def test_simple_tree_matching_keeps_order_and_prefers_equal_texts():
    a = wrappers.parse("<ul><li>a<li>b<li>c</ul><p>x</p>")
    b = wrappers.parse("<ul><li>q<li>a<li>c</ul><p>y</p>")
    assert [(x.text, y.text) for x, y in sorted(wrappers.match(a, b), key=lambda p: p[0].text)] == [("a", "a"), ("c", "c"), ("x", "y")]


def test_long_lists_are_aligned_on_equal_texts():
    one = wrappers.parse("<article>" + "".join(f"<p>t{k}</p>" for k in range(1500)) + "</article>")
    two = wrappers.parse("<article>" + "".join(f"<p>t{k}</p>" for k in range(5, 1500, 2)) + "</article>")
    assert sum(x.text == y.text for x, y in wrappers.match(one, two)) == 748


def test_pages_nest_as_deep_as_they_like(spark):
    deep = lambda k, n: "<div>" * n + f"<p>text {k}</p><p>Read our other pieces</p>" + "</div>" * n
    rows = [(k, f"http://deep.example/{k}", deep(k, 5_000)) for k in range(6)]
    got = {r.page_id: r.text for r in wrappers.extract(frame(spark, rows)).collect()}
    assert got == {k: f"text {k}" for k in range(6)}


def brute_weight(a, b):
    """Simple tree matching by its definition: every order-keeping match of the child lists."""
    if a.label != b.label:
        return 0
    if a.label == "#text":
        return wrappers.EQUAL_TEXT if a.text == b.text else 1

    def best(xs, ys):
        if not xs or not ys:
            return 0
        w = brute_weight(xs[0], ys[0])
        return max(best(xs[1:], ys), best(xs, ys[1:]), w + best(xs[1:], ys[1:]) if w else 0)

    return 1 + best(a.kids, b.kids)


def test_matching_equals_brute_force_on_random_trees():
    import random

    rng = random.Random(6)

    def tree(depth):
        if not depth or rng.random() < 0.4:
            return f"<p>{rng.choice('abc')}</p>"
        tag = rng.choice(("div", "ul", "blockquote"))
        return f"<{tag}>" + "".join(tree(depth - 1) for _ in range(rng.randrange(1, 4))) + f"</{tag}>"

    for _ in range(150):
        a, b = (wrappers.parse("".join(tree(2) for _ in range(rng.randrange(1, 4)))) for _ in range(2))
        memo = {}
        got = 1 + sum(w for _, _, w in wrappers._run(wrappers._align(a.kids, b.kids, memo), memo))
        assert got == brute_weight(a, b)


def test_near_copies_of_an_article_keep_what_they_share(spark):
    body = lambda k: f"<div>Site name</div><article><p>First unchanged paragraph.</p><p>changed {k}</p><p>Second unchanged one.</p></article><div>Bye</div>"
    rows = [(k, f"http://copies.example/{k}", body(k)) for k in range(10)]
    got = {r.page_id: r.text for r in wrappers.extract(frame(spark, rows)).collect()}
    assert all(got[k] == f"First unchanged paragraph.\n\nchanged {k}\n\nSecond unchanged one." for k in range(10))
    # a line that many different articles hold at one place is template still
    unlike = [(k, f"http://unlike.example/{k}", f"<article><p>Sign up today</p><p>one {k}</p><p>two {k}</p><p>three {k}</p></article>") for k in range(10)]
    got = {r.page_id: r.text for r in wrappers.extract(frame(spark, unlike)).collect()}
    assert all(got[k] == f"one {k}\n\ntwo {k}\n\nthree {k}" for k in range(10))
