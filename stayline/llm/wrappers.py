"""Main text of web pages by wrapper induction: align the trees of a host's pages, keep what varies.

Pages of one host are aligned with a reference page by simple tree matching (the
order-keeping match of two trees with the most nodes; equal texts weigh more).
A text that stands at the same node of most pages is template, a node whose text
varies is a slot with content.  Menus and adverts vary from page to page too, so
elements whose name, class or role says that they are no content are cut out before
the trees are aligned, and where pages mark an article only its slots count.

A host's pages are aligned in groups of about ``GROUP`` drawn by a hash of the page, so the
largest host is many groups and no task holds a whole host; every page is in one.

Cases: null html is an empty page with an empty text; null or odd urls form a host of
their own; a host with too few different pages has no template and keeps all slots;
equal pages count once when support is counted; repeated rows give repeated
results; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Generator, Iterable
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.staging import stage

#: Pages aligned together; share and number of different pages that make a text template.
GROUP, SHARE, LEAST = 48, 0.8, 4
#: Weight of two matched texts that are equal; others and elements weigh one.
EQUAL_TEXT = 4

# Element names of HTML and words that sites use for parts around an article.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody tfoot thead tr "
    "ul caption head title".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp template noscript svg math".split())
NOISE_TAGS = frozenset(
    "head nav footer aside form button select option dialog menu object applet canvas audio video label fieldset".split()
)
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion banner cookie "
    "cookies consent gdpr sidebar sidebars aside menu menus nav navbar navigation breadcrumb breadcrumbs footer masthead "
    "topbar comment comments commentlist disqus reply replies share sharing social related recommended newsletter subscribe "
    "signup login popup modal overlay notice notices alert widget widgets toolbar pagination pager skip copyright "
    "disclaimer hidden".split()
)
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
CLOSES_P = BLOCKS - {"tr", "tbody", "thead", "tfoot", "caption"}
#: A start tag of the first kind ends an open element of these kinds, up to the nearest list or table.
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table body html article main section div".split())

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*)>", re.S
)
_ARTICLE = re.compile(r"<(?:article|main)[\s>]", re.I)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


class Node:
    """An element of block level with its children, or a text."""

    __slots__ = ("kids", "label", "main", "text")

    def __init__(self, label: str, text: str = "", main: bool = False):
        self.label, self.text, self.main, self.kids = label, text, main, []


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(raw)}


def _is_noise(tag: str, raw: str, in_main: bool, by_name: bool) -> bool:
    if tag in NOISE_TAGS or tag == "header" and not in_main:
        return True
    if not raw.strip() or tag in ("html", "body", "main"):
        return False
    if not (by_name or in_main or tag == "article"):
        return False
    found = _attributes(raw)
    if "hidden" in found or found.get("role", "").lower() in NOISE_ROLES:
        return True
    words = {w for key in ("class", "id") for w in re.split(r"[^a-z0-9]+", found.get(key, "").lower())}
    if tag == "article":
        return bool(words & {"comment", "ad", "advert", "sponsored", "promo", "related"})
    return bool(words & NOISE_WORDS) or ("header" in words and not in_main)


def parse(html: str) -> Node:
    """The page's tree of blocks and texts, without the elements that are no content.

    A name such as ``with-sidebar`` may stand on what holds the article; if the names
    outside hide all of an article, they are not believed.
    """
    tree = _parse(html, True)
    if _ARTICLE.search(html) and not any(t.main for t in leaves(tree)):
        tree = _parse(html, False)
    return tree


def _parse(html: str, by_name: bool) -> Node:
    root = Node("#page")
    stack: list[tuple[str, Node, bool]] = [("#page", root, False)]  # tag, its block, skipped
    run: list[str] = []
    skipping = mains = 0

    def flush() -> None:
        text = " ".join(unescape("".join(run)).split())
        run.clear()
        if text:
            block = stack[-1][1]
            block.kids.append(Node("#text", text, mains > 0))

    def pop() -> None:
        nonlocal skipping, mains
        tag, _, skipped = stack[-1]
        if tag in BLOCKS and not skipping:
            flush()
        skipping -= skipped
        mains -= tag in ("article", "main") and not skipping and not skipped
        stack.pop()

    def close(tags: set[str] | frozenset[str], within: frozenset[str] = frozenset()) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth][0] in tags:
                while len(stack) > depth:
                    pop()
                return
            if stack[depth][0] in within:
                return

    at, size = 0, len(html)
    while at < size:
        found = _MARKUP.search(html, at)
        if not skipping:
            run.append(html[at : found.start() if found else size])
        if found is None:
            break
        at, tag = found.end(), (found[2] or "").lower()
        if not tag:
            continue
        if found[1]:
            close({tag})
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}[\s/>]", re.I).search(html, at) if not found[3].endswith("/") else None
            if end:
                at = html.find(">", end.start()) + 1 or size
            elif tag in ("script", "style"):
                at = size
            continue
        if tag in ("br", "td", "th"):
            run.append(" ")
        if tag in CLOSES_P:
            close({"p"}, SCOPES | {"li", "blockquote", "td"})
        if tag in SIBLINGS:
            close(SIBLINGS[tag], SCOPES)
        if tag == "hr" and not skipping:
            flush()
        if tag in VOID or found[3].endswith("/") and tag not in BLOCKS:
            continue
        noise = not skipping and _is_noise(tag, found[3], mains > 0, by_name)
        parent = stack[-1][1]
        if tag in BLOCKS and not skipping:
            flush()
            if noise:
                block = parent
            else:
                block = Node(tag, main=mains > 0)
                parent.kids.append(block)
                mains += tag in ("article", "main")
        else:
            block = parent
        skipping += noise
        stack.append((tag, block, noise))
    while len(stack) > 1:
        pop()
    flush()
    return root


def leaves(node: Node) -> list[Node]:
    """The texts in page order."""
    found, open_nodes = [], [node]
    while open_nodes:
        now = open_nodes.pop()
        if now.label == "#text":
            found.append(now)
        open_nodes.extend(reversed(now.kids))
    return found


#: An alignment in steps: it asks for the weight of two nodes, gets it, and ends with its pairs.
Steps = Generator[tuple[Node, Node], int, list[tuple[Node, Node, int]]]


def _run(steps: Steps, memo: dict) -> list[tuple[Node, Node, int]]:
    """Follow an alignment, and those of child lists it asks for, on a stack of our own: pages nest as deep as they like."""
    open_steps, owners, told = [steps], [], None
    while True:
        try:
            a, b = open_steps[-1].send(told)
        except StopIteration as done:
            open_steps.pop()
            if not open_steps:
                return done.value
            told = memo[owners.pop()] = 1 + sum(w for _, _, w in done.value)
            continue
        owners.append((id(a), id(b)))
        open_steps.append(_align(a.kids, b.kids, memo))
        told = None


def _weight(a: Node, b: Node, memo: dict) -> Generator[tuple[Node, Node], int, int]:
    if a.label != b.label:
        return 0
    if a.label == "#text":
        return EQUAL_TEXT if a.text == b.text else 1
    if not a.kids or not b.kids:
        return 1
    known = memo.get((id(a), id(b)))
    if known is None:
        known = yield a, b
    return known


def _same(a: Node, b: Node) -> bool:
    """Both hold one and the same text in the same element."""
    if a.label != b.label:
        return False
    if a.label == "#text":
        return a.text == b.text
    return len(a.kids) == 1 == len(b.kids) and a.kids[0].label == "#text" == b.kids[0].label and a.kids[0].text == b.kids[0].text


def _shape(node: Node, memo: dict) -> int:
    """A number of the subtree's labels: equal for trees that differ in their texts only."""
    numbers, open_nodes = memo.setdefault("shapes", {}), [node]
    while open_nodes:
        now = open_nodes[-1]
        missing = [kid for kid in now.kids if id(kid) not in memo]
        if not missing:
            memo[id(now)] = numbers.setdefault((now.label, tuple(memo[id(kid)] for kid in now.kids)), len(numbers))
            open_nodes.pop()
        open_nodes += missing
    return memo[id(node)]


class _Forms:
    """Nodes of one label by form: their shape and the texts, with places, that the other list holds too.

    A text that the other node lacks matches none of its texts, so two nodes weigh what any
    two of the same shapes do that have the same texts in common at the same places.
    """

    def __init__(self, xs: list[Node], ys: list[Node], memo: dict) -> None:
        mine, theirs = ([[t.text for t in leaves(n)] for n in nodes] for nodes in (xs, ys))
        shared = {t for own in mine for t in own} & {t for own in theirs for t in own}
        form = lambda n, own: (_shape(n, memo), tuple((i, t) for i, t in enumerate(own) if t in shared))
        self.memo, self.xs = memo, {id(x): form(x, own) for x, own in zip(xs, mine, strict=True)}
        numbers: dict[tuple, int] = {}
        self.of = np.array([numbers.setdefault(form(y, own), len(numbers)) for y, own in zip(ys, theirs, strict=True)])
        self.forms = list(numbers)
        self.one = {n: y for n, y in zip(self.of.tolist(), ys, strict=True)}
        self.having: dict[str, list[int]] = {}
        shapes: dict[int, list[int]] = {}
        for n, (shape, texts) in enumerate(self.forms):
            shapes.setdefault(shape, []).append(n)
            for t in {t for _, t in texts}:
                self.having.setdefault(t, []).append(n)
        self.shapes = {shape: np.array(members) for shape, members in shapes.items()}
        self.again = {f for f, n in Counter(self.xs.values()).items() if n > 1}
        self.told: dict[tuple, np.ndarray] = {}

    def row(self, x: Node) -> Generator[tuple[Node, Node], int, np.ndarray]:
        """Weights of ``x`` with every node of the other list."""
        mine = shape, texts = self.xs[id(x)]
        if mine in self.told:
            return self.told[mine]
        common: dict[int, set[str]] = {}
        for t in {t for _, t in texts}:
            for n in self.having.get(t, ()):
                common.setdefault(n, set()).add(t)
        weights, free = np.zeros(len(self.forms), np.int64), np.ones(len(self.forms), bool)
        free[list(common)] = False
        for other, members in self.shapes.items():
            unlike = members[free[members]]
            if len(unlike):
                weights[unlike] = yield from self._known((shape, (), other, ()), x, self.one[int(unlike[0])])
        for n, both in common.items():
            other, theirs = self.forms[n]
            at, there = (tuple(p for p in places if p[1] in both) for places in (texts, theirs))
            weights[n] = yield from self._known((shape, at, other, there), x, self.one[n])
        if mine in self.again:
            self.told[mine] = weights[self.of]
        return weights[self.of]

    def _known(self, key: tuple, x: Node, y: Node) -> Generator[tuple[Node, Node], int, int]:
        if key not in self.memo:
            self.memo[key] = yield from _weight(x, y, self.memo)
        return self.memo[key]


def _rows(xs: list[Node], ys: list[Node], memo: dict) -> Callable[[Node], Generator[tuple[Node, Node], int, np.ndarray]]:
    """Tells the weights of an x with all ys; labels that are many on both sides go by form."""
    mine, theirs = {}, {}
    for nodes, by in ((xs, mine), (ys, theirs)):
        for k, n in enumerate(nodes):
            by.setdefault(n.label, []).append(k)
    forms = {
        label: _Forms([xs[i] for i in own], [ys[j] for j in theirs[label]], memo)
        for label, own in mine.items()
        if len(own) > 1 and len(theirs.get(label, ())) > 1
    }
    places = {label: np.array(own) for label, own in theirs.items()}

    def row(x: Node) -> Generator[tuple[Node, Node], int, np.ndarray]:
        weights = np.zeros(len(ys), np.int64)
        if x.label in forms:
            weights[places[x.label]] = yield from forms[x.label].row(x)
        else:
            for j in theirs.get(x.label, ()):
                weights[j] = yield from _weight(x, ys[j], memo)
        return weights

    return row


def _align(xs: list[Node], ys: list[Node], memo: dict) -> Steps:
    """The order-keeping match of two child lists with the largest weight."""
    head, tail = 0, 0
    while head < min(len(xs), len(ys)) and _same(xs[head], ys[head]):
        head += 1
    while tail < min(len(xs), len(ys)) - head and _same(xs[-1 - tail], ys[-1 - tail]):
        tail += 1
    pairs = []
    for i in (*range(head), *range(-tail, 0)):
        pairs.append((xs[i], ys[i], (yield from _weight(xs[i], ys[i], memo))))
    xs, ys = xs[head : len(xs) - tail], ys[head : len(ys) - tail]
    if not xs or not ys:
        return pairs
    # One row of the table at a time; of every cell two bits are kept, by which the match is read backwards.
    row, best, paired, above_as_good = _rows(xs, ys, memo), np.zeros(len(ys) + 1, np.int64), [], []
    for x in xs:
        weights = yield from row(x)
        with_x = np.where(weights > 0, best[:-1] + weights, 0)
        now = np.maximum.accumulate(np.maximum(best[1:], with_x))
        paired.append(np.packbits((weights > 0) & (now == with_x)))
        above_as_good.append(np.packbits(now == best[1:]))
        best[1:] = now
    bit = lambda bits, j: bits[j >> 3] >> (7 - (j & 7)) & 1
    i, j = len(xs), len(ys)
    while i and j:
        if bit(paired[i - 1], j - 1):
            i, j = i - 1, j - 1
            pairs.append((xs[i], ys[j], (yield from _weight(xs[i], ys[j], memo))))
        elif bit(above_as_good[i - 1], j - 1):
            i -= 1
        else:
            j -= 1
    return pairs


def match(a: Node, b: Node) -> list[tuple[Node, Node]]:
    """Texts of two pages that stand at matched nodes."""
    memo: dict = {}
    found, open_pairs = [], [(a, b)]
    while open_pairs:
        x, y = open_pairs.pop()
        if x.label == "#text":
            found.append((x, y))
        else:
            open_pairs += [(p, q) for p, q, _ in _run(_align(x.kids, y.kids, memo), memo)]
    return found


def articles(trees: list[Node], pages: Iterable[int]) -> dict[int, int]:
    """Pages by the article they mark: near copies, with half of their article's texts in common, have one number."""
    found: list[set[str]] = []
    number = {}
    for k in pages:
        own = {t.text for t in leaves(trees[k]) if t.main}
        like = (n for n, other in enumerate(found) if 2 * len(own & other) >= len(own | other))
        number[k] = next(like, len(found)) if own else -1
        if number[k] == len(found):
            found.append(own)
    return number


def template_texts(trees: list[Node]) -> list[set[int]]:
    """For each page the ids of its texts that belong to the template of the group.

    A text inside a marked article is template only if it stands in as many different
    articles as others must in different pages; near copies of an article are one.
    """
    told = [tuple(t.text for t in leaves(tree)) for tree in trees]
    different = {texts: k for k, texts in reversed(list(enumerate(told))) if texts}
    none: list[set[int]] = [set() for _ in trees]
    if len(different) < LEAST:
        return none
    shared = Counter(text for texts in different for text in set(texts))
    needed = max(LEAST, SHARE * len(different))
    if max(shared.values()) < needed:  # no text on so many pages, so no node can be constant
        return none
    common = lambda texts: sum(shared[t] >= needed for t in set(texts))
    reference = trees[max(different.values(), key=lambda k: (common(told[k]), -len(told[k]), -k))]
    support: Counter[int] = Counter()
    number = articles(trees, different.values())
    inside: dict[int, set[int]] = {}
    aligned = {}
    for texts, k in different.items():
        pairs = [(x, y) for x, y in match(reference, trees[k]) if x.text == y.text] if common(texts) else []
        aligned[texts] = pairs
        support.update({id(x) for x, _ in pairs})
        for x, y in pairs:
            if x.main or y.main:
                inside.setdefault(id(x), set()).add(number[k])
    told_apart = max(LEAST, SHARE * len(set(number.values())))
    constant = {node for node, n in support.items() if n >= needed and (node not in inside or len(inside[node]) >= told_apart)}
    for k, texts in enumerate(told):
        if texts:
            where = leaves(trees[k])
            first = {id(t): i for i, t in enumerate(leaves(trees[different[texts]]))}
            none[k] = {id(where[first[id(y)]]) for x, y in aligned[texts] if id(x) in constant}
    return none


def main_text(tree: Node, template: set[int]) -> str:
    """Texts of the slots, in page order: those of the article where one is marked."""
    texts = leaves(tree)
    inside = [t for t in texts if t.main] or texts
    slots = [t for t in inside if id(t) not in template]
    if not slots and any(t.main for t in inside):
        slots = inside
    return "\n\n".join(t.text for t in slots)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    host = F.coalesce(F.regexp_extract(F.lower("url"), r"^[a-z][a-z0-9+.-]*://([^/?#]*)", 1), F.lit(""))
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host.alias("host"))
    many = stage(rows.groupBy("host").agg(F.count("*").alias("n")).where(F.col("n") > GROUP))
    rows = rows.join(many, "host", "left")
    groups = F.ceil(F.coalesce("n", F.lit(1)) / GROUP)
    part = F.pmod(F.xxhash64("page_id", "url", F.octet_length("html")), groups)
    rows = rows.select("host", part.alias("part"), "page_id", "url", "html")

    def extracted(table: pa.Table) -> pa.Table:
        order = table.sort_by([("page_id", "ascending"), ("url", "ascending"), ("html", "ascending")])
        trees = [parse(html.as_py()) for html in order.column("html")]
        texts = [main_text(tree, known) for tree, known in zip(trees, template_texts(trees), strict=True)]
        return pa.table(
            {
                "page_id": order.column("page_id"),
                "url": order.column("url"),
                "text": pa.array(texts, pa.string()),
                "n_chars": pa.array([len(t) for t in texts], pa.int64()),
            }
        )

    key = pages.schema["page_id"].dataType.simpleString()
    return rows.groupBy("host", "part").applyInArrow(extracted, f"page_id {key}, url string, text string, n_chars long")
