"""Long child lists are matched like short ones: no bound above which another match is taken."""

import random

import numpy as np
from stayline.llm import wrappers


def best_of_flat_lists(mine, theirs):
    """Weight of the best match of two lists of ``<li><p>`` with one text each, by the plain table."""
    best = np.zeros(len(theirs) + 1, int)
    theirs = np.array(theirs)
    for text in mine:
        weights = 2 + np.where(theirs == text, wrappers.EQUAL_TEXT, 1)
        best[1:] = np.maximum.accumulate(np.maximum(best[1:], best[:-1] + weights))
    return best[-1]


def test_long_lists_have_the_best_match():
    rng = random.Random(8)
    # no text occurs once, and the equal ones stand far from each other's places
    mine, theirs = ([f"t{rng.randrange(60)}" for _ in range(n)] for n in (700, 650))
    a, b = (wrappers.parse("<ul>" + "".join(f"<li><p>{t}</p></li>" for t in own) + "</ul>") for own in (mine, theirs))
    found = wrappers.match(a, b)
    order = [{id(t): k for k, t in enumerate(wrappers.leaves(tree))} for tree in (a, b)]
    places = sorted((order[0][id(x)], order[1][id(y)]) for x, y in found)
    assert all(i < k and j < m for (i, j), (k, m) in zip(places, places[1:]))
    got = sum(2 + wrappers.EQUAL_TEXT if mine[i] == theirs[j] else 3 for i, j in places)
    assert got == best_of_flat_lists(mine, theirs)


def test_long_and_short_lists_are_matched_by_one_rule():
    # a short list and the same one among many: what is matched must not change with the others
    items = [f"<li><p>{k}</p><p>Read more</p></li>" for k in "caba"]
    pad = "".join(f"<li><blockquote>left {k}</blockquote></li>" for k in range(600))
    told = lambda one, two: {(x.text, y.text) for x, y in wrappers.match(*map(wrappers.parse, (one, two))) if x.text == y.text}
    short = told(f"<ul>{''.join(items)}</ul>", f"<ul>{''.join(items[1:])}</ul>")
    long = told(f"<ul>{''.join(items)}{pad}</ul>", f"<ul>{''.join(items[1:])}{pad.replace('left', 'right')}</ul>")
    assert short == long == {("a", "a"), ("b", "b"), ("Read more", "Read more")}
