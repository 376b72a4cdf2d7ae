"""Pages whose markup is long, never closed, or holds text inside formulas and objects."""

import itertools
import random
import time

import pytest

from ledgerlake.llm import html_mincut as hm

WORDS = "one of the many words that stand in this plain sentence of an article."


def test_text_of_formulas_and_fallbacks_stays():
    page = (f"<html><body><article><p>Then <math><mi>E</mi><mo>=</mo><mi>m</mi></math> holds. {WORDS}</p>"
            f"<object data=film><p>The film shows {WORDS}</p></object><canvas>A drawing of {WORDS}</canvas></article></body></html>")
    assert hm.main_text(page) == f"Then E=m holds. {WORDS}\nThe film shows {WORDS}\nA drawing of {WORDS}"


def test_annotations_are_markup():
    page = f"<article><p>Then <math><semantics><mi>x</mi><annotation encoding=tex>\\x</annotation></semantics></math> holds. {WORDS}</p></article>"
    assert hm.main_text(page) == f"Then x holds. {WORDS}"


N = 20_000
LONG = {
    "unclosed b, then end tags of i": "<b>" * N + "</i>" * N,
    "unclosed b, then headings": "<html><body>" + "<b>" * N + "<h2>x" * N,
    "unclosed b, then rules": "<b>" * N + "x<hr>" * N,
    "stray end tags in a container": "<p><div>" + "<b>" * N + "</p>" * N,
    "tags without an end": "<b " * 50_000,
    "open quotes": '<a ">' * 50_000 + "x",
    "undecided blocks": "".join(f"<div>{random.Random(k).choice(['ab cd', 'ab cd ef gh i.', 'x y'])}</div>" for k in range(N)),
}


@pytest.mark.parametrize("name", LONG)
def test_work_follows_the_page(name):
    began = time.process_time()
    hm.main_text(LONG[name])
    assert time.process_time() - began < 6  # seconds; a search of the stack for every tag takes 50 and more


def test_comment_that_never_closes_takes_the_rest():
    assert hm.main_text(f"<article><p>{WORDS}</p><!-- gone <p>{WORDS}</p> too") == WORDS
    assert hm.main_text(f"<article><p>{WORDS}</p><!-- gone") == WORDS


def cut_cost(sides, terminal, edges):
    cost = sum(-t if s and t < 0 else t if not s and t > 0 else 0 for s, t in zip(sides, terminal))
    return cost + sum(w for (i, j), w in edges.items() if sides[i] != sides[j])


def test_cut_is_the_cheapest_of_all():
    rnd = random.Random(3)
    for _ in range(150):
        n = rnd.randint(1, 9)
        terminal = [rnd.choice([-2.0, -0.75, -0.25, 0.0, 0.25, 0.5, 1.5]) for _ in range(n)]
        edges = {(i, j): rnd.choice([0.25, 0.5, 1.0]) for i in range(n) for j in range(i + 1, n) if rnd.random() < 0.4}
        got = hm.min_cut(terminal, edges)
        assert cut_cost(got, terminal, edges) == min(cut_cost(s, terminal, edges) for s in itertools.product([False, True], repeat=n))
