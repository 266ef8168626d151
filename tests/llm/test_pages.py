"""Main text of pages: blocks against a parser of its own, pages labelled by hand, and the field's own arithmetic."""

from __future__ import annotations

import itertools
import re
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from conftest import SF_DIR
from pages import LAST, LONG, MORE, PAGES, Plain, marked

from shelflake.llm import html_extract
from shelflake.llm.html_blocks import leaf_blocks


@pytest.fixture(scope="module")
def field():
    return html_extract.trained()


@pytest.fixture(scope="module")
def given_pages():
    return [r["html"] for r in pq.read_table(f"{SF_DIR}/pages.parquet").to_pylist() if r["html"]]


@pytest.mark.parametrize("name", PAGES)
def test_blocks_are_those_of_another_parser(name):
    assert [b.text for b in leaf_blocks(PAGES[name])] == [text for text, _ in Plain(PAGES[name]).found]


def test_blocks_of_the_given_pages(given_pages):
    for page in given_pages:
        assert [b.text for b in leaf_blocks(page)] == [text for text, _ in Plain(page).found]


@pytest.mark.parametrize("name", PAGES)
def test_pages_labelled_by_hand(field, name):
    expected = Counter(marked(PAGES[name]))
    found = Counter(html_extract.main_text(PAGES[name], field)[0].split("\n"))
    right = sum((expected & found).values())
    assert 2 * right / (expected.total() + found.total()) >= 0.95, (expected - found, found - expected)


def test_the_given_pages_articles(field, given_pages):
    """All of them hold one article and nothing else of worth."""
    for page in given_pages:
        article = re.search("<article.*?</article>", page, re.S)
        lines = [text for text, _ in Plain(article[0]).found]
        assert html_extract.main_text(page, field)[0] == "\n".join(lines)


PAGE = f"""<nav><ul><li><a href="/">Home</a></li></ul></nav><article><h1>The title of it</h1><p>{LONG}</p>
<p>Short.</p><p>{MORE}</p></article><footer>&copy; 2020 x</footer>"""
TEXT = f"The title of it\n{LONG}\nShort.\n{MORE}"


@pytest.mark.parametrize(
    "page",
    [
        *(f'<body class="{c}">{PAGE}</body>' for c in ("comments-open", "no-sidebar", "has-ads", "header-fixed")),
        f'<html id="menu" class="ads"><body>{PAGE}</body></html>',
        f"<body><form>{PAGE}</form></body>",
        f'<body><div class="wrapper has-comments">{PAGE}</div></body>',
        PAGE.replace("<h1>", "<header><h1>").replace("</h1>", "</h1></header>"),
        PAGE.replace("<p>Short.", '<ul><li><a href="1">One</a><li><a href="2">Two</a></ul><p>Short.'),
        PAGE.replace("<p>Short.", '<div class="share"><a href="1">Share</a></div><p>Short.'),
        PAGE.replace("<p>Short.", f'<section class="comments"><p>{LAST}</p></section><p>Short.'),
        PAGE + f'<div class="kommentare"><p>{LAST}</p></div><div class="werbung">Jetzt kaufen, nur heute.</div>',
        PAGE.replace("<footer>", "<svg><svg><text>in</text></svg><text>out</text></svg><footer>"),
        "<select><option>a<option>b" + PAGE,
        "<svg><path d='x'>" + PAGE,
        PAGE.replace("</article>", "<template><p>not shown</p></template><object>nor this</object></article>"),
    ],
)
def test_articles_that_used_to_be_lost(field, page):
    assert html_extract.main_text(page, field)[0] == TEXT


@pytest.mark.parametrize(
    "page, expected",
    [
        ("<p>a <label>b</label> <button>c</button><output>d</output> <x-y>e</x-y> <math><mi>f</mi></math></p>", ["a b cd e f"]),
        ("<p>a<script>x</script>b<svg><text>x</text></svg>c</p>", ["abc"]),
        ("<p>&am<b>p;</b> &amp<i>;</i></p>", ["&amp; &;"]),
        ("<template><div>x<template>y</template></div></template><p>z", ["z"]),
        ("<div><template>x</div><p>z", ["z"]),
        ("<head><title>t</title><p>z", ["z"]),
        ("<svg/><p>a<svg/>b", ["ab"]),
    ],
)
def test_blocks_of_odd_markup(page, expected):
    assert [b.text for b in leaf_blocks(page)] == expected


def test_decoding_finds_the_best_labels():
    """Against all sequences of labels, with weights drawn at random."""
    source = np.random.default_rng(3)
    pages = [page for page, _ in html_extract.labelled_pages(40, seed=5)]
    names = sorted({f for p in pages for b in leaf_blocks(p) for f in html_extract.features(b, 1, 3)})
    for page in pages:
        blocks = leaf_blocks(page)[:9]
        weights = dict(zip(names, source.normal(0, 1, len(names))))
        steps, start = source.normal(0, 2, (2, 2)), source.normal(0, 1, 2)
        field = html_extract.Field(weights, steps, start)
        held = [sum(weights.get(f, 0.0) for f in html_extract.features(b, i, len(blocks))) for i, b in enumerate(blocks)]

        def score(labels):
            moves = sum(steps[a, b] for a, b in zip(labels, labels[1:]))
            return sum(h for h, label in zip(held, labels) if label) + moves + start[labels[0]]

        if blocks:
            best = max(score(labels) for labels in itertools.product((0, 1), repeat=len(blocks)))
            assert score(field.decode(blocks)) == pytest.approx(best)


def test_likelihood_and_gradient():
    """The likelihood against a sum over all labels, the gradient against differences."""
    source = np.random.default_rng(4)
    names = ["a", "b", "c"]
    chains = [
        ([[n for n in names if source.random() < 0.6] for _ in range(size)], source.integers(0, 2, size).tolist())
        for size in (1, 3, 5, 4)
    ]
    problem = html_extract.Problem(chains)
    weights = source.normal(0, 1, problem.size)
    value, gradient = problem.value_and_gradient(weights)
    of = {name: weights[i] for name, i in problem.numbers.items()}
    n = len(of)

    def score(found, labels):
        held = sum(of[f] for fs, label in zip(found, labels) if label for f in fs)
        moves = sum(weights[n + 2 * a + b] for a, b in zip(labels, labels[1:]))
        return held + moves + weights[-2 + labels[0]]

    expected = sum(
        score(found, labels)
        - np.log(sum(np.exp(score(found, other)) for other in itertools.product((0, 1), repeat=len(labels))))
        for found, labels in chains
    )
    assert value == pytest.approx(expected)
    for i in range(problem.size):
        step = np.zeros(problem.size)
        step[i] = 1e-5
        difference = problem.value_and_gradient(weights + step)[0] - problem.value_and_gradient(weights - step)[0]
        assert gradient[i] == pytest.approx(difference / 2e-5, abs=1e-6)
