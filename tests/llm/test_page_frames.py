"""Extraction where names mislead, from deep pages, and its ratios by a plain version."""

from __future__ import annotations

import math
import random
import time

import pytest

from bindery.llm import html

TEXT = "Some plain sentence, with words. " * 8
BODY = TEXT.strip()


@pytest.mark.parametrize(
    "page",
    [
        f"<body><div id=page class='site has-sidebar'><h1>Title</h1><p>{TEXT}</div>",
        f"<body><div class='layout no-sidebar'><article><h1>Title</h1><p>{TEXT}</article></div>",
        f"<body><div class='sidebar-layout'><main><h1>Title</h1><p>{TEXT}</main></div>",
        f"<body><article><div class='entry-header'><h1>Title</h1></div><p>{TEXT}</article>",
        f"<body><div class='menu-page'><div class=menu>One Two</div><h1>Title</h1><p>{TEXT}</div>",
        f"<article><h1>Title</h1><ul class=c7><li><a>One</a><li><a>Two</a><li><a>Three</a></ul><p>{TEXT}",
        f"<article><h1>Title</h1><p>{TEXT}</p><div class=comments>{'<p>Nice, I think.</p>' * 20}</div>",
    ],
)
def test_names_do_not_cost_the_article(page):
    assert html.main_text(page) == f"Title\n\n{BODY}"


def test_linked_prose_stays():
    links = "".join(f"<p><a href=/{i}>Linked sentence {i}.</a></p>" for i in range(5))
    text = html.main_text(f"<article><h1>Title</h1><p>{TEXT}</p>{links}</article>")
    assert text.split("\n\n")[2:] == [f"Linked sentence {i}." for i in range(5)]


@pytest.mark.parametrize("tag", ["div", "span", "li", "table", "b", "section"])
def test_open_elements_take_linear_time(tag):
    start = time.process_time()
    text = html.main_text(f"<{tag}>two words " * 100_000)
    assert text.count("two words") == 100_000
    assert time.process_time() - start < 10


def test_ratios_are_those_of_a_plain_version():
    r = random.Random(5)
    nodes = []
    for i in range(200):
        path, linked = r.choice([(1, False), (2, True), (3, False), (3, True)])
        text = " ".join(r.choice(["a", "word,", "end.", ""]) for _ in range(r.randrange(9)))
        nodes.append(html.Node(i, path, 0, linked, False, False, text))
    plain = []
    for node in nodes:
        own = [n for n in nodes if n.path == node.path]
        chars = sum(len(n.text.strip()) for n in own)
        unlinked = sum(len(n.text.strip()) for n in own if not n.linked) / chars if chars else 0
        marks = sum(c in ",." for n in own for c in n.text)
        plain.append((chars / len(own) * unlinked, 1 + marks / len(own) * unlinked))
    fused = html.fused_ratios(nodes)
    for i in range(len(nodes)):
        near = [(j, math.exp(-0.5 * (i - j) ** 2 / html.SIGMA**2)) for j in range(i - 3, i + 4)]
        near = [(j, w) for j, w in near if 0 <= j < len(nodes)]
        text, marks = (
            sum(plain[j][k] * w for j, w in near) / sum(w for _, w in near) for k in (0, 1)
        )
        assert fused[i] == pytest.approx(math.sqrt(text * marks))
