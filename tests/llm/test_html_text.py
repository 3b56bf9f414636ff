import time

import numpy as np
import pytest

from placetally.llm import html_text
from placetally.llm.html_tree import Tree

STORY = "It was a long day in the valley, and nobody came to see what had been done there, though all had heard of it. " * 3


@pytest.fixture(scope="module")
def model():
    return html_text.fit(list(html_text._templates()))


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{a:b}}</style></head><body>{body}</body></html>"


def test_main_text_of_several_layouts(model):
    menu = "<ul><li><a href='/'>Home</a></li><li><a href='/x'>Sport</a></li></ul>"
    layouts = [
        f"<nav>{menu}</nav><article><h1>A &amp; B</h1><p>{STORY}<br>x\n\ty</p><script>var a='</p>';</script><p>No<b>w</b></p></article><footer>&copy; me</footer>",
        f"<div class='menu'>{menu}</div><div class=post-content><h1>A &amp; B</h1><p>{STORY}<br>x y<p>No<b>w</p></div><div id=comments><p>{STORY}</p></div>",
        f"<header>{menu}</header><main><h1>A & B</h1><p>{STORY} x  y</p><p>Now</p></main><aside class=widget>{menu}<p>Ad</p></aside><form><p>Mail</p></form>",
    ]
    for body in layouts:
        assert html_text.texts([page(body)], model) == [f"A & B\n\n{' '.join(STORY.split())} x y\n\nNow"]


def test_marginals_equal_full_enumeration(model):
    tree = Tree("<div><p>one</p><div class=menu><a>two</a></div></div>")
    shape = html_text.forest([tree], [tree.blocks()])
    n = len(tree.tag)
    own = np.clip(shape.x @ model.weights, -20, 20)
    states = (np.arange(1 << n)[:, None] >> np.arange(n)) & 1
    energy = states @ own + sum(model.edge[states[:, p], states[:, i]] for i, p in enumerate(tree.parent) if p >= 0)
    weight = np.exp(energy - energy.max())
    assert model.marginals(shape) == pytest.approx(weight @ states / weight.sum())


def test_broken_pages(model):
    for text in ("", "<", "<p", "</div></p>", "<!-- open", "<script>x", "a < b", "<table><td>x<tr>y</table>", "<ul><li>a<li>b", "<p>" * 300 + "x" + "<div>" * 300):
        html_text.texts([text], model)
    tree = Tree("<ul><li>a &lt; <i>b</i><li>c</ul>d<br>e<p>f<div>g</div>h<!-- no --><svg><p>z</svg>")
    assert list(tree.blocks().values()) == ["a < b", "c", "d e", "f", "g", "h"]
    assert html_text.texts([""], model) == [""]


def test_awkward_pages(spark):
    rows = [(1, "u", page(f"<article><p>{STORY}</p></article>")), (2, None, None), (3, "u", ""), (None, "u", "<p>x"), (4, "u", page("<article>" + f"<p>{STORY}</p>" * 3_000 + "</article>"))]
    pages = spark.createDataFrame([(*r, "mine", "mine") for r in rows], "page_id long, url string, html string, text string, n_chars string")
    pages = pages.union(pages.filter("page_id = 1"))
    model = html_text.fit_on(pages)
    got = html_text.main_text(pages, model).collect()
    by_id = {r.page_id: r for r in got}
    assert len(got) == 6 and by_id[1].text == STORY.strip() and by_id[2].text == by_id[3].text == "" and by_id[4].text.count("\n\n") == 2_999
    assert all(r.n_chars == len(r.text) for r in got)
    assert html_text.main_text(pages.limit(0), html_text.fit_on(pages.limit(0))).count() == 0


def test_broken_pages_take_linear_time():
    model = html_text.fit(list(html_text._templates()))
    for piece, n in (("<a ", 300_000), ("<div>", 60_000), ("<p><table><div>", 20_000), ("<button>x", 60_000), ("<head>", 100_000)):
        started = time.time()
        html_text.texts([piece * n], model)
        assert time.time() - started < 60, piece


def test_unended_parts_and_buttons():
    assert list(Tree("<p>one</p><!-- two").blocks().values()) == ["one"]
    assert list(Tree("<p>one</p>x <![CDATA[two > <b").blocks().values()) == ["one", "x two > <b"]
    assert list(Tree("<p>one <button>press</button>two</p><button>three").blocks().values()) == ["one two", "three"]
    assert list(Tree("<p>one<table><tr><td>two<p>three<div>four").blocks().values()) == ["one", "two", "three", "four"]


TEMPLATE_MODEL = html_text.fit(list(html_text._templates()))
P = "A fairly long paragraph that tells about the matter at hand, with commas, and goes on for some time. " * 3
NAV = "<nav><ul><li><a href=/>Home</a></li><li><a href=/a>About</a></li></ul></nav>"
FOOT = "<footer><p>(c) 2020 Site. All rights.</p></footer>"
LAYOUTS = {
    "misleading name": (f"<main class='review-page'><h1>Title</h1><p>{P}</p><p>{P}</p></main>", ["Title", P, P]),
    "header in article": (f"<article><header><h1>Title</h1><p>The lead.</p></header><p>{P}</p><p>{P}</p></article>", ["Title", "The lead.", P, P]),
    "bare paragraphs": (f"<h1>Title</h1><p>{P}</p><p>{P}</p><p>{P}</p>", ["Title", P, P, P]),
    "button in article": (f"<article><h1>Title</h1><p>{P}</p><button>Press</button><p>{P}</p></article>", ["Title", P, P]),
    "more comments than text": (
        f"<article><h1>Title</h1><p>{P}</p></article><section class='comments'><h3>Comments</h3><ul>" + f"<li><p>{P}</p></li>" * 6 + "</ul></section>",
        ["Title", P],
    ),
}


@pytest.mark.parametrize("layout", LAYOUTS)
def test_layouts(layout):
    body, parts = LAYOUTS[layout]
    page = f"<html><body>{NAV}{body}{FOOT}</body></html>"
    assert html_text.texts([page], TEMPLATE_MODEL)[0].split("\n\n") == [x.strip() for x in parts]


def test_sample_of_repeated_pages_is_one_of_each_id(spark):
    page = f"<article><h1>Title</h1><p>{P}</p></article>"
    rows = [(1, page)] * 50 + [(1, page.replace("Title", "Other")), (2, page), (None, page), (3, None), (4, "<p>no mark</p>")]
    pages = spark.createDataFrame(rows, "page_id long, html string")
    whole, one = (html_text.fit_on(p).weights for p in (pages, pages.filter("page_id <= 2").dropDuplicates(["page_id", "html"]).repartition(3)))
    assert (whole == one).all()
    assert (html_text.fit_on(pages.limit(0)).weights == TEMPLATE_MODEL.weights).all()
