"""Main text of web pages from a graphical model over the tree of blocks.

Every node of the tree is content or not.  A node has a potential from its features, and each parent and child share one.
Messages go up the tree and down again (sum-product), which gives the exact probability of every node; blocks that are
likelier content than not make up the text.  Potentials come from labelled pages: pages whose article is marked as such,
and the templates below, whose parts carry ``data-keep`` or ``data-drop``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placetally.llm.common import slices, texts_of
from placetally.llm.html_tree import TEXT, Tree

PAGE_BYTES = 4 << 20
# Bounds of the sample of labelled pages of the table: pages, and characters of each.
SAMPLE_PAGES = 200
SAMPLE_CHARS = 40_000

TAGS = (
    "#root html body main article section div header footer nav aside form p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tr td th"
    " blockquote pre figure figcaption fieldset button details summary address dialog menu"
).split() + [TEXT]
#: Kinds of names that authors give to parts of a page.
KINDS = {
    "advert": r"\b(?:ads?|adverts?|advertis\w*|banner|sponsor\w*|promo\w*|dfp|outbrain|taboola)\b",
    "menu": r"\b(?:nav\w*|menu\w*|breadcrumbs?|toc|pagination|pager|tabs?|skip|links?)\b",
    "foot": r"\b(?:footer|foot|copyright|colophon|legal|bottom)\b",
    "head": r"\b(?:header|masthead|topbar|top|logo|branding|search)\b",
    "side": r"\b(?:side\w*|aside|widgets?|rail|column|complementary)\b",
    "comment": r"\b(?:comments?|commentlist|replies|reply|disqus|respond|discussion|reviews?)\b",
    "notice": r"\b(?:cookies?|consent|gdpr|notices?|alerts?|warnings?|modal|popup|overlay|dialog|toast|paywall|newsletter\w*|subscribe\w*"
              r"|signup|login|register)\b",
    "share": r"\b(?:share|sharing|social|follow|tags?|related|recommend\w*|more|popular|trending|author|byline|meta)\b",
    "form": r"\b(?:forms?|contact|feedback|poll|survey|input)\b",
    "body": r"\b(?:article\w*|content|post\w*|entry|story|main|body|text|page|blog)\b",
}
_KINDS = [re.compile(k) for k in KINDS.values()]
# All kinds but "body", and the tags below.
_AGAINST = [k for k, kind in enumerate([*KINDS, "tag"]) if kind != "body"]
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])|[-_]+")
#: Tags that stand for a kind by themselves, for labels and for what is inherited.
OUTSIDE = {"nav", "footer", "header", "aside", "form", "button", "dialog", "menu"}

_LONG = "Some words that say a good deal about the matter, one after the other, as in a story that goes on. " * 3
_SHORT = "A line that says little."
_LINKS = "<ul><li><a href=/a>Home</a></li><li><a href=/b>News and more</a></li><li><a href=/c>About us</a></li></ul>"
_ARTICLE = (
    f"<h1>A heading of some words</h1><p>{_LONG}</p><p>{_SHORT}</p><h2>Part two</h2><p>{_LONG}</p><ul><li>one thing to note</li>"
    f"<li>another thing, said in more words than the first</li></ul><blockquote><p>{_SHORT}</p></blockquote><p>Yes.</p>"
)
# What else an article may have: pictures, tables, lists of terms, linked lines, text outside of paragraphs.
_RICH = (
    f"<h1>A heading</h1><div>{_LONG}<br><br>{_LONG}</div><figure><img src=a><figcaption>What one sees</figcaption></figure>"
    f"<p><a href=/x>A line that is one link</a></p><table><tr><th>Year</th><td>Sum</td></tr><tr><th>One</th><td>Two</td></tr></table>"
    f"<h3>Terms</h3><dl><dt>A term</dt><dd>What it means, in a few words</dd></dl><ol><li><a href=/y>first</a></li><li>{_SHORT}</li></ol>"
    f"<pre>some code</pre><section><h2>More of it</h2><p>{_LONG}</p></section><p>End.</p>"
)
# An article whose heading and lead stand in a header, and one whose parts stand bare among the others.
_HEADED = f"<header><h1>A heading of some words</h1><p>{_SHORT}</p></header><p>{_LONG}</p><p>{_SHORT}</p><p>{_LONG}</p>"
_BARE = (
    f"<h1 data-keep>A heading</h1><p data-keep>{_LONG}</p><p data-keep>{_SHORT}</p><p data-keep>{_LONG}</p><h2 data-keep>Part two</h2>"
    f"<p data-keep>{_LONG}</p>"
)
_COMMENTS = f"<h3>Comments</h3><ul><li><p>{_SHORT} I think so too.</p></li><li><p>{_LONG}</p></li></ul>"
_FORM = "<label>Name</label><input name=a><p>Leave your address and we write to you.</p><button>Send</button>"
#: Pages of which the parts are known: {names} are replaced by parts, with the names and tags of VARIANTS.
TEMPLATES = (
    "{header}{nav}{ad}{article}{footer}",
    "{notice}{header}{nav}<div>{article}{side}</div>{footer}",
    "{header}<div>{side}{article_comments}</div>{ad}{footer}",
    "{nav}{article_ad}{form}{comments}{footer}",
    "<table><tr><td>{nav}</td><td>{article}</td><td>{side}</td></tr></table>{footer}",
    "{header}{nav}<div><div>{article}</div>{comments}{side}</div>{form}{footer}{notice}",
    "{nav}{rich}{comments}{footer}",
    "{header}<div>{side}{rich}</div>{ad}{footer}",
    "{nav}{headed}{footer}",
    "{header}{nav}{headed}{comments}{footer}",
    "{header}{nav}{bare}{footer}",
    "{nav}{bare}{comments}{footer}",
    "{header}{nav}<main class=review-page>{bare}</main>{footer}",
    "{nav}<div class=page-with-sidebar>{headed}{side}</div>{footer}",
)
VARIANTS = (
    {"article": "article", "nav": "nav", "header": "header", "footer": "footer", "side": "aside", "ad": "div class=ad",
     "notice": "div class=cookie-notice", "comments": "section class=comments", "form": "form"},
    {"article": "div class=post-content", "nav": "div class=menu", "header": "div id=header", "footer": "div id=footer",
     "side": "div class=sidebar", "ad": "div class=advert", "notice": "div role=alert", "comments": "div id=comments",
     "form": "div class=newsletter-form"},
    {"article": "main", "nav": "ul class=nav", "header": "div class=masthead", "footer": "footer", "side": "div id=side-bar",
     "ad": "aside class=sponsor", "notice": "div class=consent-banner", "comments": "ol class=comment-list", "form": "form class=contact"},
    {"article": "div id=story", "nav": "nav class=breadcrumbs", "header": "header", "footer": "div class=site-footer",
     "side": "aside class=widget", "ad": "div id=ad-top", "notice": "section class=notice", "comments": "div class=discussion",
     "form": "form id=login"},
    {"article": "div", "nav": "div", "header": "div", "footer": "div", "side": "div", "ad": "div class=ads", "notice": "div class=popup",
     "comments": "div class=reviews", "form": "form"},
)


def _templates() -> Iterator[str]:
    inner = {
        "header": "<a href=/>The Site</a><p>Its motto</p>", "nav": _LINKS, "footer": f"<p>(c) The Site</p><a href=/t>Terms</a><p>{_SHORT}</p>",
        "side": f"<h3>Most read</h3>{_LINKS}<p>{_SHORT}</p>", "ad": f"<p>Buy this now. {_SHORT}</p>", "comments": _COMMENTS, "form": _FORM,
        "notice": f"<p>We use cookies. {_SHORT}</p><a href=/ok>Accept</a>",
    }
    for variant in VARIANTS:
        def part(kind: str, mark: str, content: str, variant=variant) -> str:
            return f"<{variant[kind]} data-{mark}>{content}</{variant[kind].split()[0]}>"

        parts = {k: part(k, "drop", v) for k, v in inner.items()}
        parts["article"] = part("article", "keep", _ARTICLE)
        parts["headed"] = part("article", "keep", _HEADED)
        parts["bare"] = _BARE
        parts["rich"] = part("article", "keep", _RICH)
        parts["article_comments"] = part("article", "keep", _ARTICLE + parts["comments"])
        parts["article_ad"] = part("article", "keep", f"<p>{_LONG}</p>{parts['ad']}{_ARTICLE}{parts['side']}<p>{_LONG}</p>")
        for page in TEMPLATES:
            yield f"<html><body>{page.format(**parts)}</body></html>"


def kinds_of(names: str) -> list[int]:
    words = _HUMP.sub(" ", names).lower()
    return [k for k, kind in enumerate(_KINDS) if kind.search(words)]


@dataclass
class Forest:
    """Trees of several pages in arrays, all levels by depth."""

    parent: np.ndarray
    levels: list[np.ndarray]
    x: np.ndarray


def forest(trees: list[Tree], blocks: list[dict[int, str]]) -> Forest:
    sizes = [len(t.tag) for t in trees]
    offset = np.cumsum([0, *sizes])
    n = int(offset[-1])
    parent = np.full(n, -1, np.int64)
    tag = np.empty(n, np.int64)
    kinds = np.zeros((n, len(KINDS) + 1), np.float32)
    chars, linked, marks, depth = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n, np.int64)
    index = {t: i for i, t in enumerate(TAGS)}
    cache: dict[str, list[int]] = {}
    for tree, text, base in zip(trees, blocks, offset):
        own = np.array(tree.parent)
        parent[base:base + len(own)] = np.where(own < 0, -1, own + base)
        tag[base:base + len(own)] = [index.get(t, len(TAGS)) for t in tree.tag]
        for i, (p, names, name) in enumerate(zip(tree.parent, tree.names, tree.tag)):
            depth[base + i] = depth[base + p] + 1 if p >= 0 else 0
            if names:
                if names not in cache:
                    cache[names] = kinds_of(names)
                kinds[base + i, cache[names]] = 1
            if name in OUTSIDE:
                kinds[base + i, -1] = 1
        for i, block in text.items():
            chars[base + i] = len(block)
            linked[base + i] = min(tree.linked[i], len(block))
            marks[base + i] = sum(map(block.count, ".,;!?"))
    titles = (tag == index["h1"]).astype(np.float64)
    order = np.argsort(depth, kind="stable")
    levels = np.split(order, np.flatnonzero(np.diff(depth[order])) + 1) if n else []
    for level in levels[:0:-1]:
        for values in (chars, linked, marks, titles):
            np.add.at(values, parent[level], values[level])
    whole = np.repeat(chars[offset[:-1]] if n else chars, sizes)
    # What a name says of a part with the page's title counts less the more of the page the part holds: a page is no
    # comment, while a long list of comments, which has no title, is one.
    rest = np.where(titles > 0, 1 - chars / np.maximum(whole, 1), 1).astype(np.float32)[:, None]
    kinds[:, _AGAINST] *= rest
    above = np.zeros_like(kinds)
    for level in levels[1:]:
        above[level] = np.maximum(above[parent[level]], kinds[parent[level]])
    tags = np.eye(len(TAGS) + 1, dtype=np.float32)[tag]
    inside = tags[np.maximum(parent, 0)] * (parent >= 0)[:, None]
    numbers = np.column_stack([
        np.ones(n), np.log1p(chars) / 8, chars / np.maximum(whole, 1), linked / np.maximum(chars, 1),
        np.minimum(marks / np.maximum(chars, 1) * 20, 2), np.minimum(depth, 12) / 12, chars == 0,
    ]).astype(np.float32)
    return Forest(parent, levels, np.concatenate([numbers, tags, inside, kinds, above], axis=1))


def labels_of(tree: Tree) -> np.ndarray:
    """Whether each node is content: its nearest marked ancestor (or itself) is an article or ``data-keep``.

    Below a mark of a template only marks count.  A header inside an article is
    part of it.
    """
    out = np.zeros(len(tree.tag), np.int64)
    marked = np.zeros(len(tree.tag), bool)
    for i, (p, tag, names, mark) in enumerate(zip(tree.parent, tree.tag, tree.names, tree.mark)):
        above = out[p] if p >= 0 else 0
        marked[i] = bool(mark) or (p >= 0 and marked[p])
        if mark:
            out[i] = mark == "keep"
        elif marked[i]:
            out[i] = above
        elif tag == "article":
            out[i] = 1
        elif tag == "header" and above:
            out[i] = 1
        elif tag in OUTSIDE or any(k < len(KINDS) - 1 for k in kinds_of(names)):
            out[i] = 0
        else:
            out[i] = above
    return out


@dataclass
class Model:
    weights: np.ndarray
    edge: np.ndarray

    def marginals(self, trees: Forest) -> np.ndarray:
        """Probability that each node is content, by messages from the leaves to the roots and back."""
        own = np.zeros((len(trees.parent), 2))
        own[:, 1] = np.clip(trees.x @ self.weights, -20, 20)
        up = own.copy()
        sent = np.zeros_like(own)
        for level in trees.levels[:0:-1]:
            # sum over the child's two states, for each state of the parent
            sent[level] = np.logaddexp(self.edge[:, 0] + up[level, :1], self.edge[:, 1] + up[level, 1:])
            np.add.at(up, trees.parent[level], sent[level])
        down = np.zeros_like(own)
        for level in trees.levels[1:]:
            rest = up[trees.parent[level]] + down[trees.parent[level]] - sent[level]
            down[level] = np.logaddexp(rest[:, :1] + self.edge[0], rest[:, 1:] + self.edge[1])
            down[level] -= down[level].max(axis=1, keepdims=True)
        belief = up + down
        return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -50, 50)))


def fit(pages: list[str]) -> Model:
    """Potentials from labelled pages: a logistic one of each node, and one of parent and child from their joint shares."""
    trees = [Tree(p) for p in pages]
    shape = forest(trees, [t.blocks() for t in trees])
    y = np.concatenate([labels_of(t) for t in trees])
    x = shape.x.astype(np.float64)
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -20, 20)))
        grad = x.T @ (y - p) - 0.5 * w
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + 0.5 * np.eye(len(w)), grad)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    child = np.flatnonzero(shape.parent >= 0)
    joint = np.ones((2, 2))
    np.add.at(joint, (y[shape.parent[child]], y[child]), 1)
    joint /= joint.sum()
    edge = np.log(joint) - np.log(joint.sum(axis=1, keepdims=True)) - np.log(joint.sum(axis=0, keepdims=True))
    return Model(w, edge)


def fit_on(pages: DataFrame, sample: int = SAMPLE_PAGES, chars: int = SAMPLE_CHARS) -> Model:
    """A model from the templates and from the pages with an article that have the least hashes of their ids.

    Ids are chosen first, so that of pages only those of the sample move.  Of
    several pages with one id the one of least hash counts.
    """
    marked = pages.select(
        F.xxhash64("page_id").alias("h"), "page_id", F.col("html").cast("string").alias("html")
    ).filter("page_id is not null and html like '%<article%</article>%'")
    chosen = marked.select("h", "page_id").distinct().orderBy("h", "page_id").limit(sample)
    page = F.struct(F.xxhash64("html").alias("of_page"), F.substring("html", 1, chars).alias("html"))
    rows = marked.join(F.broadcast(chosen), ["h", "page_id"]).groupBy("h", "page_id").agg(F.min(page).alias("page"))
    return fit([*_templates(), *(r["html"] for r in rows.orderBy("h", "page_id").select("page.html").collect())])


def texts(pages: list[str], model: Model) -> list[str]:
    """Main text of each page: blocks that are likelier content than not, in page order."""
    trees = [Tree(p) for p in pages]
    blocks = [t.blocks() for t in trees]
    shape = forest(trees, blocks)
    likely = model.marginals(shape)
    out, base = [], 0
    for tree, own in zip(trees, blocks):
        out.append("\n\n".join(own[i] for i in sorted(own) if likely[base + i] > 0.5))
        base += len(tree.tag)
    return out


def _extracted(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 200):
            for piece in slices(batch.slice(start, 200), "html", PAGE_BYTES):
                found = texts([x.decode() for x in texts_of(piece.column("html"))], model)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("page_id"), piece.column("url"), pa.array(found), pa.array([len(t) for t in found], pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )


def main_text(pages: DataFrame, model: Model) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages``; null and blank pages have an empty text.

    Blocks are joined by two line ends; inside a block white space is one
    blank, and character references are decoded.  Repeated pages stay repeated.
    """
    kind = pages.schema["page_id"].dataType.simpleString()
    some = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return some.mapInArrow(partial(_extracted, model=model), f"page_id {kind}, url string, text string, n_chars long")
