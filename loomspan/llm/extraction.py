"""Operator 1: main-text extraction by a tree-structured graphical model.

A page becomes a tree of block elements. Each node is content or not: a unary
potential comes from its tag, its names, its links and its text, and a
parent-child potential from both labels and from what kind of edge it is.
Sum-product messages, upward and then downward, give each node's marginal; the
weights are fitted by gradient ascent on the likelihood of labelled pages,
whose expected features come from the same messages. Text of the blocks that
are more likely content than not is joined in page order.

Labelled pages are made here, from layouts with articles, menus, headers,
footers, sidebars, notices, adverts, forms and comments (:func:`layout_pages`);
others can be given to :func:`fit`.

Nulls: a null or empty html has an empty text; null ids and urls pass through.
Repeated rows are read each; empty tables give empty results; extra columns
are ignored.
"""

from __future__ import annotations

import html as html_
import random
import re
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_batches

# HTML's element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template iframe noembed noframes head title textarea".split())
INLINE = frozenset("math mi mo mn ms mtext mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mstyle semantics svg g text tspan object canvas audio video noscript a abbr acronym b bdi bdo big cite code data dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var del wbr img".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}}

#: Where markup may begin, and a tag's attributes up to its end: quoted values may hold any character.
_START = re.compile(r"<(?:!--|[!?]|/?[a-zA-Z])")
_TAG_NAME = re.compile(r"[^\s/>]+")
_ATTRIBUTES = re.compile(r"[^>\"']*+(?:\"[^\"]*+\"[^>\"']*+|'[^']*+'[^>\"']*+)*+>")
_NAMES = re.compile(r"\b(?:class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"\bhidden\b(?!\s*=\s*[\"']?(?:false|until))|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_PARTS = re.compile(r"[a-z]+")
_SPLIT = re.compile(r"(?<=[a-z])(?=[A-Z])")

#: Word stems in class, id and role, by what they say.
HINTS = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc tabs skip toolbar sitemap share sharing social print tools".split(),
    "head": "header masthead topbar banner branding logo hero".split(),
    "foot": "footer copyright colophon legal bottom credits".split(),
    "side": "sidebar side aside rail widget widgets related recommended recommendations popular trending teaser secondary complementary also".split(),
    "note": "cookie cookies consent gdpr notice alert popup modal overlay dialog announcement disclaimer warning message toast".split(),
    "ad": "ad ads advert adverts advertisement sponsor sponsored promo promotion adsense banner affiliate".split(),
    "form": "form search login signup subscribe subscription newsletter register contact input".split(),
    "talk": "comment comments reply replies respond response discussion disqus thread review reviews feedback".split(),
    "meta": "byline author meta tags tag date timestamp rating".split(),
    "body": "article content main post entry story body text page prose copy markdown blog hentry".split(),
}
_HINT = {w: k for k, words in HINTS.items() for w in words}
TAGS = {
    "nav": "menu", "menu": "menu", "header": "head", "footer": "foot", "aside": "side", "dialog": "note", "form": "form", "button": "form", "fieldset": "form", "select": "form", "article": "article", "main": "main",
    "p": "p", "blockquote": "p", "pre": "p", "h1": "h", "h2": "h", "h3": "h", "h4": "h", "h5": "h", "h6": "h", "ul": "list", "ol": "list", "dl": "list", "li": "item", "dd": "item", "dt": "item", "table": "table", "td": "cell", "th": "cell", "section": "section", "figure": "figure", "figcaption": "figure", "div": "div", "body": "top", "html": "top",
}
FEATURES = ["bias", *sorted({f"tag:{v}" for v in TAGS.values()} | {"tag:other"}), *[f"name:{k}" for k in HINTS], "links:some", "links:most", "text:none", "text:short", "text:long", "text:stops", "page:all", "page:half", "hidden"]
_FEATURE = {f: k for k, f in enumerate(FEATURES)}
#: Kinds of edges: an ordinary child, a child that names what it is, and the children of article and main.
EDGES = ["plain", "named", "inside"]


@dataclass
class Node:
    tag: str
    names: str = ""
    parent: int = -1
    hidden: bool = False
    #: (position in the page, text) of the node's own text.
    texts: list[tuple[int, str]] = field(default_factory=list)
    chars: int = 0
    linked: int = 0
    stops: int = 0


def parse(page: str | None) -> list[Node]:
    """The page's block elements, parents before children; raw elements are left out with all that is in them, of one without an end tag only the start tag.

    A tag with a quote that never closes ends at the next ``>``. Markup that no
    ``>`` follows any more is all that is left of the page. Each character is
    looked at a few times, whatever the page.
    """
    nodes = [Node("html")]
    stack: list[tuple[str, int]] = [("html", 0)]  # all open elements, with the block each belongs to
    buffer: list[str] = []
    page = page or ""
    place = at = 0
    links = 0
    endless: set[str] = set()  # raw tags that no end tag follows any more

    def flush(block: int) -> None:
        nonlocal place
        if buffer:
            text = " ".join("".join(buffer).split())
            buffer.clear()
            if text:
                nodes[block].texts.append((place, text))
                nodes[block].chars += len(text)
                nodes[block].stops += sum(text.count(c) for c in ".,;!?")
                place += 1

    def add(raw: str) -> None:
        if raw:
            text = html_.unescape(raw)
            buffer.append(text)
            if links:
                nodes[stack[-1][1]].linked += len(" ".join(text.split()))

    # Depths of the open elements by tag, and of those that are blocks.
    opened: dict[str, list[int]] = {"html": [0]}
    blocks = [0]

    def push(tag: str, block: int) -> None:
        opened.setdefault(tag, []).append(len(stack))
        if tag not in INLINE:
            blocks.append(len(stack))
        stack.append((tag, block))

    def close(depth: int) -> None:
        nonlocal links
        while len(stack) > depth:
            tag, block = stack.pop()
            opened[tag].pop()
            links -= tag == "a"
            if tag not in INLINE:
                blocks.pop()
                flush(block)

    def deepest(tags) -> int:
        return max((opened[t][-1] for t in tags if opened.get(t)), default=0)

    size, last = len(page), page.rfind(">")
    no_body = False

    def tag_end(at: int) -> int:
        """Just behind the tag whose attributes begin at ``at``."""
        found = _ATTRIBUTES.match(page, at)
        if found:
            return found.end()
        return page.index(">", at) + 1

    while at < size:
        found = _START.search(page, at)
        if not found:
            add(page[at:])
            break
        add(page[at : found.start()])
        kind = found[0]
        if kind == "<!--":
            end = page.find("-->", found.end())
            at = size if end < 0 else end + 3
            continue
        if found.start() > last:
            break
        if kind in ("<!", "<?"):
            at = page.index(">", found.end()) + 1
            continue
        name = _TAG_NAME.match(page, found.end() - 1)
        tag = name[0].lower()
        at = tag_end(name.end())
        given = page[name.end() : at - 1]
        if kind[1] == "/":
            if tag == "br":
                flush(stack[-1][1])
                continue
            depth = deepest([tag])
            if depth and (tag not in INLINE or depth > blocks[-1]):  # an inline end tag doesn't close blocks
                close(depth)
        else:
            if tag in RAW:
                if not given.endswith("/"):
                    end = None if tag in endless else re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                    if not end:
                        endless.add(tag)
                    if tag == "head":  # as far as the body, even if it isn't closed
                        body = None if no_body else re.compile(r"<body\b", re.I).search(page, at)
                        no_body = not body
                        if end or body:
                            at = min(end.end() if end else size, body.start() if body else size)
                    else:
                        at = end.end() if end else at
                continue
            if tag in VOID:
                if tag in ("br", "hr"):
                    flush(stack[-1][1])
                continue
            if tag in CLOSES_P and stack[blocks[-1]][0] == "p":
                close(blocks[-1])
            if tag in SIBLINGS and (depth := deepest(SIBLINGS[tag])) > deepest(SCOPES[tag]):
                close(depth)
            block = stack[-1][1]
            if tag not in INLINE:
                flush(block)
                names = " ".join(filter(None, (x for m in _NAMES.findall(given) for x in m))) if given else ""
                nodes.append(Node(tag, names, block, bool(given and _HIDDEN.search(given))))
                block = len(nodes) - 1
            if not given.endswith("/"):
                push(tag, block)
                links += tag == "a"
    flush(stack[-1][1])
    close(1)
    return nodes


def describe(nodes: list[Node]) -> tuple[list[list[int]], list[int]]:
    """Each node's active features and the kind of the edge to its parent."""
    features, edges = [], []
    below = [n.chars for n in nodes]
    linked = [n.linked for n in nodes]
    for k in range(len(nodes) - 1, 0, -1):
        below[nodes[k].parent] += below[k]
        linked[nodes[k].parent] += linked[k]
    plain = below[0] - linked[0]
    for k, n in enumerate(nodes):
        on = [_FEATURE["bias"], _FEATURE[f"tag:{TAGS.get(n.tag, 'other')}"]]
        hints = {_HINT[w] for w in _PARTS.findall(_SPLIT.sub(" ", n.names).lower()) if w in _HINT} if n.names else set()
        on += [_FEATURE[f"name:{h}"] for h in sorted(hints)]
        share = linked[k] / below[k] if below[k] else 0
        on += [_FEATURE["links:most"]] if share > 0.6 else [_FEATURE["links:some"]] if share > 0.25 else []
        on += [_FEATURE["text:none" if not n.chars else "text:short" if n.chars < 40 else "text:long"]] + [_FEATURE["text:stops"]] * (n.stops > 1)
        # How much of the page's unlinked text is the node's own.
        own = (n.chars - n.linked) / plain if plain > 0 else 0
        on += [_FEATURE["page:all"]] if own > 0.9 else [_FEATURE["page:half"]] if own > 0.4 else []
        on += [_FEATURE["hidden"]] * n.hidden
        features.append(on)
        named = bool(hints - {"body", "meta"}) or n.tag in ("nav", "header", "footer", "aside", "form", "dialog")
        edges.append(1 if named else 2 if k and nodes[n.parent].tag in ("article", "main") else 0)
    return features, edges


@dataclass
class Model:
    """unary: a weight per feature for content; pair: a log potential for each kind of edge, parent label and child label."""

    unary: np.ndarray
    pair: np.ndarray


def marginals(model: Model, features: list[list[int]], edges: list[int], parents: list[int]) -> tuple[list[float], list[tuple[float, float, float, float]]]:
    """Sum-product on the tree: P(content) of each node and, for each edge, P(parent label, child label) as (00, 01, 10, 11)."""
    from math import exp

    n = len(features)
    w = model.unary.tolist()
    psi = np.exp(model.pair).tolist()
    local = []
    for on in features:
        s = 0.0
        for f in on:
            s += w[f]
        local.append(1 / (1 + exp(-max(-30.0, min(30.0, s)))))
    up0, up1 = [1 - x for x in local], list(local)  # a node's belief from below
    message: list[tuple[float, float]] = [(1.0, 1.0)] * n
    for k in range(n - 1, 0, -1):
        t = psi[edges[k]]
        m0 = t[0][0] * up0[k] + t[0][1] * up1[k]
        m1 = t[1][0] * up0[k] + t[1][1] * up1[k]
        z = m0 + m1
        message[k] = (m0 / z, m1 / z)
        p = parents[k]
        a, b = up0[p] * m0, up1[p] * m1
        z = a + b
        up0[p], up1[p] = a / z, b / z
    belief = [0.0] * n
    joint: list[tuple[float, float, float, float]] = [(0.0, 0.0, 0.0, 0.0)] * n
    z = up0[0] + up1[0]
    all0, all1 = [0.0] * n, [0.0] * n
    all0[0], all1[0] = up0[0] / z, up1[0] / z
    belief[0] = all1[0]
    for k in range(1, n):
        p, t = parents[k], psi[edges[k]]
        c0, c1 = all0[p] / max(message[k][0], 1e-300), all1[p] / max(message[k][1], 1e-300)  # without this child's own message
        j = (c0 * t[0][0] * up0[k], c0 * t[0][1] * up1[k], c1 * t[1][0] * up0[k], c1 * t[1][1] * up1[k])
        z = sum(j)
        j = tuple(x / z for x in j)
        joint[k] = j
        all0[k], all1[k] = j[0] + j[2], j[1] + j[3]
        belief[k] = all1[k]
    return belief, joint


def fit(pages: list[tuple[str, set[str] | None]], rounds: int = 80, rate: float = 0.5, decay: float = 0.0005) -> Model:
    """Weights from (html, texts of its content blocks) pairs, by adaptive gradient ascent on the trees' likelihood."""
    data = []
    for page, wanted in pages:
        nodes = parse(page)
        features, edges = describe(nodes)
        parents = [n.parent for n in nodes]
        # A node is content if most of the text in it is.
        good, bad = [0] * len(nodes), [0] * len(nodes)
        for k in range(len(nodes) - 1, -1, -1):
            for _, text in nodes[k].texts:
                good[k] += len(text) * (text in wanted)
                bad[k] += len(text) * (text not in wanted)
            if k:
                good[parents[k]] += good[k]
                bad[parents[k]] += bad[k]
        data.append((features, edges, parents, [int(g > b) for g, b in zip(good, bad)]))
    model = Model(np.zeros(len(FEATURES)), np.zeros((len(EDGES), 2, 2)))
    sum_u, sum_p = np.full_like(model.unary, 1e-8), np.full_like(model.pair, 1e-8)
    for _ in range(rounds):
        grad_u, grad_p, count = np.zeros_like(model.unary), np.zeros_like(model.pair), 0
        for features, edges, parents, labels in data:
            belief, joint = marginals(model, features, edges, parents)
            count += len(labels)
            for k, on in enumerate(features):
                miss = labels[k] - belief[k]
                for f in on:
                    grad_u[f] += miss
                if k:
                    grad_p[edges[k], labels[parents[k]], labels[k]] += 1
                    for x in (0, 1, 2, 3):
                        grad_p[edges[k], x >> 1, x & 1] -= joint[k][x]
        grad_u, grad_p = grad_u / count - decay * model.unary, grad_p / count - decay * model.pair
        sum_u, sum_p = sum_u + grad_u**2, sum_p + grad_p**2
        model = Model(model.unary + rate * grad_u / np.sqrt(sum_u), model.pair + rate * grad_p / np.sqrt(sum_p))
    return model


def layout_pages(n: int = 200, seed: int = 5, known: float = 0.6) -> list[tuple[str, set[str]]]:
    """Labelled pages in many layouts, with words that mean nothing.

    A share ``known`` of the names are among those that are told apart; the
    others mean nothing, or stand for themselves as pages without any markup do.
    Then only tags, links and text tell what a block is.
    """
    rng = random.Random(seed)
    syllables = "ba ce di fo gu ha ki lo mu na pe ri so tu ve wi xo ya zu".split()

    def words(k: int) -> str:
        return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(k))

    def sentence(low: int, high: int) -> str:
        return words(rng.randint(low, high)).capitalize() + rng.choice([".", ".", "!", "?"])

    def links(k: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/{words(1)}">{words(rng.randint(1, 3))}</a></li>' for _ in range(k)) + "</ul>"

    pages = []
    for _ in range(n):
        wanted: set[str] = set()

        def keep(text: str, wanted: set[str] = wanted) -> str:
            wanted.add(text)
            return text

        def block(kind: str) -> str:
            text = lambda: " ".join(sentence(3, 14) for _ in range(rng.randint(1, 5)))
            # What only its name gives away keeps it.
            name = rng.choice(HINTS[kind]) if kind in ("ad", "note", "side", "foot", "head", "talk") or rng.random() < known else words(1)
            how = rng.choice([f'class="{name}"', f'id="{name}"', f'class="box {name}-wrap"', f'role="{name}"'])
            if kind == "menu":
                return rng.choice([f"<nav>{links(rng.randint(3, 8))}</nav>", f"<div {how}>{links(rng.randint(3, 8))}</div>"])
            if kind == "head":
                return rng.choice([f"<header><h2>{words(3)}</h2><p>{sentence(2, 6)}</p></header>", f"<div {how}><p>{sentence(2, 6)}</p></div>", f"<header>{links(3)}</header>"])
            if kind == "foot":
                return rng.choice([f"<footer>&copy; {words(2)} {text()}</footer>", f"<footer><p>{text()}</p></footer>", f"<div {how}><p>{text()}</p></div>"])
            if kind == "side":
                return rng.choice([f"<aside><h3>{words(2)}</h3><p>{text()}</p></aside>", f"<aside>{links(4)}</aside>", f"<div {how}><h4>{words(2)}</h4><p>{text()}</p></div>"])
            if kind == "form":
                return rng.choice([f'<form action="/x"><label>{words(2)}</label><input><p>{sentence(2, 6)}</p><button>{words(1)}</button></form>', f"<div {how}><form><p>{text()}</p></form></div>"])
            if kind == "talk":
                return f"<{(t := rng.choice(['section', 'div']))} {how}><h3>{words(1)}</h3>" + "".join(f'<{rng.choice(["div", "article", "li"])} class="{rng.choice(HINTS["talk"])}"><p>{text()}</p></div>' for _ in range(rng.randint(1, 4))) + f"</{t}>"
            if kind == "meta":  # who wrote an article, when, and what about: part of it
                items = "".join(f'<li><a href="/{words(1)}">{keep(words(rng.randint(1, 3)))}</a></li>' for _ in range(rng.randint(1, 5)))
                return rng.choice([f"<div {how}>{keep(words(rng.randint(2, 6)))}</div>", f"<p {how}>{keep(words(rng.randint(2, 6)))}</p>", f"<div {how}><p>{keep(text())}</p></div>", f"<ul {how}>{items}</ul>", f"<div {how}><ul>{items}</ul></div>"])
            return rng.choice([f"<div {how}>{text()}</div>", f"<div {how}><p>{text()}</p></div>", f"<section {how}><p>{text()}</p></section>"])

        def paragraph() -> str:
            text = keep(" ".join(sentence(4, 24) for _ in range(rng.randint(1, 6))))
            kind = rng.random()
            if kind < 0.08:
                return f"<h2>{keep(words(4))}</h2><p>{text}</p>"
            if kind < 0.14:
                return f"<blockquote><p>{text}</p></blockquote>"
            if kind < 0.22:
                return "<ul>" + "".join(f"<li>{keep(sentence(3, 12))}</li>" for _ in range(rng.randint(2, 5))) + f"</ul><p>{text}</p>"
            if kind < 0.28:
                return f"<div>{text}</div>"
            if kind < 0.34:
                return f"<table><tr><td>{keep(sentence(2, 6))}</td><td>{keep(words(2))}</td></tr></table>"
            return rng.choice([f"<p>{text}</p>", f"<p>{text}</p>", f"<p>{text}"])

        title = f"<h1>{keep(words(rng.randint(2, 9)))}</h1>"
        body = "".join(paragraph() + (block(rng.choice(["ad", "note", "form", "side"])) if rng.random() < 0.08 else "") for _ in range(rng.randint(1, 9)))
        if rng.random() < 0.5:
            body += block(rng.choice(["talk", "meta", "side"]))
        body = (title if rng.random() < 0.8 else "") + body
        if rng.random() < 0.2:  # little or no markup
            text = keep(" ".join(sentence(1, 20) for _ in range(rng.randint(1, 4))))
            pages.append((rng.choice(["{}", "<html><body>{}</body></html>", "<article><p>{}</p></article>", "<div><p>{}</p></div>", "<p>{}</p>", "<body><main>{}</main></body>"]).format(text), wanted | {text}))
            continue
        shell = rng.choice(["<article>{}</article>", "<article>{}</article>", "<main>{}</main>", "<main><article>{}</article></main>", '<div class="content">{}</div>', '<div id="main"><div class="post">{}</div></div>', '<div class="entry-content">{}</div>', "<div>{}</div>", '<section class="story">{}</section>']) if rng.random() < known else rng.choice(['<div class="NAME">{}</div>', '<div id="NAME"><div class="NAME2">{}</div></div>', '<section class="NAME">{}</section>', "<div><div>{}</div></div>", "{}"]).replace("NAME2", words(1) + "2").replace("NAME", words(1))
        before = [block(k) for k in ("menu", "head", "note", "ad", "form", "side") if rng.random() < 0.5]
        after = [block(k) for k in ("side", "talk", "ad", "foot", "menu", "note", "form") if rng.random() < 0.5]
        rng.shuffle(before)
        whole = "".join(before) + shell.format(body) + "".join(after)
        if rng.random() < 0.3:
            whole = f'<div class="{rng.choice(["wrapper", "container", "page", "site"])}">{whole}</div>'
        pages.append((f"<!DOCTYPE html><html><head><title>{words(3)}</title></head><body>{whole}</body></html>", wanted))
    return pages


@lru_cache(maxsize=1)
def default_model() -> Model:
    return fit(layout_pages())


def main_text(page: str | None, model: Model) -> str:
    """The text of all blocks that are more likely content than not, in page order."""
    nodes = parse(page)
    features, edges = describe(nodes)
    belief, _ = marginals(model, features, edges, [n.parent for n in nodes])
    texts = [t for k, n in enumerate(nodes) if belief[k] > 0.5 for t in n.texts]
    return " ".join(t for _, t in sorted(texts))


def extract(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    model = model or default_model()
    schema = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def rows(part: dict[str, list]) -> dict[str, list]:
        texts = [main_text(p, model) for p in part["html"]]
        return {"page_id": part["page_id"], "url": part["url"], "text": texts, "n_chars": [len(t) for t in texts]}

    return map_batches(pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html"), rows, schema, 64)
