"""Main text of web pages: a tree-structured graphical model over the page's elements, solved by sum-product message passing.

Every block element is a node that is content or not. Node potentials come from the element's features, pair potentials connect
parent and child; messages go up and then down the tree and give each node's marginal. Both are counted from labelled pages, which
`labelled_pages` composes by rule: articles within menus, headers, footers, sidebars, notices, adverts, forms and comments.
"""

from __future__ import annotations

import html
import math
import random
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Labelled pages that teach, and the seed they are composed with.
PAGES, SEED = 600, 7

# Fixed values of HTML: elements without an end tag, with raw text that isn't the page's, of other languages, whose text is read as the page's
# again, and inside a line.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title".split())
FOREIGN = frozenset("svg math".split())
HOME = frozenset("foreignobject desc mi mo mn ms mtext annotation-xml".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var html body".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
#: What can't stand in svg or math, and ends them where they were left open.
BREAKS = CLOSES_P | frozenset("b big body br center code dd dt em embed i img li s small span strike strong sub sup td th tr tt u var".split())
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
SCOPE = frozenset("ul ol dl table div article section nav aside header footer main form td th".split())

_OPEN = re.compile(r"<(?:!--|[!?]|(/?)([a-zA-Z][^\s/>]*))")
_QUOTED = re.compile(r"[^>\"']*+")
_ATTR = re.compile(r"(class|id|role|data-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_ENDS = {t: re.compile(rf"</{t}\s*>", re.I) for t in RAW}
_WORD = re.compile(r"[A-Za-z]+")


class Node:
    __slots__ = ("tag", "names", "parent", "children", "parts", "link", "label", "score", "foreign")

    def __init__(self, tag: str, names: frozenset, parent, label=None):
        self.tag, self.names, self.parent, self.label = tag, names, parent, label
        self.children, self.parts, self.link, self.score = [], [], 0, (0.0, 0.0)
        self.foreign = tag in FOREIGN or parent is not None and parent.foreign and tag not in HOME


def _tags(page: str):
    """The page's markup from left to right: (begin, end, "/" or "", tag, its attributes as text); a comment's or a declaration's tag is empty.

    A ">" in quotes ends no tag, unless so many quotes are open that none would end: from there on quotes don't count, so that the page
    is read once. What has no end is text; a comment without one goes on to the page's end."""
    at, last, quotes = 0, {c: page.rfind(c) for c in "\"'>"}, True
    while m := _OPEN.search(page, at):
        begin, at = m.start(), m.end()
        if m[0] == "<!--":
            end = page.find("-->", at)
            at = len(page) if end < 0 else end + 3
            yield begin, at, "", "", ""
            continue
        if begin > last[">"]:
            return
        end = at if quotes and m[2] else page.find(">", at)
        while quotes and m[2]:
            end = _QUOTED.match(page, end).end()
            if end == len(page) or page[end] != ">" and end >= last[page[end]]:
                quotes, end = False, page.find(">", at)
                break
            if page[end] == ">":
                break
            end = page.find(page[end], end + 1) + 1
        yield begin, end + 1, m[1] or "", (m[2] or "").lower(), page[at:end]
        at = end + 1


def parse(page: str) -> list[Node]:
    """The page's block elements in page order, the root first. A node's parts: its own text and, as numbers, its children's places.

    Whatever the markup, nothing is refused: unknown end tags are skipped, open elements end with their parent or the page. Of elements
    only the text of scripts, styles, text fields and titles isn't read. In svg and math "/>" ends an element. Each tag is read once, and an end
    tag or a list item looks upwards only if there is such an element.
    """
    nodes = [Node("root", frozenset(), None)]
    now, at, links, opened = nodes[0], 0, 0, Counter()

    def add(text: str) -> None:
        if text:
            now.parts.append(text)
            if links:
                now.link += len(text)

    def leave(node: Node) -> None:
        """What is open up to and with the node ends."""
        nonlocal now
        while now is not node:
            opened[now.tag] -= 1
            now = now.parent
        opened[now.tag] -= 1
        now = now.parent

    for begin, end, close, tag, rest in _tags(page):
        if begin < at:
            continue
        add(page[at:begin])
        at = end
        if not tag:
            continue
        if close:
            if tag == "a":
                links = 0
            elif opened[tag] > 0:
                top = now
                while top.tag != tag:
                    top = top.parent
                leave(top)
                links = 0
            continue
        if now.foreign and tag in BREAKS:
            while now.foreign:
                leave(now)
            links = 0
        empty = rest.endswith("/") and (now.foreign or tag in FOREIGN)
        if tag in RAW:
            if empty:
                continue
            end = _ENDS[tag].search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag == "a":
            links = 1
        if tag == "br" or tag == "hr":
            add(" ")
        if tag in INLINE or tag in VOID:
            continue
        if tag in CLOSES_P and now.tag == "p":
            leave(now)
        stop = SAME.get(tag)
        if stop and any(opened[t] > 0 for t in stop):
            top = now
            while top.parent is not None and top.tag not in SCOPE and top.tag not in stop:
                top = top.parent
            if top.tag in stop and top.parent is not None:
                leave(top)
        names, label = [], None
        for a in _ATTR.finditer(rest):
            value = a[2] or a[3] or a[4] or ""
            if a[1].lower() == "data-label":
                label = int(value == "1")
            else:
                names += [w.lower() for w in _WORD.findall(value)]
        if empty:
            continue
        node = Node(tag, frozenset(names), now, label)
        now.children.append(node)
        now.parts.append(node)
        nodes.append(node)
        opened[tag] += 1
        now, links = node, 0
    add(page[at:])
    return nodes


def _features(node: Node) -> list[str]:
    own = sum(len(p) for p in node.parts if isinstance(p, str))
    out = [f"tag={node.tag}"] + [f"name={n}" for n in node.names]
    out.append(f"text={min(5, int(math.log2(own + 1)) // 2)}")
    if own:
        out.append(f"link={min(3, 4 * node.link // own)}")
    return out


class Model:
    """Logarithms: of each feature's likelihood ratio (content to not), and of a child's label given its parent's."""

    def __init__(self, weight: dict[str, float], pair: list[list[float]]):
        self.weight, self.pair = weight, pair


def train(pages: list[str]) -> Model:
    """From pages whose elements carry data-label; an element without it has its parent's label."""
    count, total, pair = [Counter(), Counter()], [0, 0], [[1.0, 1.0], [1.0, 1.0]]
    for page in pages:
        nodes = parse(page)
        nodes[0].label = 1
        for n in nodes[1:]:
            n.label = n.parent.label if n.label is None else n.label
            count[n.label].update(_features(n))
            total[n.label] += 1
            pair[n.parent.label][n.label] += 1
    weight = {f: math.log((count[1][f] + 0.2) / (total[1] + 0.4)) - math.log((count[0][f] + 0.2) / (total[0] + 0.4)) for f in count[0] | count[1]}
    return Model(weight, [[math.log(x / sum(row)) for x in row] for row in pair])


def _plus(a: float, b: float) -> float:
    hi, lo = (a, b) if a > b else (b, a)
    return hi + math.log1p(math.exp(lo - hi))


def marginals(nodes: list[Node], model: Model) -> list[float]:
    """P(content) of each node. Sum-product in logarithms: children come after their parents in the list, so one pass backwards
    sends the messages up and one forwards sends them down."""
    place = {id(n): i for i, n in enumerate(nodes)}
    pair = model.pair
    belief = [[0.0, sum(model.weight.get(f, 0.0) for f in _features(n))] for n in nodes]
    belief[0] = [-2.0, 0.0]
    up = [(0.0, 0.0)] * len(nodes)
    for i in range(len(nodes) - 1, 0, -1):
        b = belief[i]
        up[i] = (_plus(pair[0][0] + b[0], pair[0][1] + b[1]), _plus(pair[1][0] + b[0], pair[1][1] + b[1]))
        p = belief[place[id(nodes[i].parent)]]
        p[0] += up[i][0]
        p[1] += up[i][1]
    for i in range(1, len(nodes)):
        p = belief[place[id(nodes[i].parent)]]
        rest = (p[0] - up[i][0], p[1] - up[i][1])
        belief[i][0] += _plus(rest[0] + pair[0][0], rest[1] + pair[1][0])
        belief[i][1] += _plus(rest[0] + pair[0][1], rest[1] + pair[1][1])
    return [1 / (1 + math.exp(max(-700, min(700, b[0] - b[1])))) for b in belief]


def extract(page: str | None, model: Model, least: float = 0.5) -> str:
    """The text of the elements whose marginal is at least `least`, blocks joined by one space; empty for null and empty pages."""
    if not page:
        return ""
    nodes = parse(page)
    on = {id(n) for n, p in zip(nodes, marginals(nodes, model)) if p >= least}
    blocks: list[str] = []
    todo: list = [(nodes[0], 0)]
    text: list[str] = []

    def close() -> None:
        if text:
            blocks.append(" ".join(html.unescape("".join(text)).split()))
            text.clear()

    while todo:
        node, k = todo.pop()
        while k < len(node.parts):
            part = node.parts[k]
            k += 1
            if isinstance(part, str):
                if id(node) in on:
                    text.append(part)
            else:
                close()
                todo.append((node, k))
                node, k = part, 0
        close()
    return " ".join(b for b in blocks if b)


_SYLLABLES = "ba de ki lo mu na pe ri so tu va ze chi sha the ing and or at en".split()


def labelled_pages(n: int = PAGES, seed: int = SEED) -> list[str]:
    """Pages of many layouts whose elements say in data-label whether they are content."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(_SYLLABLES) for _ in range(rng.randint(1, 4)))
    line = lambda a, b: " ".join(word() for _ in range(rng.randint(a, b))).capitalize() + rng.choice([".", "", "!"])
    link = lambda: f'<a href="/{word()}">{line(1, 3)}</a>'
    pick = lambda *names: "" if rng.random() < 0.1 else f' {rng.choice(["class", "id", "class"])}="{rng.choice(names)}"'

    def off(tag: str, body: str, *names: str) -> str:
        return f'<{tag}{pick(*names) if names else ""} data-label="0">{body}</{tag}>'

    items = lambda: "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(rng.randint(2, 9))) + "</ul>"
    noise = {
        "menu": lambda: off(rng.choice(["nav", "nav", "div"]), items(), "menu", "nav", "navbar", "navigation", "breadcrumb", "topnav", "main-menu"),
        "header": lambda: off(rng.choice(["header", "div"]), f"<div>{line(1, 5)}</div><p>{line(2, 8)}</p>", "header", "site-header", "masthead", "banner", "topbar", "logo"),
        "footer": lambda: off(rng.choice(["footer", "footer", "div"]), f"<p>&copy; {line(2, 30)}</p>" if rng.random() < 0.5 else f"&copy; {line(2, 30)}", "footer", "site-footer", "copyright", "legal", "bottom"),
        "side": lambda: off(rng.choice(["aside", "div", "section"]), f"<h3>{line(1, 4)}</h3>{items()}<p>{line(3, 40)}</p>", "sidebar", "side", "related", "widget", "promo", "recommended", "share", "social", "tags", "author-box", "newsletter", "pagination", "trending"),
        "ad": lambda: off("div", line(3, 40), "ad", "ads", "advert", "advertisement", "sponsored", "ad-slot", "banner-ad", "sponsor"),
        "notice": lambda: off(rng.choice(["div", "section", "p"]), line(5, 40), "cookie", "cookie-notice", "notice", "consent", "gdpr", "alert", "popup", "modal", "paywall", "subscribe", "disclaimer", "warning"),
        "form": lambda: off("form", f"<label>{line(1, 4)}</label><input type=text><p>{line(2, 10)}</p><div>{line(1, 3)}</div>", "search", "login", "signup", "contact", "subscribe"),
        "comments": lambda: off(rng.choice(["div", "section", "ol", "ul"]), "".join(f'<{t}{pick("comment", "reply", "user-comment")}><p>{line(3, 60)}</p></{t}>' for t in [rng.choice(["div", "li", "article"])] for _ in range(rng.randint(1, 5))), "comments", "comment-list", "discussion", "responses", "replies", "disqus"),
    }

    def body() -> str:
        out = [f"<h1>{line(2, 12)}</h1>"]
        for _ in range(rng.randint(1, 14)):
            r = rng.random()
            text = line(3, 12) if rng.random() < 0.25 else line(8, 120)
            if r < 0.72:
                out.append(f"<p>{rng.choice(['', '', '<b>', '<i>'])}{text}{rng.choice(['</p>', '</p>', '<br>', ''])}")
            elif r < 0.8:
                level = rng.randint(2, 4)
                out.append(f"<h{level}>{line(1, 8)}</h{level}>")
            elif r < 0.86:
                out.append("<ul>" + "".join(f"<li>{line(2, 25)}</li>" for _ in range(rng.randint(2, 6))) + "</ul>")
            elif r < 0.9:
                out.append(f"<blockquote><p>{text}</p></blockquote>")
            elif r < 0.93:
                out.append(f"<p>{line(4, 30)} {link()} {line(4, 30)}</p>")
            elif r < 0.95:
                out.append("<table>" + "".join(f"<tr><td>{line(1, 5)}</td><td>{line(1, 5)}</td></tr>" for _ in range(3)) + "</table>")
            elif r < 0.96:
                out.append(f"<figure><figcaption>{line(3, 15)}</figcaption></figure>")
            elif r < 0.97:
                out.append(f"<pre>{text}</pre>")
            elif r < 0.985:
                out.append(f"<div{pick('section', 'text', 'body')}>{text}</div>")
            else:
                out.append(noise[rng.choice(["ad", "notice", "side"])]())
        return "".join(out)

    pages = []
    for _ in range(n):
        before = "".join(noise[k]() for k in rng.sample(["menu", "header", "ad", "notice", "form", "side"], rng.randint(1, 4)))
        after = "".join(noise[k]() for k in rng.sample(["footer", "comments", "side", "ad", "form", "notice", "menu"], rng.randint(1, 4)))
        tag = rng.choice(["article", "article", "article", "main", "div", "section"])
        name = pick("content", "article", "post", "entry-content", "post-body", "main", "story", "text") if tag in ("div", "section") or rng.random() < 0.3 else ""
        text = f'<{tag}{name} data-label="1">{body()}</{tag}>'
        for outer in rng.sample(["main", "div", "section"], rng.randint(0, 2)):
            text = f'<{outer}{pick("wrapper", "container", "content", "page", "row", "col")} data-label="1">{text}</{outer}>'
        pages.append(f"<html><body>{before}{text}{after}</body></html>")
    return pages


def main_text(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """pages with `text` and `n_chars` (code points) added, without html, written to the shared folder. Null and empty html gives empty text; every
    row gives one row, repeated ones too. Pages' own columns text and n_chars become text_input and n_chars_input."""
    pages = common.make_room(pages, "text", "n_chars")
    shared = pages.sparkSession.sparkContext.broadcast(model or train(labelled_pages()))

    @F.arrow_udf("string")
    def run(page: pa.Array) -> pa.Array:
        return pa.array([extract(x, shared.value) for x in page.to_pylist()], pa.string())

    out = pages.withColumn("text", run("html")).withColumn("n_chars", F.length("text").cast("long"))
    return common.result(out.drop("html"), common.shared_dir(pages.sparkSession))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(common.source(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")
