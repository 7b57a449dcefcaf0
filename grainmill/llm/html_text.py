"""Main text of web pages by tree scoring.

A page is read into a tree of elements. Subtrees that can't be the article (scripts,
menus, footers, forms, and boxes whose class, id or role says advert, comments, notice and
so on) are set aside. Every paragraph-like block then gives points to its container: one,
one for each comma, and one for each hundred characters up to three; the container passes
half of its points on to the one around it, and so on. A container's points are discounted
by the share of its text that lies in links. The best container is kept; where it lies in
an ``article`` or ``main`` element, that is kept as a whole. With it is kept whatever lies
beside it and has few links or scores well enough itself (beside an ``article``: what
scores well enough, headings, and other articles); the same is done one level up for as
long as a container there holds article text, too. The text of what is kept comes in page
order, a block after another.

Reading and scoring take time in proportion to the page: points, lengths and commas are
carried up once, a tag's attributes are read one by one, and an end tag looks for its
element among the last ``LOOK_BACK`` open ones.

Defined results: null or empty html, and pages with no text outside what is set aside,
give an empty text. Character references are decoded once. White space inside a block
becomes one space (a line break element counts as white space), blocks are joined by one
space. Unclosed and misnested tags are accepted, unclosed raw text elements end with the
page, a quote that never closes is no quote. Repeated rows each get their row; other columns
are ignored.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grainmill.llm.arrow import map_texts

#: Element names by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
ASIDE = frozenset(
    "script style noscript template head title meta link nav header footer aside menu form button select option textarea input label "
    "iframe object embed canvas svg math audio video dialog noembed noframes xmp".split()
)
PARAGRAPH = frozenset("p pre blockquote td li dd h1 h2 h3 h4 h5 h6".split())
CLOSED_BY_SAME = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table", "tbody", "thead", "tfoot"), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
#: Words of a class, id or role that mark a box as no part of an article.
UNLIKELY = frozenset(
    "ad ads adbox adsbygoogle advert adverts advertisement advertising banner breadcrumb breadcrumbs combx comment comments commentlist consent "
    "cookie cookies disqus foot footer gdpr hidden masthead menu modal nav navbar navigation newsletter notice notices outbrain overlay pager "
    "pagination popup promo promoted promotion recommend recommended related remark replies reply respond rss share sharing shoutbox sidebar "
    "sidebars signup skyscraper social sponsor sponsored subscribe subscription taboola toolbar tweet alert alerts complementary contentinfo search".split()
)
#: Words that do so unless another word says that the box may hold the article nevertheless.
DOUBTFUL = frozenset("community extra header legends supplemental widget widgets".split())
LIKELY = frozenset("article body content entry main post story text".split())
#: First words of a name that say what a box is like or has around it, not what it is.
ABOUT = frozenset("has have is no not with without".split())
#: An ``article`` element is a reader's comment if a name of its class begins so.
COMMENT = frozenset("comment comments reply".split())

#: Beside the best container: the share of linked text from which a box is left, unless it scores this share of the best.
MOST_LINKED, LEAST_SCORE = 0.25, 0.2
#: What part of a container's points the container around it gets.
PASSED_ON = 0.5
LOOK_BACK = 256
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|</([a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)|<([a-zA-Z][^\s/>]*+)", re.S)
_ATTRIBUTE = re.compile(r"""[\s/]*+(?:([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"'][^\s>]*+)?+))?+)?+""")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_WORD = re.compile(r"[a-z]+")
#: Characters that HTML calls white space, and the no-break space that pages use as one.
_SPACE = re.compile(r"[ \t\n\f\r\v\xa0]+")


class Node:
    __slots__ = ("tag", "parent", "children", "aside", "score", "whole", "part", "text", "linked", "commas")

    def __init__(self, tag: str, parent: Node | None, aside: bool):
        self.tag, self.parent, self.aside = tag, parent, aside
        self.children: list = []  # nodes and strings in page order
        self.score = self.whole = self.part = 0.0
        self.text = self.linked = self.commas = 0


def names_aside(value: str) -> bool:
    """Whether one of the names in a class, id or role marks a box as no part of an article."""
    for name in value.split():
        words = _WORD.findall(_CAMEL.sub(" ", name).lower())
        if not words or words[0] in ABOUT:
            continue
        if not UNLIKELY.isdisjoint(words) or not DOUBTFUL.isdisjoint(words) and LIKELY.isdisjoint(words):
            return True
    return False


def marked_aside(tag: str, attributes: list[tuple[str, str]], in_article: bool) -> bool:
    """Whether an element is no part of an article by its name or attributes."""
    if tag in ASIDE:
        return not (tag == "header" and in_article)
    for name, value in attributes:
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        if name == "style" and re.search(r"display\s*+:\s*+none|visibility\s*+:\s*+hidden", value, re.I):
            return True
        if name == "class" and tag == "article" and any(n.lower().replace("_", "-").split("-")[0] in COMMENT for n in value.split()):
            return True
        if name in ("class", "id", "role") and tag not in ("html", "body", "article", "main") and names_aside(value):
            return True
    return False


def attributes_at(page: str, pos: int) -> tuple[list[tuple[str, str]], int, bool]:
    """The attributes of a tag from the end of its name on, where the tag ends, and whether it closes itself."""
    out: list[tuple[str, str]] = []
    while True:
        found = _ATTRIBUTE.match(page, pos)
        if not found[1]:
            at = found.end()
            return out, at + 1, page[at - 1 : at] == "/"
        out.append((found[1].lower(), found[2] or found[3] or found[4] or ""))
        pos = found.end()


def parse(page: str) -> Node:
    """The page's tree."""
    root = at = Node("#root", None, False)
    articles: set[Node] = set()
    pos, end = 0, len(page)
    while pos < end:
        found = _TOKEN.search(page, pos)
        if found is None:
            at.children.append(page[pos:])
            break
        if found.start() > pos:
            at.children.append(page[pos : found.start()])
        pos = found.end()
        if found[1]:
            at = closed(at, found[1].lower())
            continue
        if not found[2]:
            continue
        tag, attributes, alone = found[2].lower(), [], False
        if page[pos : pos + 1] == ">":
            pos += 1
        else:
            attributes, pos, alone = attributes_at(page, pos)
        at = opened(at, tag)
        node = Node(tag, at, at.aside or marked_aside(tag, attributes, at in articles))
        if tag == "article" or at in articles:
            articles.add(node)
        at.children.append(node)
        if tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, pos)
            node.children.append(page[pos : stop.start() if stop else end])
            close = page.find(">", stop.start()) if stop else -1
            pos = close + 1 if close >= 0 else end
        elif tag not in VOID and not alone:
            at = node
    return root


def opened(at: Node, tag: str) -> Node:
    """The node that a new element belongs to: it ends open elements that it can't be inside."""
    if tag in BLOCK:
        up = at
        for _ in range(LOOK_BACK):
            if up.tag == "p":  # a block ends an open paragraph, and what is open in it
                at = up.parent
                break
            if up.parent is None or up.tag in BLOCK:
                break
            up = up.parent
    if tag in CLOSED_BY_SAME:
        up, same = at, {"dt", "dd"} if tag in ("dt", "dd") else {"td", "th"} if tag in ("td", "th") else {tag}
        for _ in range(LOOK_BACK):
            if up.parent is None or up.tag in CLOSED_BY_SAME[tag]:
                break
            if up.tag in same:
                return up.parent
            up = up.parent
    return at


def closed(at: Node, tag: str) -> Node:
    """The node in which the page goes on after an end tag."""
    up = at
    for _ in range(LOOK_BACK):
        if up.parent is None:
            break
        if up.tag == tag:
            return up.parent
        if tag not in BLOCK and up.tag in BLOCK:
            break  # an inline end tag doesn't close a block
        up = up.parent
    return at


def weigh(root: Node) -> None:
    """Text lengths, and points from paragraphs to their containers, all carried up once. Walks without recursion."""
    stack = [(root, False, False)]
    while stack:
        n, link, done = stack.pop()
        if n.aside:
            continue
        if not done:
            link = link or n.tag == "a"
            stack.append((n, link, True))
            stack += [(c, link, False) for c in n.children if isinstance(c, Node)]
            continue
        own = " ".join(c for c in n.children if isinstance(c, str)).strip()
        own_commas = own.count(",")
        n.text += len(own)
        n.commas += own_commas
        n.linked += len(own) if link else 0
        container = n.tag in BLOCK or n.tag == "#root"
        if container:
            n.score = n.whole + n.part
            if own and n.tag in ("div", "section", "article", "main", "body", "#root"):
                n.score += points(len(own), own_commas)
        up = n.parent
        if up is None:
            continue
        up.text += n.text
        up.linked += n.linked
        up.commas += n.commas
        up.whole += (0 if container else n.whole) + (points(n.text, n.commas) if n.tag in PARAGRAPH and n.text else 0)
        up.part += PASSED_ON * n.score if container else n.part


def points(length: int, commas: int) -> float:
    return 1 + commas + min(length / 100, 3)


def density(node: Node) -> float:
    return node.linked / node.text if node.text else 0.0


def chosen(root: Node) -> list[Node | str | None]:
    """The best container and what is kept beside it, in page order; None ends a block."""
    best, most, stack = None, 0.0, [root]
    while stack:
        n = stack.pop()
        if n.aside:
            continue
        stack += reversed([c for c in n.children if isinstance(c, Node)])
        value = n.score * (1 - density(n)) * (1.5 if n.tag in ("article", "main") else 1.0)
        if value > most:
            best, most = n, value
    if best is None:
        return [root]
    up = best
    while up is not None and up.tag != "article":
        up = up.parent
    if up is None:
        up = best
        while up is not None and up.tag != "main":
            up = up.parent
    best = up or best
    while best.parent is not None and best.tag not in BLOCK:
        best = best.parent
    kept: list[Node | str | None] = [best]
    wide, at = kept, best
    while at.parent is not None:
        before, after, found = beside(at, LEAST_SCORE * most)
        wide = [None, *before, None, *wide, None, *after, None]
        if found or at is best:
            kept = wide
        at = at.parent
    return kept


def beside(at: Node, least: float) -> tuple[list[Node | str], list[Node | str], bool]:
    """What is kept before and after a node in its parent, and whether a container in it scores ``least``.

    A run of strings and inline elements is kept or left as one. What lies beside an ``article``
    must score itself, be a heading, or be an article of few links.
    """
    whole = at.tag == "article"
    sides: tuple[list, list] = ([], [])
    run: list[Node | str] = []
    side, found = 0, False

    def end() -> None:
        text = sum(len(c.strip()) if isinstance(c, str) else c.text for c in run)
        if text and not whole and sum(c.linked for c in run if isinstance(c, Node)) < MOST_LINKED * text:
            sides[side].extend(run)
        run.clear()

    for c in at.parent.children:
        if isinstance(c, str) or c.tag not in BLOCK and c is not at:
            if isinstance(c, str) or not c.aside:
                run.append(c)
            continue
        end()
        if c is at:
            side = 1
        elif not c.aside and c.text:
            strong = c.score * (1 - density(c)) >= least
            found |= strong
            if strong or density(c) < MOST_LINKED and (not whole or c.tag == "article" or c.tag in HEADINGS):
                sides[side].append(c)
    end()
    return *sides, found


def blocks(nodes: list[Node | str | None]) -> list[str]:
    """Text of each block in page order, its white space reduced."""
    out: list[str] = []
    run: list[str] = []

    def end() -> None:
        text = _SPACE.sub(" ", entities.unescape("".join(run))).strip(" ")
        if text:
            out.append(text)
        run.clear()

    stack: list = list(reversed(nodes))
    while stack:
        n = stack.pop()
        if n is None:
            end()
        elif isinstance(n, str):
            run.append(n)
        elif n.tag == "br":
            run.append("\n")
        elif not n.aside:
            if n.tag in BLOCK:
                end()
                stack.append(None)
            stack += reversed(n.children)
    end()
    return out


def main_text(page: str | None) -> str:
    """The article's text of a page."""
    if not page:
        return ""
    root = parse(page)
    weigh(root)
    return " ".join(blocks(chosen(root)))


def extract_pages(df: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """``id_col``, the kept columns, ``text`` and ``n_chars`` (code points) of every page; no shuffle."""

    def run(pages: pa.Array) -> dict:
        return {"text": [main_text(p) for p in pages.to_pylist()]}

    out = map_texts(df, [id_col, *keep], html_col, run, [T.StructField("text", T.StringType())])
    return out.withColumn("n_chars", F.length("text").cast("long"))
