"""Main text of web pages by composite text density.

Every block element of the DOM gets a density: characters per tag, adjusted by
how much of both belongs to links. A node's score is the sum of its children's
densities; the subtree with the highest score is the page's content, together
with other subtrees that are as dense as the sparsest node on the way from that
subtree up to the body. Parts that are never content (scripts, buttons, ...) are
cut before anything is counted. So are menus, forms, adverts, comments and the
like, by element, role or a whole class or id, unless they hold the page's
articles or most of its text. Where a page marks articles,
the search is the same but only looks at nodes inside the marked elements, all
of them together.

Pages are independent, so this is a map over Arrow batches with no shuffle.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt "
                   "ruby s samp small span strike strong sub sup time tt u var wbr".split())
NEVER = frozenset("head script style noscript template button select textarea input iframe object svg canvas math title "
                  "audio video map".split())
ASIDE = frozenset("nav header footer aside form menu dialog".split())
NEVER_NAMED = frozenset("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments "
                        "cookie cookies consent disclaimer disqus footer header masthead menu modal nav navbar "
                        "navigation newsletter notice notices notification pagination popup promo promotion related "
                        "reply replies respond share sharing sidebar social sponsor sponsored subscribe toolbar "
                        "widget alert".split())
NEVER_ROLE = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert".split())
UNSEEN = frozenset(("script", "style", "template", "noscript"))  # do not even end a block
MAIN = frozenset(("article", "main"))
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
                     "footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
SAME = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",),
        "option": ("select",)}
DECLARED = re.compile(r"<!\[[^>]*>")


class Node:
    __slots__ = ("tag", "up", "below", "text", "chars", "tags", "link_chars", "link_tags", "density", "score", "cut",
                 "prose", "beside")

    def __init__(self, tag, up, cut):
        self.tag, self.up, self.cut = tag, up, cut
        self.below, self.text = [], []  # text: strings and block nodes, in page order
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.score = 0.0
        self.beside = False  # may be cut for its element, role or name
        self.prose = False  # its own text, without blocks below it, is not mostly links


class Tree(HTMLParser):
    """Block nodes in page order. Inline elements only count as tags of the
    block around them; their text is the block's."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.nodes = [Node("body", None, False)]
        self.open = [("body", self.nodes[0], False)]  # (tag, block, in a link)

    def _close(self, tag, until=()):
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k][0] == tag:
                del self.open[k:]
                return
            if self.open[k][0] in until:
                return

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "body"):
            return
        if tag in CLOSES_P:
            self._close("p", ("table", "button", "td", "th", "article", "section", "div", "li", "blockquote"))
        if tag in SAME:
            self._close(tag, SAME[tag])
        _, block, link = self.open[-1]
        block.tags += 1
        block.link_tags += link or tag == "a"
        if tag in INLINE:
            if tag == "br":
                block.text.append(" ")
            elif tag not in VOID:
                self.open.append((tag, block, link or tag == "a"))
            return
        named = dict(attrs)
        node = Node(tag, block, block.cut or tag in NEVER or "hidden" in named)
        node.beside = tag in ASIDE or self._beside(named)
        self.nodes.append(node)
        block.below.append(node)
        block.text.append(node)
        if tag not in VOID:
            self.open.append((tag, node, link))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in ("html", "body"):
            self._close(tag)

    def handle_endtag(self, tag):
        if tag not in VOID and tag not in ("html", "body"):
            self._close(tag, () if tag not in INLINE else CLOSES_P)

    def handle_data(self, data):
        _, block, link = self.open[-1]
        if not block.cut:
            block.text.append(data)
            n = len("".join(data.split()))
            block.chars += n
            block.link_chars += n * link

    @staticmethod
    def _beside(named) -> bool:
        if (named.get("role") or "").lower() in NEVER_ROLE:
            return True
        return any(w.lower() in NEVER_NAMED for k in ("class", "id") for w in (named.get(k) or "").split())


def _cut(nodes: list[Node]) -> set:
    """Cuts the nodes beside the content, with all that is below them. One that
    has more than half of the page's text outside links stays, and so does one
    with a marked element, if all marked text of the page is in such nodes.
    Returns what is in nodes of the latter kind: marks there do not tell the
    article from comments, so they do not bound the search."""
    plain = {id(x): 0 if x.cut else x.chars - x.link_chars for x in nodes}
    holds, under = set(), set()  # has marked text below; is in a node beside the content
    for x in reversed(nodes):
        if x.up is not None and not x.cut:
            plain[id(x.up)] += plain[id(x)]
            if id(x) in holds or (x.tag in MAIN and not x.beside and plain[id(x)]):
                holds.add(id(x.up))
    most = plain[id(nodes[0])] / 2
    open_marks = False
    for x in nodes:
        if x.beside and plain[id(x)] <= most or id(x.up) in under:
            under.add(id(x))
        elif x.tag in MAIN and not x.cut and plain[id(x)]:
            open_marks = True
    for x in nodes:
        if x.up is not None:
            x.cut |= x.up.cut or x.beside and plain[id(x)] <= most and (open_marks or id(x) not in holds)
    return under


def _score(nodes: list[Node]) -> None:
    """Densities and scores, from the leaves up (children come after parents)."""
    for x in nodes:
        x.prose = x.chars > 2 * x.link_chars
    for x in reversed(nodes):
        if x.up is not None and not x.cut:
            x.up.chars += x.chars
            x.up.tags += x.tags
            x.up.link_chars += x.link_chars
            x.up.link_tags += x.link_tags
    body = nodes[0]
    share = body.link_chars / (body.chars or 1)
    for x in nodes:
        if x.cut or not x.chars:
            continue
        tags, links, linked = x.tags or 1, x.link_tags or 1, x.link_chars or 1
        base = log(x.chars / (x.chars - x.link_chars or 1) * x.link_chars + share * x.chars + e)
        x.density = x.chars / tags * max(0.0, log(max(1.0, x.chars / linked * tags / links)) / log(max(base, 1.0 + 1e-9)) if base > 1
                                         else log(max(1.0, x.chars / linked * tags / links)) + 1)
        if x.up is not None:
            x.up.score += x.density


def _blocks(root: Node, chosen: set, own: set) -> list[str]:
    """The texts of the blocks under ``root`` in page order, white space made
    one: all that is in a subtree of ``chosen``, and of the nodes of ``own``
    the text between their blocks."""
    out, run = [], []
    stack = [(iter(root.text), id(root) in chosen, id(root) in own)]

    def flush():
        if s := " ".join("".join(run).split()):
            out.append(s)
        run.clear()

    while stack:
        parts, whole, between = stack[-1]
        for part in parts:
            if isinstance(part, str):
                if whole or between:
                    run.append(part)
            elif not part.cut:
                flush()
                stack.append((iter(part.text), whole or id(part) in chosen, id(part) in own))
                break
            elif part.tag not in UNSEEN:
                flush()
        else:
            flush()
            stack.pop()
    return out


def main_text(html: str) -> str:
    """The main text of one page: blocks joined by two line feeds."""
    tree = Tree()
    tree.feed(DECLARED.sub(" ", html))
    tree.close()
    nodes = tree.nodes
    under = _cut(nodes)
    _score(nodes)
    inside = set()  # parents come before children
    for x in nodes:
        if not x.cut and x.chars and (x.tag in MAIN and id(x) not in under or id(x.up) in inside):
            inside.add(id(x))
    searched = [x for x in nodes if not x.cut and (id(x) in inside or not inside)]
    best = max(searched, key=lambda x: x.score)
    way, x = set(), best
    limit = best.density
    while x is not None:
        way.add(id(x))
        limit = min(limit, x.density)
        x = x.up
    chosen = {id(best)}
    for x in searched:
        if id(x) not in way and x.density >= limit and x.chars > 2 * x.link_chars:
            chosen.add(id(x))
    return "\n\n".join(_blocks(nodes[0], chosen, {id(x) for x in searched if id(x) in way and x.prose}))


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text and n_chars (code points).

    NULL or empty html, and pages with no text, give an empty text; rows that
    repeat stay; an empty table gives no rows. Broken markup is read the way a
    browser would: elements left open end with their container.
    """
    ship(df.sparkSession)
    pages = df.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                      F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            texts = [main_text(h) for h in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1).cast(pa.string()), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
