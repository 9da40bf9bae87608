"""Main text of web pages by tree scoring."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import with_columns

# Fixed names of HTML.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary"
    " table tbody td tfoot th thead tr ul".split()
)
_ENDS_PARAGRAPH = _BLOCKS - frozenset("body html option optgroup caption tbody td tfoot th thead tr".split())
_NEVER_TEXT = frozenset(
    "script style noscript template head title nav aside footer form button select textarea input iframe object svg math"
    " canvas audio video map dialog menu search noembed noframes".split()
)
_CLOSED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_CELLS = frozenset("table td th".split())
_PARAGRAPHS = frozenset("p pre blockquote td li dd".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Words in class, id or role by which pages name what is not their text.
_ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adslot banner sponsor sponsored promo promotion sidebar aside"
    " menu nav navbar navigation breadcrumb breadcrumbs comment comments commentlist respond disqus replies footer header"
    " masthead cookie cookies consent gdpr notice notices notification alert popup modal overlay share sharing social related"
    " recommended recommendations newsletter subscribe subscription signup login search toolbar pagination pager widget"
    " complementary contentinfo dialog skip".split()
)
# Those of them that pages also use within an article, for parts of its text.
_MAY_BE_TEXT = frozenset(
    "social related search header footer share sharing menu promotion alert skip widget complementary recommended".split()
)
_SPLIT_WORDS = re.compile(r"[^a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_WHITE = re.compile(r"\s+")


# Elements that an end or a start may close, and the elements that it does not reach beyond.
_REACH = {
    "p": frozenset("button table td th caption object".split()),
    **{tag: frozenset(limits) for tag, (_, limits) in _CLOSED_BY.items()},
}


class Node:
    __slots__ = ("tag", "named", "parent", "children", "score", "kept", "chars", "link_chars", "words", "within")

    def __init__(self, tag: str, named: frozenset[str], parent: Node | None) -> None:
        self.tag, self.named, self.parent = tag, named, parent
        self.children: list[Node | str] = []
        self.score, self.kept, self.chars, self.link_chars, self.words = 0.0, True, 0, 0, 0
        # The kinds of elements that stand open at this node and that an end may reach from here.
        above = parent.within if parent is not None else frozenset()
        reached = frozenset(k for k in above if tag not in _REACH[k]) if above else above
        self.within = reached | {tag} if tag in _REACH else reached


class TreeBuilder(HTMLParser):
    """
    The tree of a page; elements whose end is left out end where HTML lets them.

    How many elements of each tag stand open is counted, so that an end which closes nothing is not searched for: every
    step up the tree closes an element, and a page takes time by its length however deep it is.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.here = Node("#root", frozenset(), None)
        self.open: Counter[str] = Counter()
        # The same since the last open table or cell.
        self.inner: list[Counter[str]] = [Counter()]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in _ENDS_PARAGRAPH and "p" in self.here.within:
            self._end({"p"}, _REACH["p"])
        if tag in _HEADINGS and self.here.tag in _HEADINGS:
            self._close_here()
        if tag in _CLOSED_BY and self.here.within & _CLOSED_BY[tag][0]:
            self._end(*_CLOSED_BY[tag])
        given = dict(attrs)
        named = " ".join(given.get(k) or "" for k in ("class", "id", "role"))
        style = (given.get("style") or "").replace(" ", "").lower()
        words = set(_SPLIT_WORDS.split(_CAMEL.sub(" ", named).lower()))
        if "hidden" in given or "display:none" in style:
            words.add("#hidden")
        node = Node(tag, frozenset(words), self.here)
        self.here.children.append(node)
        if tag not in _VOID:
            self.here = node
            self.open[tag] += 1
            if tag in _CELLS:
                self.inner.append(Counter())
            self.inner[-1][tag] += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in _VOID:
            return
        if tag in _BLOCKS:
            if self.open[tag]:
                self._end({tag}, {"#root"})
        elif self.inner[-1][tag]:
            self._end({tag}, _CELLS)

    def handle_data(self, data: str) -> None:
        self.here.children.append(data)

    def _close_here(self) -> None:
        tag = self.here.tag
        self.open[tag] -= 1
        self.inner[-1][tag] -= 1
        if tag in _CELLS:
            self.inner.pop()
        self.here = self.here.parent

    def _end(self, tags: set[str], limits: frozenset[str] | set[str]) -> None:
        node = self.here
        while node.parent is not None and node.tag not in tags and node.tag not in limits:
            node = node.parent
        while node.parent is not None and node.tag in tags:
            outer = node.parent
            while self.here is not outer:
                self._close_here()
            if tags <= {"p", "li", "option"} or len(tags) == 1:
                return
            node = outer


def _in_order(root: Node) -> list[Node]:
    """All nodes, parents first."""
    out, rest = [], [root]
    while rest:
        node = rest.pop()
        out.append(node)
        rest.extend(c for c in reversed(node.children) if isinstance(c, Node))
    return out


def _count(nodes: list[Node]) -> None:
    """Characters, characters in links and words of every element, whatever is kept of it."""
    for node in reversed(nodes):
        for child in node.children:
            if isinstance(child, str):
                n = len(child.strip())
                node.chars += n
                node.words += len(child.split())
                node.link_chars += n if node.tag == "a" else 0
            else:
                node.chars += child.chars
                node.words += child.words
                node.link_chars += child.chars if node.tag == "a" else child.link_chars


def _leave_out(nodes: list[Node]) -> None:
    """
    Menus, adverts and the like are not kept, by tag or by name; a part that holds the article is not left out by name.

    Inside an article, some names are also those of text: a part of forty words and more with few links stays.
    """
    holds, inside = set(), set()
    for node in nodes:
        if node.tag in ("article", "main") or node.parent in inside:
            inside.add(node)
        if node.tag in ("article", "main") and not node.named & {"comment", "comments"}:
            up = node
            while up is not None and up not in holds:
                holds.add(up)
                up = up.parent
    for node in nodes:
        outer = node.parent
        if outer is not None and not outer.kept:
            node.kept = False
        elif node.tag in _NEVER_TEXT or "#hidden" in node.named:
            node.kept = node in holds
        elif node.tag == "header":
            node.kept = node in holds or node in inside
        elif names := node.named & _ASIDE_WORDS:
            reads = node in inside and names <= _MAY_BE_TEXT and node.words >= 40 and node.link_chars < 0.2 * node.chars
            node.kept = node in holds or node.tag in ("html", "body") or reads
    for node in nodes:
        node.chars = node.link_chars = 0


def _score(nodes: list[Node]) -> None:
    """A paragraph's points go whole to its parent and by shares of 1/2, 1/3, ... to those above; links take from them."""
    commas = dict.fromkeys(nodes, 0)
    own = dict.fromkeys(nodes, 0)
    for node in reversed(nodes):
        for child in node.children:
            if isinstance(child, str):
                n = len(child.strip()) if node.kept else 0
                own[node] += n
                node.chars += n
                commas[node] += child.count(",") if n else 0
                node.link_chars += n if node.tag == "a" else 0
            elif child.kept:
                node.chars += child.chars
                node.link_chars += child.chars if node.tag == "a" else child.link_chars
                commas[node] += commas[child] if child.tag not in _BLOCKS else 0
                own[node] += own[child] if child.tag not in _BLOCKS else 0
    for node in nodes:
        if not node.kept or not own[node]:
            continue
        if node.tag in _PARAGRAPHS or node.tag in _BLOCKS and node.tag not in ("html", "body") and node.tag not in _HEADINGS:
            points = (1 + commas[node] + own[node] / 100) * (1 - node.link_chars / max(node.chars, 1))
            up, level = node.parent if node.tag in _PARAGRAPHS else node, 1
            while up is not None and level <= 5:
                up.score += points / level
                up, level = up.parent, level + 1


def _worth(node: Node) -> float:
    bonus = {"article": 1.5, "main": 1.25}.get(node.tag, 1)
    return node.score * bonus * (1 - node.link_chars / max(node.chars, 1))


def _main_parts(root: Node, nodes: list[Node]) -> list[Node | str]:
    """
    The best container and those of its siblings that read like its text; the whole page if nothing scores.

    What stands between two chosen siblings, such as headings, lists, tables and quotes, belongs to the text too. Articles
    beside the best one that score alike are all chosen.
    """
    able = [n for n in nodes if n.kept and n.score > 0 and n.parent is not None and n.tag in _BLOCKS]
    best = max(able, key=_worth, default=root)
    articles = [n for n in able if n.tag in ("article", "main") and n.chars >= 0.5 * best.chars]
    if best.tag not in ("article", "main") and articles:
        best = max(articles, key=_worth)
    if best.parent is None or best.tag in ("html", "body"):
        return [best]
    enough, half = max(10.0, _worth(best) * 0.2), 0.5 * _worth(best)
    siblings = best.parent.children
    chosen = []
    for at, sibling in enumerate(siblings):
        if not isinstance(sibling, Node) or not sibling.kept:
            continue
        links = sibling.link_chars / max(sibling.chars, 1)
        reads = sibling.tag == "p" and (sibling.chars > 80 and links < 0.25 or 0 < sibling.chars and not sibling.link_chars)
        alike = sibling.tag == best.tag == "article" and _worth(sibling) >= half
        if sibling is best or alike or _worth(sibling) >= enough or reads or sibling.tag == "h1":
            chosen.append(at)
    return siblings[chosen[0] : chosen[-1] + 1]


def _blocks(parts: list[Node | str]) -> list[str]:
    """Texts of the blocks of neighbouring parts in page order, white space made one space."""
    out: list[str] = []
    held: list[str] = []

    def flush() -> None:
        text = _WHITE.sub(" ", "".join(held)).strip()
        held.clear()
        if text:
            out.append(text)

    rest: list[Node | str | None] = parts[::-1]
    while rest:
        node = rest.pop()
        if node is None:
            flush()
        elif isinstance(node, str):
            held.append(node)
        elif node.kept:
            if node.tag == "br":
                held.append(" ")
            if node.tag in _BLOCKS:
                flush()
                rest.append(None)
            rest.extend(reversed(node.children))
    flush()
    return out


def main_text(html: str | None) -> str:
    """The article of a page; empty for null, for an empty page and for one without text."""
    if not html:
        return ""
    builder = TreeBuilder()
    builder.feed(html)
    builder.close()
    nodes = _in_order(builder.root)
    _count(nodes)
    _leave_out(nodes)
    _score(nodes)
    return "\n".join(_blocks(_main_parts(builder.root, nodes)))


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """
    Every row of ``pages`` with ``text``, its main text, and ``n_chars``.

    Paragraphs pass points for length and commas to the elements around them, less by their share of link text; the best
    container and siblings that read like it are kept. Menus, headers, footers, sidebars, notices, adverts, forms,
    scripts, styles and comments are left out first, by tag, role, class or id. Null html gives empty text. Nothing is
    capped; a page is one value of one task. Ties go to the container that comes first. Repeated pages are rows like
    others. Input columns named ``text`` or ``n_chars`` give way to the new ones; others are kept.
    """

    @F.pandas_udf("string")
    def texts(values: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in values:
            yield pd.Series([main_text(v) for v in batch], dtype=object)

    found = pages.select(F.struct("*").alias("row"), texts(F.col(html)).alias("found"))
    return with_columns("row", found, text=F.col("found"), n_chars=F.length("found").cast("long"))
