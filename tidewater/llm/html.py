"""Main text of web pages by tree scoring.

A page is read into a tree (implied ends of paragraphs, list items, cells and rows are known; stray end
tags are ignored). Scripts, styles, menus, controls and hidden elements are left out. So are page headers and footers, sidebars, forms
and elements whose role, class or id names an advert, a notice, a comment or a widget -- unless the article is inside: the only
``article`` or ``main`` elements of the page, or, on a page without any, over half of its unlinked text while less than a tenth is
outside all such elements. A layout state in a class (``has-sidebar``, ``no-comments``) names no element.

Every remaining paragraph passes points, one plus one for each comma plus one for every 100 characters up to three, to its
container, half of them to the next ancestor, a quarter to the one above, and so on. A container's points are discounted by
its link density; an ancestor that scores nearly as much (three quarters) takes its place. The best container is kept with those siblings of few links that reach a fifth of its points, are elements like it, or
are headings, paragraphs, lists and the like; inside an ``article`` or ``main`` element, that element is the container.

Text: character references are decoded, white space inside a block becomes one space, blocks are joined in page order
by a line break. Nothing else is dropped or capped; a page whose paragraphs score nothing gives all its remaining text.
Sums go up the tree once and marks come down once, so the time is in proportion to the page, however deep it is nested.

Defined cases: null and empty pages and pages without text give an empty text; unclosed elements end with the
page; an unfinished tag at the end is text; a page of any length is read whole, its tree takes some 300 bytes an element; of equally good containers the deepest, then the first wins;
repeated rows give repeated results; an empty table gives no rows; other columns are ignored, and of clashing names the first counts.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import first_columns

# Fixed values of the HTML language and of common page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split())
DROPPED = frozenset("head script style noscript template nav button select option optgroup datalist textarea input label iframe object embed applet svg canvas audio video map menu noembed noframes title".split())
DOUBTFUL = frozenset("footer aside form fieldset dialog".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar".split())
PARAGRAPHS = frozenset("p pre td th blockquote li dd dt div section article main body figcaption".split())
PROSE = frozenset("p pre blockquote h1 h2 h3 h4 h5 h6 hgroup ul ol dl table figure section".split())
CLOSES = {"li": ("li", {"ul", "ol", "menu"}), "dt": ("dt dd", {"dl"}), "dd": ("dt dd", {"dl"}), "tr": ("tr td th", {"table"}), "td": ("td th", {"tr", "table"}), "th": ("td th", {"tr", "table"}), "option": ("option", {"select"})}
FURNITURE = re.compile(
    r"(?:^|[\s_-])(?:ads?|adv|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notice|notices|notification|alert|popup|pop-up|modal|overlay|newsletter|subscri\w*|signup|sign-up|login"
    r"|share|sharing|social|related|recommend\w*|sidebar|side-bar|aside|comments?|commentlist|respond|replies|reply|disqus|breadcrumbs?|menu|nav|navbar|navigation|footer|masthead|topbar|toolbar|widgets?|pagination|pager|paginator|skip|search|tags|taglist|byline-links|outbrain|taboola)(?:$|[\s_-])",
    re.I,
)
LAYOUT = re.compile(r"^(?:has|no|not|with|without|is|page|layout|hide|show)[-_]", re.I)
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


class Node:
    __slots__ = ("tag", "parent", "depth", "block", "hard", "doubtful", "link", "name", "chars", "linked", "points")

    def __init__(self, tag: str, parent: Node | None, hard: bool, doubtful: bool, link: bool, block: bool, name: str = ""):
        self.tag, self.parent, self.hard, self.doubtful, self.link, self.name = tag, parent, hard, doubtful, link, name
        self.depth = parent.depth + 1 if parent else 0
        self.block: Node = self if block or parent is None else parent.block  # the block-level element that holds its text
        self.chars, self.linked, self.points = 0, 0, 0.0  # of the text that is left in

    def density(self) -> float:
        return self.linked / self.chars if self.chars else 1.0

    def score(self) -> float:
        return self.points * (1 - self.density())


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(text)}


def _judged(tag: str, found: dict[str, str], in_article: bool) -> tuple[bool, bool]:
    """Is the element left out; is it left out unless it holds the article?"""
    if tag in DROPPED:
        return True, False
    if tag in ("html", "body"):
        return False, False
    if "hidden" in found or found.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", "")):
        return True, False
    if tag in DOUBTFUL or tag == "header" and not in_article:  # an article's own header holds its heading
        return False, True
    if found.get("role", "").lower() in DROPPED_ROLES:
        return False, True
    names = " ".join(x for x in f"{found.get('class', '')} {found.get('id', '')}".split() if not LAYOUT.match(x))
    if tag == "article":
        return False, bool(re.search(r"(?:^|[\s_-])(?:comments?|replies|reply|related|promo)(?:$|[\s_-])", names, re.I))
    return False, tag != "main" and bool(FURNITURE.search(names))


class Page:
    """The tree of a page (elements in page order) and its text blocks: holder, text, linked characters."""

    def __init__(self, html: str):
        self.root = Node("#root", None, False, False, False, True)
        self.nodes: list[Node] = [self.root]
        self.blocks: list[tuple[Node, str, int]] = []
        self._text: list[str] = []
        self._linked = 0
        self._at = self.root
        self._open: dict[str, int] = {}  # open elements by tag
        self._read(html)

    def _flush(self) -> None:
        if not self._text:
            return
        text = " ".join("".join(self._text).split())
        linked, self._linked = self._linked, 0
        self._text.clear()
        if text:
            self.blocks.append((self._at.block, text, min(linked, len(text))))

    def _close_to(self, node: Node) -> None:
        """Ends ``node`` and all elements in it."""
        at = self._at
        while at is not node.parent and at is not self.root:
            self._open[at.tag] -= 1
            at = at.parent
        self._at = at

    def _open_in(self, tags: str, stop: set[str]) -> Node | None:
        wanted = tags.split()
        if not any(self._open.get(t) for t in wanted):
            return None
        node, found = self._at, None
        while node is not self.root and node.tag not in stop:
            if node.tag in wanted:
                found = node
                if len(wanted) == 1 and self._open[node.tag] == 1:
                    break
            node = node.parent
        return found

    def _add(self, text: str) -> None:
        if not self._at.hard:
            text = unescape(text) if "&" in text else text
            self._text.append(text)
            if self._at.link:
                self._linked += len(text.strip())

    def _read(self, html: str) -> None:
        at, n = 0, len(html)
        while at < n:
            m = TOKEN.search(html, at)
            if m is None:
                self._add(html[at:])
                break
            if m.start() > at:
                self._add(html[at : m.start()])
            at = m.end()
            if m[2] is None:
                if m[0].startswith("<![CDATA["):
                    self._add(m[0][9:].removesuffix("]]>"))
                continue
            tag = m[2].lower()
            if m[1]:
                self._end(tag)
                continue
            self._start(tag, m[3])
            if tag in RAW and not m[3].rstrip().endswith("/"):
                close = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(html, at)
                if close is None and tag != "title":
                    break
                if close is not None:
                    at = close.end()
                self._end(tag)
        self._flush()

    def _start(self, tag: str, attributes: str) -> None:
        if tag == "br" or tag == "wbr":
            if tag == "br" and not self._at.hard:
                self._text.append(" ")
            return
        block = tag in BLOCK or "-" in tag
        if block:
            self._flush()
            open_p = self._open_in("p", {"table", "button", "td", "th"})
            if open_p is not None:
                self._close_to(open_p)
            if tag in CLOSES:
                found = self._open_in(*CLOSES[tag])
                if found is not None:
                    self._close_to(found)
        if tag in VOID:
            return
        parent = self._at
        named = _attributes(attributes) if attributes.strip() else {}
        hard, doubtful = _judged(tag, named, bool(self._open.get("article") or self._open.get("main")))
        if doubtful and not block:  # a part of a line: it holds no article
            hard, doubtful = True, False
        self._at = Node(tag, parent, parent.hard or hard, doubtful, parent.link or tag == "a", block, named.get("class", ""))
        self.nodes.append(self._at)
        self._open[tag] = self._open.get(tag, 0) + 1

    def _end(self, tag: str) -> None:
        if not self._open.get(tag):
            return
        node, crossed = self._at, False
        while node is not self.root and node.tag != tag:
            if node.tag in ("td", "th", "table") and tag not in BLOCK:
                return  # an inline end does not leave a cell
            crossed = crossed or node.block is node
            node = node.parent
        if node is self.root:
            return
        if crossed or node.block is node:
            self._flush()
        self._close_to(node)

    def dropped(self) -> dict[int, bool]:
        """For every element (by id): is its text left out?"""
        free, plain, articles = {}, {}, {}  # unlinked characters; those, and article elements, outside doubtful elements inside
        for node in self.nodes:
            free[id(node)] = plain[id(node)] = 0
            articles[id(node)] = int(node.tag in ("article", "main") and not node.hard)
        for holder, text, linked in self.blocks:
            free[id(holder)] += len(text) - linked
            plain[id(holder)] += len(text) - linked
        for node in reversed(self.nodes[1:]):
            up = id(node.parent)
            free[up] += free[id(node)]
            if not node.doubtful:
                plain[up] += plain[id(node)]
                articles[up] += articles[id(node)]
        whole, outside, known = free[id(self.root)], plain[id(self.root)], articles[id(self.root)]
        anywhere = any(n.tag in ("article", "main") and not n.hard and not n.doubtful for n in self.nodes)
        out = {id(self.root): False}
        for node in self.nodes[1:]:
            gone = node.hard or out[id(node.parent)]
            if node.doubtful and not gone:
                inside = articles[id(node)] - (node.tag in ("article", "main"))
                spared = (known == 0 and inside > 0) if anywhere else 2 * free[id(node)] > whole > 10 * outside
                if spared:
                    outside += plain[id(node)]
                    known += inside
                gone = not spared
            out[id(node)] = gone
        return out

    def main_text(self) -> str:
        gone = self.dropped()
        blocks = [b for b in self.blocks if not gone[id(b[0])]]
        if not blocks:
            return ""
        for holder, text, linked in blocks:
            holder.chars += len(text)
            holder.linked += linked
            if holder.tag in PARAGRAPHS and len(text) >= 25:
                # a paragraph element passes its points on; text that is directly in a container counts for the container
                taker = holder.parent if holder.tag in ("p", "pre", "blockquote", "li", "td", "dd") else holder
                taker.points += 1 + text.count(",") + text.count("、") + text.count("，") + min(len(text) / 100, 3)
        for node in reversed(self.nodes[1:]):
            node.parent.chars += node.chars
            node.parent.linked += node.linked
            node.parent.points += node.points / 2
        best = max((n for n in self.nodes[1:] if n.points > 0 and n.chars), key=lambda n: (n.score(), n.depth), default=None)
        if best is None:
            return "\n".join(text for _, text, _ in blocks)
        node = best.parent
        while node is not self.root and node.score() >= 0.75 * best.score():  # a chain of wrappers with text at every level
            best, node = node, node.parent
        node = best
        while node is not self.root:  # the outermost article or main around it
            if node.tag in ("article", "main"):
                best = node
            node = node.parent
        kept = {id(best)}
        if best.tag not in ("main", "body", "html"):
            for node in self.nodes[1:]:
                if node.parent is best.parent and node is not best and node.chars and node.density() < 0.25:
                    alike = node.tag == best.tag and node.name == best.name and best.tag != "article" or node.tag in PROSE
                    if alike or node.score() >= best.score() / 5:
                        kept.add(id(node))
        inside = {id(self.root): False}
        for node in self.nodes[1:]:
            inside[id(node)] = id(node) in kept or inside[id(node.parent)]
        return "\n".join(text for holder, text, _ in blocks if inside[id(holder)])


def extract(html: str | None) -> str:
    return Page(html).main_text() if html else ""


def main_texts(pages: DataFrame) -> DataFrame:
    """One row per page: ``page_id``, ``url``, ``text``, ``n_chars``."""

    def each(batches):
        for batch in batches:
            texts = [extract(x) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    slim = first_columns(pages, "page_id", "url", "html").select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return slim.mapInArrow(each, "page_id long, url string, text string, n_chars long")
