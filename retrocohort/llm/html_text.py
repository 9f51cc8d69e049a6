"""Main text of web pages by composite text density.

A page is parsed to a tree. Parts that are never the article, by their element
or name, are cut. Every node has a density, its characters per tag, lowered by
the share of links. The node whose children's densities have the greatest sum
is the core of the article. From there the selection climbs towards the body as
long as a node is at least as dense as the body as a whole, and stops at an
article element.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements and names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    """address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot
    th thead tr ul""".split()
)
NEVER_TEXT = frozenset(
    """applet audio button canvas datalist dialog embed footer form head iframe aside math menu meter nav noscript
    object optgroup option progress script select style svg template textarea title video""".split()
)
CLUTTER_NAMES = frozenset(
    """ad ads adbox adsense adslot advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment
    comments commentlist consent cookie cookies copyright discussion disqus footer gdpr login masthead menu modal nav
    navbar navigation newsletter notice notices notification overlay pager pagination popup promo promotion related
    recommended recommendations replies respond share sharing sidebar signup skip social sponsor sponsored subscribe
    subscription tags toolbar topbar widget""".split()
)
#: Of these, the ones that also name parts of articles: whole classes only, and not within an article unless mostly links.
AMBIGUOUS_NAMES = frozenset(
    """alert banner copyright consent discussion menu navigation notice notices notification overlay promotion recommended
    recommendations related replies respond share sharing skip social sponsor sponsored subscription tags""".split()
)
COMMENT_NAMES = frozenset({"comment", "comments", "commentlist", "replies", "disqus"})
COMMENT_PART = re.compile(r"comments?[-_](?:area|block|body|box|container|content|list|section|thread|wrap|wrapper)")
CLUTTER_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status toolbar".split()
)
HEADER_NAMES = frozenset({"header", "site-header", "top-header", "siteheader"})
ARTICLE = frozenset({"article", "main"})

#: What a new element ends: its own kind, up to an enclosing element.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
}
SCOPE = frozenset({"html", "table", "td", "th", "button", "caption", "object", "template"})


class Element:
    __slots__ = (
        *("tag", "attrs", "parent", "children", "article", "chars", "link_chars", "tags", "link_tags", "density", "total"),
    )

    def __init__(self, tag: str, attrs: dict, parent: Element | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        # the nearest article element, itself included
        self.article: Element | None = self if tag in ARTICLE else parent and parent.article
        self.children: list[Element | str] = []
        self.chars = self.link_chars = self.tags = self.link_tags = 0
        self.density = self.total = 0.0

    def elements(self) -> Iterator[Element]:
        """The subtree, children before parents."""
        todo: list[tuple[Element, bool]] = [(self, False)]
        while todo:
            node, done = todo.pop()
            if done:
                yield node
            else:
                todo.append((node, True))
                todo += [(c, False) for c in reversed(node.children) if isinstance(c, Element)]


class _Tree(HTMLParser):
    """Builds the tree. The open elements are a stack, and for each tag its places there, ascending."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Element("html", {}, None)
        self.open = [self.root]
        self.places: dict[str, list[int]] = defaultdict(list, html=[0])
        self.blocks: list[int] = []
        self.body: Element | None = None

    def _close_to(self, n: int) -> None:
        """The first ``n`` open elements stay open."""
        while len(self.open) > n:
            tag = self.open.pop().tag
            self.places[tag].pop()
            if tag in BLOCKS:
                self.blocks.pop()

    def _last(self, tag: str) -> int:
        places = self.places.get(tag)
        return places[-1] if places else -1

    def _end(self, tags: set, scope: frozenset | set) -> None:
        """Closes the outermost open element of ``tags`` that no element of ``scope`` is open in."""
        limit = max(self._last(tag) for tag in scope)
        found = []
        for tag in tags:
            places = self.places.get(tag, [])
            k = bisect_right(places, limit)
            found += places[k : k + 1]
        if found:
            self._close_to(min(found))

    def handle_starttag(self, tag, attrs):
        if tag == "html":
            return
        if tag == "body":
            if self.body is not None:
                return
            self._close_to(1)
        if tag in BLOCKS:
            self._end({"p"}, SCOPE)
        if tag in ENDS:
            self._end(*ENDS[tag])
        node = Element(tag, {k: v or "" for k, v in attrs}, self.open[-1])
        self.open[-1].children.append(node)
        if tag == "body":
            self.body = node
        if tag not in VOID:
            self.places[tag].append(len(self.open))
            if tag in BLOCKS:
                self.blocks.append(len(self.open))
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag in ("body", "html"):
            return
        place = self._last(tag)
        if tag not in BLOCKS and self.blocks and self.blocks[-1] > place:
            return  # an inline end tag does not close blocks
        if place > 0:
            self._close_to(place)

    def handle_data(self, data):
        self.open[-1].children.append(data)


def parse(page: str) -> Element:
    """The body of a page, or all of it if it has none; a tag cut off at the end is no text."""
    tree = _Tree()
    tree.feed(re.sub(r"<[a-zA-Z/!?][^<>]*\Z", "", page))
    tree.close()
    return tree.body or tree.root


def _length(text: str) -> int:
    return len("".join(text.split()))


def _names(node: Element) -> set[str]:
    text = f"{node.attrs.get('class', '')} {node.attrs.get('id', '')}"
    parts = re.sub(r"([a-z])([A-Z])", r"\1 \2", text).lower()
    return {*parts.split(), *re.split(r"[^a-z]+", parts)}


def _is_comment(node: Element) -> bool:
    """Whether a whole class or the id says comments; comments-open or no-comments do not."""
    tokens = f"{node.attrs.get('class', '')} {node.attrs.get('id', '')}".lower().split()
    if any(t in COMMENT_NAMES or COMMENT_PART.fullmatch(t) for t in tokens):
        return True
    return node.tag == "article" and "comment" in _names(node)


def _clutter_names(node: Element) -> set[str]:
    names = _names(node) & CLUTTER_NAMES
    doubtful = names & AMBIGUOUS_NAMES
    if doubtful:
        within = node.article is not None and 2 * node.link_chars <= node.chars
        whole = set() if within else {*node.attrs.get("class", "").lower().split()}
        names -= doubtful - whole
    return names


def _is_clutter(node: Element, half: float, holders: set[int], article: bool) -> bool:
    if node.tag in NEVER_TEXT:
        return True
    if "hidden" in node.attrs or node.attrs.get("aria-hidden") == "true":
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", node.attrs.get("style", "").lower()):
        return True
    if node.tag == "header" and (node.parent is None or node.parent.article is None):
        return True
    if node.attrs.get("role", "").lower() in CLUTTER_ROLES:
        return True
    if _is_comment(node):
        # whatever its size, if the page has an article elsewhere
        return node.tag not in ("body", "main") and id(node) not in holders and (article or node.chars <= half)
    if not _clutter_names(node) and not (_names(node) & HEADER_NAMES and node.article is None):
        return False
    # a name like with-sidebar on the element that holds the article
    return node.tag not in ("body", *ARTICLE) and id(node) not in holders and node.chars <= half


def _measure(body: Element) -> None:
    for node in body.elements():
        own = sum(_length(c) for c in node.children if isinstance(c, str))
        inner = [c for c in node.children if isinstance(c, Element)]
        node.chars = own + sum(c.chars for c in inner)
        node.tags = sum(1 + c.tags for c in inner)
        link = node.tag == "a"
        node.link_chars = node.chars if link else sum(c.link_chars for c in inner)
        node.link_tags = int(link) + sum(c.link_tags for c in inner)


def _cut(body: Element) -> None:
    _measure(body)
    half = body.chars / 2
    holders: set[int] = set()
    comments: set[int] = set()
    todo = [body]
    while todo:
        node = todo.pop()
        if node is not body and (id(node.parent) in comments or _is_comment(node)):
            comments.add(id(node))
        todo += [c for c in node.children if isinstance(c, Element)]
    article = False
    for node in body.elements():
        if node.tag in ("article", "main", "h1") and id(node) not in comments:
            article = True
            up = node.parent
            while up is not None and id(up) not in holders:
                holders.add(id(up))
                up = up.parent
    todo = [body]
    while todo:
        node = todo.pop()
        node.children = [c for c in node.children if isinstance(c, str) or not _is_clutter(c, half, holders, article)]
        todo += [c for c in node.children if isinstance(c, Element)]
    _measure(body)


def _densities(body: Element) -> None:
    ratio = body.link_chars / max(body.chars, 1)
    for node in body.elements():
        if node.chars:
            plain = max(node.chars - node.link_chars, 1)
            links, tags = max(node.link_chars, 1), max(node.tags, 1)
            base = math.log(node.chars / plain * node.link_chars + ratio * node.chars + math.e)
            adjusted = node.chars / links * tags / max(node.link_tags, 1)
            node.density = node.chars / tags * math.log(max(adjusted, 1.0)) / max(math.log(base + math.e - 1), 1e-9)
        node.total = sum(c.density for c in node.children if isinstance(c, Element))


def select(body: Element) -> tuple[Element, Element]:
    """The subtree that holds the article, and its core."""
    _cut(body)
    _densities(body)
    core = max(body.elements(), key=lambda n: n.total)
    if core.total <= 0:
        return body, body
    holder = core.article
    if holder is not None:
        return holder, holder
    top = core
    while top is not body and top.parent is not None and top.parent.density >= body.density:
        top = top.parent
    return top, core


def _is_link_list(node: Element) -> bool:
    return node.tag in ("ul", "ol", "div", "section", "table") and 2 * node.link_chars > node.chars > 0


def blocks(content: Element, core: Element) -> list[str]:
    """Texts of the blocks in page order, white space collapsed.

    Without an article element, lists of links outside the core, or before its
    first text, are menus; those after it, such as references, stay.
    """
    inside = {id(n) for n in core.elements()}
    begun = False
    out: list[str] = []
    held: list[str] = []

    def flush():
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            out.append(text)

    todo: list[Element | str | None] = [content]
    while todo:
        item = todo.pop()
        if item is None:
            flush()
        elif isinstance(item, str):
            held.append(item)
            begun = begun or bool(item.strip())
        elif item.tag == "br":
            held.append(" ")
        elif content.tag in ARTICLE or item is content or not _is_link_list(item) or (begun and id(item) in inside):
            block = item.tag in BLOCKS
            if block:
                flush()
                todo.append(None)
            todo += reversed(item.children)
    flush()
    return out


def main_text(page: str) -> str:
    """The article of a page, one line per block; empty if there is none."""
    return "\n".join(blocks(*select(parse(page))))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page.as_py() or "") for page in batch.column("html")]
        columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())]
        columns.append(pa.array([len(t) for t in texts], pa.int64()))
        yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages`` (page_id, url, html).

    NULL and empty pages, and pages without an article, have the empty text.
    Rows are independent: repeated rows and NULL ids come back as they are.
    Other columns are not read. No shuffle.
    """
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
