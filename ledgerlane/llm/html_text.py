"""Main text of web pages by composite text density."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element kinds of HTML, and names that mark what is no article text.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section "
    "summary table tbody td tfoot th thead title tr ul".split()
)
NEVER_TEXT = frozenset(
    "button canvas datalist head iframe input math meta noframes noscript object option script select style svg template "
    "textarea title".split()
)
SELDOM_TEXT = frozenset("aside dialog footer form menu nav".split())
NO_TEXT_ROLES = frozenset("alert banner complementary contentinfo dialog menu navigation search".split())
NO_TEXT_NAMES = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment commentlist comments consent cookie "
    "cookies disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice notices overlay pager "
    "pagination popup promo promoted promotion recommended related replies respond share sharing sidebar signup "
    "social sponsor sponsored subscribe subscription toolbar widget".split()
)
HEADER_NAMES = frozenset("header topbar".split())
#: Names that begin so tell of a state of the page, not what an element holds.
STATE_NAMES = ("has", "hide", "is", "no", "open", "show", "with", "without")
#: What counts as a tag in densities; other elements only dress up the text of a block.
COUNTED = (BLOCKS | {"a", "img"}) - {"br"}
#: Starting one of these ends an open element of the same group, up to the given container.
ENDS_ITSELF = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
CLOSES_PARAGRAPH = BLOCKS - {"br", "body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "legend", "option"}

_NAME_PARTS = re.compile(r"[^a-z0-9]+")
#: An element that would be left out stays if it holds so many times the text outside of such elements,
#: and no less than so many characters.
MOST_TEXT = 4
SOME_TEXT = 80


class Node:
    __slots__ = ("tag", "parent", "children", "attributes", "text", "dropped", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, tag: str, parent: Node | None, attributes: dict | None = None, text: str = ""):
        self.tag, self.parent, self.attributes, self.text = tag, parent, attributes or {}, text
        self.children: list[Node] = []
        self.dropped = False
        if parent is not None:
            parent.children.append(self)


class TreeBuilder(HTMLParser):
    """Elements and texts of a page; end tags that pages leave out are implied, stray ones ignored."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.open = Node("html", None)

    def _close(self, names: set[str] | frozenset[str], until: set[str] | frozenset[str] = frozenset()) -> None:
        node = self.open
        while node is not None and node.tag not in until:
            if node.tag in names and node.parent is not None:
                self.open = node.parent
                return
            node = node.parent

    def handle_starttag(self, tag: str, attributes: list) -> None:
        if tag == "html":
            return
        if tag in CLOSES_PARAGRAPH:
            self._close({"p"}, {"article", "section", "div", "td", "th", "li", "blockquote", "body", "button"})
        if tag in ENDS_ITSELF:
            self._close(*ENDS_ITSELF[tag])
        if tag == "body":
            self._close({"head"})
        node = Node(tag, self.open, dict(attributes))
        if tag not in VOID:
            self.open = node

    def handle_startendtag(self, tag: str, attributes: list) -> None:
        self.handle_starttag(tag, attributes)

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID or tag in ("html", "body"):
            return
        # The end of an inline element can't reach over a block that is still open.
        self._close({tag}, frozenset() if tag in BLOCKS else BLOCKS)

    def handle_data(self, data: str) -> None:
        Node("#text", self.open, text=data)


def _in_order(root: Node) -> list[Node]:
    found, waiting = [], [root]
    while waiting:
        node = waiting.pop()
        found.append(node)
        waiting.extend(reversed(node.children))
    return found


def _names(node: Node) -> set[str]:
    """Parts of the class names and the id, but those of names that only tell of a state."""
    own = node.attributes
    whole = f"{own.get('class') or ''} {own.get('id') or ''}".lower().split()
    parts = [[p for p in _NAME_PARTS.split(name) if p] for name in whole]
    return {p for name in parts if name and name[0] not in STATE_NAMES and name[-1] not in STATE_NAMES for p in name}


def _drop(nodes: list[Node]) -> None:
    """Marks elements that hold no article text, by kind, role, class or id.

    Only some kinds and hidden elements are certain. All others are suspects, and go unless they hold the
    page: an article of their own, or by far the most text that no other suspect has.
    """
    holds_article = {id(n) for n in nodes if n.tag in ("article", "main")}
    for node in reversed(nodes):
        if id(node) in holds_article and node.parent is not None:
            holds_article.add(id(node.parent))
    in_article: set[int] = set()
    suspects: set[int] = set()
    for node in nodes:
        parent = node.parent
        if parent is not None and parent.dropped:
            node.dropped = True
            continue
        inside = parent is not None and id(parent) in in_article
        if inside or node.tag in ("article", "main"):
            in_article.add(id(node))
        if node.tag == "#text" or node.tag in ("html", "body", "article", "main"):
            continue
        own = node.attributes
        if node.tag in NEVER_TEXT or "hidden" in own or own.get("aria-hidden") == "true":
            node.dropped = True
        elif "display:none" in (own.get("style") or "").replace(" ", "").lower():
            node.dropped = True
        elif id(node) not in holds_article:
            names = _names(node)
            outer = not inside and (node.tag == "header" or names & HEADER_NAMES)
            by_kind = node.tag in SELDOM_TEXT or (own.get("role") or "").lower() in NO_TEXT_ROLES
            if by_kind or names & NO_TEXT_NAMES or outer:
                suspects.add(id(node))
    _drop_suspects(nodes, suspects)


def _plain(nodes: list[Node]) -> dict[int, int]:
    """Characters below every node that stand in no link."""
    found = dict.fromkeys(map(id, nodes), 0)
    for node in reversed(nodes):
        if node.dropped or node.tag == "a":
            found[id(node)] = 0
            continue
        if node.tag == "#text":
            found[id(node)] = len("".join(node.text.split()))
        if node.parent is not None:
            found[id(node.parent)] += found[id(node)]
    return found


def _drop_suspects(nodes: list[Node], suspects: set[int]) -> None:
    """Drops the outermost suspects, after those that hold the page are cleared, one at a time from the outside."""
    plain = _plain(nodes)

    def outermost(root: Node) -> list[Node]:
        found, waiting = [], list(reversed(root.children))
        while waiting:
            node = waiting.pop()
            if node.dropped:
                continue
            if id(node) in suspects:
                found.append(node)
            else:
                waiting.extend(reversed(node.children))
        return found

    asked = outermost(nodes[0])
    while asked:
        largest = max(asked, key=lambda n: plain[id(n)])
        rest = plain[id(nodes[0])] - sum(plain[id(n)] for n in asked)
        if largest.tag in ("footer", "nav") or plain[id(largest)] < max(SOME_TEXT, MOST_TEXT * rest + 1):
            break
        suspects.discard(id(largest))
        asked = [n for n in asked if n is not largest] + outermost(largest)
    for node in asked:
        node.dropped = True
    for node in nodes:
        if node.parent is not None and node.parent.dropped:
            node.dropped = True


def _measure(nodes: list[Node]) -> None:
    """Characters, tags, and those of links, below every node; its density; the sum of its children's."""
    for node in nodes:
        node.chars = len("".join(node.text.split()))
        node.tags = node.link_chars = node.link_tags = 0
        node.total = 0.0
    for node in reversed(nodes):
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.link_tags + 1
        if node.parent is not None:
            node.parent.chars += node.chars
            node.parent.link_chars += node.link_chars
            node.parent.link_tags += node.link_tags
            node.parent.tags += node.tags + (node.tag in COUNTED)
    whole = nodes[0]
    share = whole.link_chars / max(whole.chars, 1)
    for node in nodes:
        chars, tags = node.chars, max(node.tags, 1)
        links, link_tags = max(node.link_chars, 1), max(node.link_tags, 1)
        # At least e, so that the base of the second logarithm is at least 1 and a little above it.
        inner = chars / max(chars - node.link_chars, 1) * node.link_chars + share * chars + math.e
        base = max(math.log(inner), 1 + 1e-3)
        ratio = max(chars / links * tags / link_tags, 1.0)
        node.density = chars / tags * (math.log(ratio) / math.log(base) if share else 1.0)
        if node.parent is not None:
            node.parent.total += node.density


def _content(nodes: list[Node]) -> list[Node]:
    """Roots of the subtrees that hold the article, in page order."""
    containers = [n for n in nodes if n.tag in BLOCKS]
    best = max(containers, key=lambda n: n.total)  # of equal ones the first, which is the outermost
    threshold, node = best.density, best
    while node is not None:
        threshold = min(threshold, node.density)
        node = node.parent
    # The densest subtree below every node from the last to the first; a node comes before its children.
    densest: dict[int, Node] = {}
    for node in reversed(nodes):
        found = densest.get(id(node))
        if found is None or node.tag in BLOCKS and node.total >= found.total:
            found = node
        densest[id(node)] = found
        if node.parent is not None:
            known = densest.get(id(node.parent))
            if known is None or found.total >= known.total:
                densest[id(node.parent)] = found
    chosen, covered = [], set()
    dense = {id(nodes[0])}
    marked = set()
    for node in nodes:
        if node.parent is not None and (id(node.parent) not in dense or node.density < threshold):
            continue
        dense.add(id(node))
        marked.add(id(densest[id(node)]))
    for node in nodes:
        if node.parent is not None and id(node.parent) in covered:
            covered.add(id(node))
        elif id(node) in marked and node.chars:
            covered.add(id(node))
            chosen.append(node)
    return chosen


def _blocks(roots: list[Node]) -> list[str]:
    blocks: list[str] = []
    parts: list[str] = []

    def finish() -> None:
        block = " ".join("".join(parts).split())
        parts.clear()
        if block:
            blocks.append(block)

    for root in roots:
        waiting: list[tuple[Node, bool]] = [(root, False)]
        finish()
        while waiting:
            node, after = waiting.pop()
            if node.tag == "#text":
                parts.append(node.text)
            elif after or node.dropped:
                finish()
            else:
                if node.tag in BLOCKS:
                    finish()
                    waiting.append((node, True))
                waiting.extend((child, False) for child in reversed(node.children) if not child.dropped)
        finish()
    return blocks


def main_text(html: str) -> str:
    builder = TreeBuilder()
    builder.feed(html)
    builder.close()
    nodes = _in_order(builder.root)
    _drop(nodes)
    nodes = [n for n in nodes if not n.dropped]
    for node in nodes:
        node.children = [c for c in node.children if not c.dropped]
    _measure(nodes)
    if not nodes[0].chars:
        return ""
    return "\n".join(_blocks(_content(nodes)))


def extract_text(pages: DataFrame, id_column: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """id, url, text and n_chars (code points of text) per page.

    Scripts, styles and what is hidden are left out. Navigation, headers, footers, sidebars, notices,
    adverts, forms and reader comments are told by element kind, role, class or id, and left out unless such
    an element holds an article element or nearly all the text of the page. Every other node gets a
    density: its characters per tag, less the more of them are links. The subtree whose children
    have the greatest sum is the article, together with the densest parts of other subtrees that
    reach the least density on the way from it to the page's root. Its blocks are joined by line
    ends, with white space as single spaces.

    Null, empty and blank pages give an empty text. Broken and unclosed markup is read as far as it
    goes, pages of any length to their end. Repeated rows are read each; other columns are not looked
    at; an empty table gives an empty result.
    """

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                texts = [main_text(h.as_py() or "") for h in part.column("html")]
                made = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("url"), *made], names=["id", "url", "text", "n_chars"]
                )

    rows = pages.select(F.col(id_column).alias("id"), F.col(url).alias("url"), F.col(html).cast("string").alias("html"))
    kinds = dict(rows.dtypes)
    found = rows.mapInArrow(extract, f"id {kinds['id']}, url {kinds['url']}, text string, n_chars long")
    return found.toDF(id_column, url, "text", "n_chars")
