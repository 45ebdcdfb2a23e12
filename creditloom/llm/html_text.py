"""Main text of web pages by composite text density.

Every page becomes a tree. Furniture (menus, headers, footers, forms, notices, reader comments...) is cut off first. Each
node then gets its density, the characters per tag below it, scaled down the more of them are links; a node's sum is the
sum of its children's densities. The node of largest sum is the heart of the page; the lowest density on the path from the
body to it is the threshold; of every subtree that reaches the threshold, the node of largest sum is main text, whole.

The share of link text that scales densities is that of the whole body, links of furniture included. The scale's logarithm
has a base that sinks to 1 where links are rare; its own logarithm counts as 1 at least, so that without any link a density
is the characters per tag times the logarithm of their product. A node that only its class, id or role calls furniture is
kept if it holds most of the body's text outside links, unless the page marks another text by <article> or <main>; tags that
are furniture by name are always cut.

A null or empty page, and one whose body has no text, gives an empty string. Rows are judged one by one, so repeated rows
and null ids give a row each. Nesting is walked without recursion, so depth is not limited.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

from pyspark.sql import DataFrame

from creditloom.llm.tasks import map_rows

#: What may hide the rest of a page: a comment, or an element whose content is no markup.
OPENING = re.compile(r"<!--|<(script|style|textarea|title)\b", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("head script style noscript template svg iframe object canvas".split())
SKIPPED = SILENT | frozenset("nav header footer aside form button select textarea dialog menu".split())
BLOCKS = frozenset(
    "html body article section main div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre figure "
    "figcaption address details summary fieldset center hr".split()
)
#: Blocks of running text: they are part of a heart, never a heart beside their siblings.
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd caption pre figcaption summary".split())
#: An opening tag ends an open element of these names, up to the nearest of the scope.
ENDS = {"li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
#: Words of class names, ids and roles that mark furniture.
FURNITURE = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer header masthead "
    "menu nav navbar navigation newsletter notice popup promo related respond share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)
#: The page's own marks of main text, which no class word outranks.
MARKED = frozenset(("article", "main"))
BLANK = re.compile(r"\s+")


@dataclass
class Node:
    tag: str
    children: list = field(default_factory=list)  # nodes and strings, in page order
    skipped: bool = False
    named: bool = False  # furniture by a word of its class, id or role only
    chars: int = 0
    tags: int = 0
    link_chars: int = 0
    link_tags: int = 0
    density: float = 0.0
    total: float = 0.0


def _is_hidden(attributes: list) -> bool:
    return any(name == "hidden" or (name == "aria-hidden" and value == "true") for name, value in attributes)


def _is_named(attributes: list) -> bool:
    return any(name in ("class", "id", "role") and FURNITURE.intersection(re.split(r"[\W_]+", (value or "").lower())) for name, value in attributes)


class Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("html")
        self.open = [self.root]
        self.counts: dict[str, int] = {}  # open elements by name, so that a stray end tag costs nothing

    def _push(self, node: Node) -> None:
        self.open.append(node)
        self.counts[node.tag] = self.counts.get(node.tag, 0) + 1

    def _pop(self) -> Node:
        node = self.open.pop()
        self.counts[node.tag] -= 1
        return node

    def _close(self, names: set, scope: frozenset | set) -> None:
        if not any(self.counts.get(name) for name in names):
            return
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag in names:
                while len(self.open) > at:
                    self._pop()
                return
            if self.open[at].tag in scope:
                return

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in BLOCKS:
            self._close({"p"}, BLOCKS - {"p"} - LEAVES)
        if tag in ENDS:
            self._close(*ENDS[tag])
        if tag in ("html", "body") and (tag == "html" or self.counts.get("body")):
            return
        if tag == "body":  # ends a head left open
            while len(self.open) > 1:
                self._pop()
        node = Node(tag, skipped=tag in SKIPPED)
        if attrs and not node.skipped and tag not in MARKED and tag not in ("html", "body"):
            node.skipped = _is_hidden(attrs)
            node.named = not node.skipped and _is_named(attrs)
            node.skipped = node.skipped or node.named
        self.open[-1].children.append(node)
        if tag not in VOID:
            self._push(node)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID or tag in ("html", "body") or not self.counts.get(tag):
            return
        self._close({tag}, frozenset())

    def handle_data(self, data: str) -> None:
        self.open[-1].children.append(data)


def _sound_comments(html: str) -> str:
    """The page up to a comment that is never closed, without the short comments that close at once.

    Marks of comments in raw text elements are no comments.
    """
    at, kept = 0, []
    while found := OPENING.search(html, at):
        end = None
        if found[1]:
            closing = re.compile(rf"</{found[1]}[\s/>]", re.I).search(html, found.end())
            end = closing and closing.end()
        elif short := re.compile("-?>").match(html, found.end()):
            kept.append(html[at : found.start()])
            at = short.end()
            continue
        elif (dashes := html.find("-->", found.end())) >= 0:
            end = dashes + 3
        else:
            return "".join([*kept, html[at : found.start()]])
        if end is None:
            break
        kept.append(html[at:end])
        at = end
    return "".join([*kept, html[at:]])


def parse(html: str) -> Node:
    """The body of a page. A tag or comment cut off by the end of the page is left out."""
    html = _sound_comments(html)
    cut = html.rfind("<")
    if cut >= 0 and ">" not in html[cut:] and re.match(r"<[a-zA-Z/!?]", html[cut:]):
        html = html[:cut]
    tree = Tree()
    tree.feed(html)
    tree.close()
    return next((x for x in tree.root.children if isinstance(x, Node) and x.tag == "body"), tree.root)


def _link_share(root: Node) -> float:
    """The share of link text in the whole body. Nodes of furniture by class word that hold most of the text are kept from here on."""
    found, stack = [], [(root, False, False)]
    while stack:  # parents first; silent nodes have no text
        node, linked, marked = stack.pop()
        linked, marked = linked or node.tag == "a", marked or node.tag in MARKED
        found.append((node, linked, marked))
        stack.extend((x, linked, marked) for x in node.children if isinstance(x, Node) and x.tag not in SILENT)
    chars = link_chars = 0
    plain: dict[int, tuple[int, int]] = {}  # by node, characters outside links that only a class word may cut: all, and those in marked nodes
    for node, linked, marked in reversed(found):
        own = sum(len(BLANK.sub("", x)) for x in node.children if isinstance(x, str))
        chars += own
        link_chars += own if linked else 0
        text, main = (0 if linked else own), (own if marked and not linked else 0)
        for x in node.children:
            if isinstance(x, Node):
                more = plain.get(id(x), (0, 0))
                text, main = text + more[0], main + more[1]
        plain[id(node)] = (0, 0) if node.skipped and not node.named else (text, main)
    text, main = plain[id(root)]
    for node, _, marked in found:
        if node.named and 2 * plain[id(node)][0] > text and (marked or plain[id(node)][1] == main):
            node.skipped = False
    return link_chars / max(chars, 1)


def _order(root: Node) -> list[tuple[Node, Node | None]]:
    """Kept nodes with their parents, parents first."""
    found, stack = [], [(root, None)]
    while stack:
        node, parent = stack.pop()
        found.append((node, parent))
        stack.extend((x, node) for x in reversed(node.children) if isinstance(x, Node) and not x.skipped)
    return found


def measure(root: Node) -> list[tuple[Node, Node | None]]:
    """Sets the counts, densities and sums of all kept nodes."""
    share = _link_share(root)
    order = _order(root)
    for node, _ in reversed(order):  # children first
        node.chars = sum(len(BLANK.sub("", x)) if isinstance(x, str) else 0 if x.skipped else x.chars for x in node.children)
        kept = [x for x in node.children if isinstance(x, Node) and not x.skipped]
        node.tags = sum(x.tags + 1 for x in kept)
        node.link_chars = node.chars if node.tag == "a" else sum(x.link_chars for x in kept)
        node.link_tags = sum(x.link_tags + (x.tag == "a") for x in kept)
    for node, _ in order:
        if node.chars:
            plain = max(node.chars - node.link_chars, 1)
            base = math.log(node.chars / plain * node.link_chars + share * node.chars + math.e)
            scale = node.chars / max(node.link_chars, 1) * max(node.tags, 1) / max(node.link_tags, 1)
            node.density = node.chars / max(node.tags, 1) * max(math.log(scale) / max(math.log(base), 1.0), 0.0)
    for node, _ in reversed(order):
        node.total = sum(x.density for x in node.children if isinstance(x, Node) and not x.skipped)
    return order


def _heart(order: list[tuple[Node, Node | None]]) -> Node:
    """The container with the largest sum, the first of equals; only blocks with blocks in them are containers, if there are any."""
    holders = [n for n, _ in order if n.tag in BLOCKS and n.tag not in LEAVES and n.total > 0]
    return max(holders or [order[0][0]], key=lambda n: n.total)


def main_nodes(root: Node) -> list[Node]:
    order = measure(root)
    parents = {id(n): p for n, p in order}
    heart = _heart(order)
    path, at = [], heart
    while at is not None:
        path.append(at)
        at = parents[id(at)]
    threshold = min(n.density for n in path)
    found, stack = [], [root]
    while stack:
        node = stack.pop()
        inside = [x for x in node.children if isinstance(x, Node) and not x.skipped]
        if node is heart or (node is not root and node.tag in BLOCKS and node.density >= threshold and node.chars and not _holds(node, path)):
            found.append(node if node is heart else _heart(_order(node)))
        else:
            stack.extend(reversed(inside))
    return found


def _holds(node: Node, path: list[Node]) -> bool:
    return any(node is x for x in path)


def text_below(nodes: list[Node]) -> str:
    """Blocks joined by line ends; inside a block, any white space is one space."""
    blocks: list[str] = []
    parts: list[str] = []

    def end() -> None:
        if line := BLANK.sub(" ", "".join(parts)).strip():
            blocks.append(line)
        parts.clear()

    stack: list = list(reversed(nodes))
    while stack:
        item = stack.pop()
        if item is None:
            end()
        elif isinstance(item, str):
            parts.append(item)
        elif item.tag == "br":
            parts.append(" ")
        elif not item.skipped:
            if item.tag in BLOCKS:
                end()
                stack.append(None)
            stack.extend(reversed(item.children))
    end()
    return "\n".join(blocks)


def main_text(html: str | None) -> str:
    return text_below(main_nodes(parse(html))) if html else ""


def extract(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep`` columns of every page with its main text and the text's length in code points; other columns are not read."""
    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        for *kept, page in rows:
            text = main_text(page)
            yield (*kept, text, len(text))

    kinds = dict(pages.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", text string, n_chars bigint"
    return map_rows(pages.select(*keep, html), schema, work)
