"""Main text of web pages by composite text density."""

from __future__ import annotations

import bisect
import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import in_arrow

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TEXT = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section "
    "select summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCKS - frozenset("body caption dd dt html legend li optgroup option tbody td tfoot th thead tr".split())
#: an open element of the second kind ends where one of the first begins
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
#: never part of the main text
DROPPED_TAGS = frozenset(
    "nav header footer aside script style noscript iframe head template svg canvas object embed button select "
    "input textarea dialog menu search title noembed noframes math audio video".split()
)
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar".split())
DROPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation "
    "menu menus breadcrumb breadcrumbs header masthead footer sidebar aside rail widget widgets related recommended share "
    "sharing social cookie cookies consent notice notices gdpr popup modal overlay newsletter subscribe subscription signup "
    "login search comment comments respond reply replies disqus discussion pager pagination skip toolbar".split()
)
#: what readers wrote; a class or id of such words and plain ones for its shape goes, whatever its size
COMMENT_WORDS = frozenset("comment comments commentlist commentary respond reply replies disqus ugc".split())
SHAPE_WORDS = frozenset("list section area thread threads block box wrap wrapper container user users reader readers all body item the".split())
FORM = "#form"  # noted like a name: forms go unless they wrap the page
SMALL = 0.2  # share of a page's text, below which a partly telling name suffices
ENOUGH = 500  # characters that make a main text by themselves
_MAIN = frozenset(("article", "main"))
_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(>|\Z)"
    r"|</[^>]*(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_QUOTED = re.compile(r"\"[^\"]*\"|'[^']*'")
_HIDDEN = re.compile(r"(?:\A|[\s\"'])hidden(?=[\s=/]|\Z)", re.I)
_COOKIES = re.compile(r"\bcookies?\b", re.I)
_SPACES = re.compile(r"\s+")
_WORDS = re.compile(r"[a-z]+|[0-9]+")


class Node:
    __slots__ = ("tag", "parent", "children", "drop", "names", "in_main", "linked", "chars", "tags", "link_chars", "link_tags", "density", "density_sum")

    def __init__(self, tag: str, parent: Node | None, drop: bool = False):
        self.tag, self.parent, self.drop = tag, parent, drop
        self.in_main = tag in _MAIN or parent is not None and parent.in_main
        self.linked = tag == "a" or parent is not None and parent.linked
        self.names: dict[str, bool] = {}  # words of its class and id that tell boilerplate: is one a whole name?
        self.children: list[Node | str] = []


def _attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(source)} if source else {}


def _within(node: Node, tags: frozenset[str]) -> Node | None:
    while node is not None and node.tag not in tags:
        node = node.parent
    return node


def _boilerplate(node: Node, source: str) -> bool:
    """Whether tag, role or style rule an element out; words of its class and id are noted in its names."""
    tag = node.tag
    own = node.parent.in_main
    if tag in DROPPED_TAGS and not (tag == "header" and own):
        return True
    if tag == "form":
        node.names[FORM] = True
    if not source or tag in ("html", "body"):
        return False
    got = _attributes(source)
    named = [_WORDS.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower()) for name in f"{got.get('class', '')} {got.get('id', '')}".split()]
    if any(COMMENT_WORDS.intersection(words) and COMMENT_WORDS.union(SHAPE_WORDS).issuperset(w for w in words if not w.isdigit()) for words in named):
        return True
    if tag in _MAIN:
        return False
    role = got.get("role", "").lower()
    if role == "form":
        node.names[FORM] = True
    if role in DROPPED_ROLES or _HIDDEN.search(_QUOTED.sub("''", source)) or got.get("aria-hidden") == "true":
        return True
    if re.search(r"display\s*:\s*none", got.get("style", "")):
        return True
    for words in named:
        for word in words:
            if word in DROPPED_WORDS and not (own and word == "header"):  # a headline stands in the header of an article
                node.names[word] = node.names.get(word, False) or all(w in DROPPED_WORDS for w in words)
    return False


def drop_named(root: Node) -> None:
    """Drop elements whose class or id tells boilerplate, unless they hold the text of the page.

    Text outside of links counts, of all elements with the same word together. Those where the word is part of a
    name (has-sidebar, widget-container) go if they hold less than ``SMALL`` of it. Those named by such words alone go
    if the rest has a quarter as much text as they, or ``ENOUGH`` characters. The rest must have as much after all drops too.
    Forms are judged like those, but always go where an article or main element outside of them has text.
    """
    nodes = list(_post_order(root))
    if not any(n.names for n in nodes):
        return
    plain = lambda n: n.chars - n.link_chars
    page = plain(measure(root)[-1])
    enough = lambda rest, gone: rest >= min(gone / 4, ENOUGH)
    held: dict[tuple[str, bool], int] = {}
    above: dict[int, frozenset] = {}
    for node in reversed(nodes):  # parents come first
        outer = above.get(id(node.parent), frozenset())
        own = frozenset(node.names.items())
        above[id(node)] = outer | own if own - outer else outer
        for key in own - outer:
            held[key] = held.get(key, 0) + plain(node)
    gone = {k for k, n in held.items() if (enough(page - n, n) if k[1] else n < SMALL * page)}
    form = (FORM, True)
    if form in held and any(n.tag in _MAIN and n.chars and form not in above[id(n)] for n in nodes):
        gone.add(form)
        held.pop(form)
    named = [n for n in nodes if not gone.isdisjoint(n.names.items())]
    for node in named:
        node.drop = True
    rest = plain(measure(root)[-1])
    if not enough(rest, page - rest):
        for node in named:
            node.drop = form in gone and form not in held and FORM in node.names


_CELL = frozenset(("td", "th", "table", "body"))


class _Open:
    """The open elements, outermost first, and where those of each kind are among them."""

    def __init__(self, root: Node):
        self.nodes = [root]
        self.at: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def push(self, node: Node) -> None:
        self.at.setdefault(node.tag, []).append(len(self.nodes))
        if node.tag in BLOCKS:
            self.blocks.append(len(self.nodes))
        self.nodes.append(node)

    def close(self, place: int) -> None:
        """Close the element at a place and all within it."""
        while len(self.nodes) > place:
            tag = self.nodes.pop().tag
            self.at[tag].pop()
            if tag in BLOCKS:
                self.blocks.pop()

    def last(self, tags) -> int:
        """Place of the innermost open element of these tags; 0 if there is none."""
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=0)

    def first_after(self, tags, place: int) -> int:
        """Place of the outermost open element of these tags within the one at a place; 0 if there is none."""
        found = []
        for t in tags:
            places = self.at.get(t, [])
            i = bisect.bisect_right(places, place)
            if i < len(places):
                found.append(places[i])
        return min(found, default=0)


def parse(source: str) -> Node:
    """The element tree; unclosed and misplaced tags are mended the way browsers do for common cases.

    No step walks up the open elements but to close them, so the time grows with the page, however deep it nests.
    """
    root = Node("#root", None)
    opened, at, end = _Open(root), 0, len(source)
    while at < end:
        found = _TOKEN.search(source, at)
        if found is None:
            opened.nodes[-1].children.append(source[at:])
            break
        if found.start() > at:
            opened.nodes[-1].children.append(source[at : found.start()])
        at = found.end()
        tag = found[2]
        if tag is None or found[4] != ">":  # a comment, a declaration, or a tag cut off by the end of the page
            continue
        tag = tag.lower()
        if found[1]:
            place = opened.last((tag,))
            # an inline end tag does not reach out of a cell
            if place and (tag in BLOCKS or opened.last(_CELL) <= place):
                opened.close(place)
            continue
        if tag in CLOSES_P and opened.blocks and opened.nodes[opened.blocks[-1]].tag == "p":
            opened.close(opened.blocks[-1])
        if tag in IMPLIED_END:
            ends, within = IMPLIED_END[tag]
            if place := opened.first_after(ends, opened.last(within)):
                opened.close(place)
        node = Node(tag, opened.nodes[-1])
        node.drop = _boilerplate(node, found[3])
        opened.nodes[-1].children.append(node)
        if tag in RAW_TEXT:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(source, at)
            at = close.end() if close else end
        elif tag not in VOID:  # browsers ignore the slash of an ordinary element
            opened.push(node)
    return root


def _post_order(root: Node) -> Iterator[Node]:
    """All nodes that are not dropped, children first; without recursion, as pages may nest deeply."""
    stack: list[tuple[Node, bool]] = [(root, False)]
    while stack:
        node, ready = stack.pop()
        if ready:
            yield node
        else:
            stack.append((node, True))
            stack.extend((c, False) for c in reversed(node.children) if isinstance(c, Node) and not c.drop)


def measure(root: Node) -> list[Node]:
    """Composite text density of every node, and the sum over its children.

    With C characters, T tags, LC link characters, LT link tags: C / T, times a
    logarithm of C / LC * T / LT whose base grows with the share of link text, so that
    nodes made of links fall behind.
    """
    nodes = list(_post_order(root))
    for node in nodes:
        node.chars = node.tags = node.link_chars = node.link_tags = 0
        for child in node.children:
            if isinstance(child, str):
                node.chars += len(child) if child and not child.isspace() else 0
            elif not child.drop:
                node.chars += child.chars
                node.tags += child.tags + 1
                node.link_chars += child.link_chars
                node.link_tags += child.link_tags + (child.tag in ("a", "button"))
        if node.tag == "a":
            node.link_chars = node.chars
    body = nodes[-1]
    share = body.link_chars / max(body.chars, 1)
    for node in nodes:
        chars, tags = node.chars, max(node.tags, 1)
        links, link_tags = max(node.link_chars, 1), max(node.link_tags, 1)
        plain = max(chars - node.link_chars, 1)
        base = math.log(chars / plain * node.link_chars + share * chars + math.e)
        value = chars / links * tags / link_tags
        node.density = chars / tags * (math.log(value) / math.log(base) if value > 0 and base > 1 + 1e-9 and node.link_chars else 1.0)
        node.density_sum = sum(c.density for c in node.children if isinstance(c, Node) and not c.drop)
        # text that stands in the node itself counts as a child without tags
        node.density_sum += sum(len(c) for c in node.children if isinstance(c, str) and not c.isspace())
    return nodes


def _scope(node: Node) -> Node | None:
    """The outermost article or main element around a node, itself included."""
    own = _within(node, _MAIN)
    while own is not None and (outer := _within(own.parent, _MAIN)) is not None:
        own = outer
    return own


def _parts(node: Node, threshold: float) -> list[Node]:
    """The child nodes; text between blocks and outside of links that reaches the threshold is made one node, tags within it included."""
    out: list[Node] = []
    run: list[Node | str] = []
    for child in [*node.children, None]:
        if isinstance(child, str) or child is not None and child.tag not in BLOCKS:
            run.append(child)
            continue
        tags = [c for c in run if isinstance(c, Node) and not c.drop]
        own = sum(len(c) for c in run if isinstance(c, str) and not c.isspace())
        plain = own + sum(c.chars - c.link_chars for c in tags)
        if own and not node.linked and plain / max(sum(c.tags + 1 for c in tags), 1) >= threshold:
            made = Node("#run", node)
            made.children = run
            out.append(made)
        else:
            out += [c for c in tags if c.chars]
        if child is not None and not child.drop and child.chars:
            out.append(child)
        run = []
    return out


def select(root: Node) -> list[Node]:
    """Roots of the subtrees that make up the main text, in page order.

    The node with the largest density sum is the core. The smallest density on the path from the core to
    the body is the threshold: each node that reaches it gives the subtree with the largest density sum
    below it, and what lies beside that subtree is searched in the same way. Text between the blocks of a
    searched node counts as a node. A subtree within article or main elements is widened to the outermost of them;
    of a main, parts made of links that hold none of the subtrees stay outside.
    """
    nodes = [n for n in measure(root) if n.chars]
    if not nodes:
        return []
    core = max(nodes, key=lambda n: n.density_sum)
    threshold, node = core.density, core
    while node is not None:
        if node.tag in ("html", "#root"):
            break
        threshold = min(threshold, node.density)
        node = node.parent
    best: dict[int, Node] = {}
    for node in nodes:  # children come first
        below = [best[id(c)] for c in node.children if isinstance(c, Node) and id(c) in best]
        best[id(node)] = max([node, *below], key=lambda n: n.density_sum)
    marked, chosen, stack = {id(core)}, [], [root]
    while stack:
        node = stack.pop()
        if node.tag not in ("html", "#root", "body", "#run") and node.density >= threshold:
            marked.add(id(best[id(node)] if node.density_sum else node))
        if id(node) in marked or node.tag == "#run":
            chosen.append(node)
        else:
            stack.extend(reversed(_parts(node, threshold)))
    return _widened(chosen)


def _widened(chosen: list[Node]) -> list[Node]:
    """The subtrees, each within article or main replaced by the outermost of those, without the link lists of a main."""
    out: list[Node] = []
    holding: set[int] = set()
    picked = {id(c) for c in chosen}
    for node in chosen:
        if not node.in_main:
            out.append(node)
            continue
        if not out or out[-1] is not _scope(node):
            out.append(_scope(node))
        while node is not None and id(node) not in holding:
            holding.add(id(node))
            node = node.parent
    for main in out:
        stack = [main] if main.tag == "main" and id(main) in holding else []
        while stack:
            node = stack.pop()
            if id(node) not in holding:
                node.drop = node.link_tags > 1 and 2 * node.link_chars > node.chars
            elif node.tag != "article" and id(node) not in picked:
                stack.extend(c for c in node.children if isinstance(c, Node) and not c.drop and c.chars)
    return out


def blocks_of(node: Node) -> list[str]:
    """Text of each block: references decoded, white space made one space, trimmed; empty ones left out."""
    out: list[str] = []
    run: list[str] = []

    def close() -> None:
        text = _SPACES.sub(" ", "".join(run)).strip()
        run.clear()
        if text:
            out.append(text)

    stack: list[Node | str | None] = [node]
    while stack:
        item = stack.pop()
        if item is None:
            close()
        elif isinstance(item, str):
            run.append(html.unescape(item))  # a reference lies within one text node
        elif not item.drop:
            block = item.tag in BLOCKS or item.parent is None
            if block:
                close()
                stack.append(None)
            if item.tag == "br":
                run.append(" ")
            stack.extend(reversed(item.children))
    close()
    return out


def _is_notice(node: Node, blocks: list[str], page: int) -> bool:
    """Whether a small subtree outside of article and main speaks of cookies."""
    return not node.in_main and sum(map(len, blocks)) < SMALL * page and any(_COOKIES.search(b) for b in blocks)


def main_text(source: str | None) -> str:
    """The main text of a page, one line per block; empty if there is none."""
    if not source:
        return ""
    root = parse(source)
    drop_named(root)
    chosen = [(node, blocks_of(node)) for node in select(root)]
    page = sum(len(b) for _, blocks in chosen for b in blocks)
    return "\n".join(b for node, blocks in chosen if not _is_notice(node, blocks, page) for b in blocks)


def _extractor(html_at: int):
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in batch.column(html_at).to_pylist()]
            names = batch.schema.names
            kept = [i for i in range(len(names)) if i != html_at]
            new = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), *new], [f"c{i}" for i in range(len(kept) + 2)])

    return extract


def extract_text(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """The columns of ``pages`` without the html, then text and n_chars (its code points).

    Elements that never hold main text (navigation, headers, footers,
    asides, forms, adverts, notices, comments, scripts), told by tag, role, class or id,
    are left out of the tree; names count only where they do not hold the text of the page (``drop_named``). Of the rest, composite text density selects the main text, and all of
    its blocks are returned. One scan, no shuffle.

    Null and empty html give an empty text. Columns named text or n_chars are replaced. Repeated rows are each
    extracted; an empty table gives an empty result.
    """
    rows = pages.select(*[F.col(f"`{c}`") for c in pages.columns if c == html_col or c.lower() not in ("text", "n_chars")])
    kept = [c for c in rows.columns if c != html_col]
    types = [rows.schema[c].dataType.simpleString() for c in kept]
    schema = ", ".join(f"c{i} {t}" for i, t in enumerate([*types, "string", "long"]))
    return in_arrow(rows, _extractor(rows.columns.index(html_col)), schema).toDF(*kept, "text", "n_chars")
