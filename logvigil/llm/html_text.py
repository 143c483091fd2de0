"""Main text of web pages by composite text density."""

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logvigil.llm.common import slices

# A tag ends at its ``>`` outside quotes, or, where it was cut off, at the next ``<``. No part is read twice: the quantifiers give nothing back.
_TOKEN = re.compile(
    r"""<!--(?:(?!--!?>).)*+(?:--!?>)?|<(/?)([a-zA-Z][^\s/><]*+)((?:[^<>"']|(?<==)"[^"]*+"|(?<==)'[^']*+'|["'])*+)(?:>|(?=<)|\Z)|<[!?][^>]*+>?|(?:<(?![a-zA-Z/!?]))*+[^<]++|<++(?![a-zA-Z/!?])|<""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")

# Elements of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th"
    " thead tr ul caption".split()
)
NO_TEXT = frozenset(
    "script style head title template noscript nav footer aside form button select option textarea input label iframe"
    " object embed svg canvas audio video map dialog menu xmp noembed noframes".split()
)
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
BESIDE = frozenset("h1 h2 h3 h4 h5 h6 hgroup p ul ol dl blockquote pre table figure".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
NOISE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies"
    " consent gdpr notice notices alert popup modal overlay sidebar menu menus nav navbar navigation breadcrumb breadcrumbs"
    " footer masthead toolbar pagination pager comment comments commentlist respond disqus reply replies share sharing"
    " social related recommended newsletter subscribe subscription signup login search widget widgets skip".split()
)
#: What else a name may be made of that is noise inside an article.
NEUTRAL_NAMES = frozenset(
    "area bar block box btn button buttons container content form inner item items link links list outer panel post row section slot"
    " thread top bottom left right unit user wrap wrapper".split()
)
NOISE_PHRASES = ("side-bar", "site-header", "page-header", "top-bar", "skip-link", "read-more", "user-comment")


@dataclass(eq=False)
class Node:
    tag: str
    parent: "Node | None"
    noise: bool = False
    maybe: bool = False  # noise by form or class name, unless it holds the article
    inside: bool = False  # of an article or main element, or one itself
    items: list = field(default_factory=list)  # texts and nodes, in page order
    chars: int = 0
    tags: int = 0
    link_chars: int = 0
    link_tags: int = 0
    density: float = 0.0
    density_sum: float = 0.0

    def nodes(self) -> list["Node"]:
        return [x for x in self.items if isinstance(x, Node)]


def _noise(tag: str, attributes: str, parent: Node) -> tuple[bool, bool]:
    """Whether an element is no part of an article by its name or role, and whether it may be none as a form or by its class."""
    if tag in NO_TEXT and tag != "form":
        return True, False
    if tag == "header" and not parent.inside:
        return True, False
    if not attributes or attributes == "/":
        return False, tag == "form"
    values = {m[1].lower(): html.unescape((m[2] or "").strip("\"'")).lower() for m in _ATTRIBUTE.finditer(attributes)}
    if "hidden" in values or values.get("aria-hidden") == "true" or "display:none" in values.get("style", "").replace(" ", ""):
        return True, False
    if values.get("role") in NOISE_ROLES:
        return values["role"] != "form", True
    if tag == "form":
        return False, True
    if tag in ("html", "body", "main") or (tag == "article" and not parent.inside):
        return False, False
    names = f"{values.get('class', '')} {values.get('id', '')}"
    if parent.inside:
        return False, any(_all_noise(name) for name in names.split())
    return False, any(p in names for p in NOISE_PHRASES) or any(
        not NOISE_NAMES.isdisjoint(re.split(r"[^a-z0-9]+", name)) and not name.startswith(("no-", "has-", "with-")) for name in names.split()
    )


def _all_noise(name: str) -> bool:
    """Whether a name is made of noise alone: "comment-list" is, "search-results" and "notice-of-motion" aren't."""
    parts = [x for x in re.split(r"[^a-z]+", name) if x]
    return any(x in NOISE_NAMES for x in parts) and all(x in NOISE_NAMES or x in NEUTRAL_NAMES for x in parts)


def parse(page: str) -> Node:
    """The element tree of a page, lenient on missing and wrong end tags; noise has no content."""
    root = Node("html", None)
    top, at, n = root, 0, len(page)
    started: Counter = Counter()  # tags that were opened: an end tag of any other has nothing to close
    while at < n:
        m = _TOKEN.match(page, at)
        at = m.end()
        text = m[0]
        if m[2] is None:
            if text[0] != "<" or text == "<":
                top.items.append(html.unescape(text))
            continue
        tag = m[2].lower()
        if m[1]:
            node = top if started[tag] else None
            while node is not None and node.tag != tag:
                node = node.parent
            if node is not None and node.parent is not None:
                top = node.parent
            elif node is None:
                started[tag] = 0  # none is open
            if tag == "p" and (node is None or node.parent is None):
                top.items.append(Node("p", top))
            continue
        if tag == "html":
            continue
        if tag in BLOCK:
            top = _without(top, {"p"}, BLOCK - {"p"})
        if tag in CLOSES:
            top = _without(top, *CLOSES[tag])
        if tag in ("h1", "h2", "h3", "h4", "h5", "h6") and top.tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            top = top.parent
        noise, maybe = _noise(tag, m[3], top)
        node = Node(tag, top, top.noise or noise, maybe, top.inside or tag in ("article", "main"))
        top.items.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^<>]*+(?:>|(?=<)|\Z)|\Z", re.I).search(page, at)
            at = end.end()
        elif tag not in VOID and not m[3].endswith("/") or tag in BLOCK and tag not in VOID:
            top = node
            started[tag] += 1
    _settle(root)
    return root


def _settle(root: Node) -> None:
    """Makes noise of the elements that may be, unless they hold the article.

    An element holds it if more text of article and main elements is below it than outside of all such elements, or, where
    there is none outside, if it has most of the text. Text in links doesn't count.
    """
    nodes = _ordered(root)
    if not any(n.maybe for n in nodes):
        return
    text: dict[Node, int] = {}
    articles: dict[Node, int] = {}  # text of article and main elements
    clear: dict[Node, int] = {}  # the same, outside of elements below that may be noise
    for node in reversed(nodes):
        own = sum(len("".join(x.split())) for x in node.items if isinstance(x, str)) if node.tag != "a" else 0
        below = [c for c in node.nodes() if not c.noise] if node.tag != "a" else []
        text[node] = own + sum(text[c] for c in below)
        articles[node] = own * node.inside + sum(articles[c] for c in below)
        clear[node] = own * node.inside + sum(clear[c] for c in below if not c.maybe)
    known, stack = clear[root], [root]
    while stack:
        node = stack.pop()
        if node.noise:
            continue
        if node.maybe:
            if articles[node] > known or not known and 2 * text[node] > text[root]:
                known += clear[node]
            else:
                node.noise = True
                continue
        stack += reversed(node.nodes())


def _without(top: Node, closed: set, barrier) -> Node:
    """Closes the nearest element of ``closed``, unless one of ``barrier`` is nearer; of a chain of them all."""
    node = top
    while node.parent is not None:
        if node.tag in closed:
            return _without(node.parent, closed, barrier)
        if node.tag in barrier:
            break
        node = node.parent
    return top


def _ordered(root: Node) -> list[Node]:
    """All nodes that aren't noise, parents first."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if not node.noise:
            out.append(node)
            stack += reversed(node.nodes())
    return out


def measure(nodes: list[Node], body: Node) -> None:
    """Counts, composite densities and sums of child densities, children before parents."""
    for node in reversed(nodes):
        node.chars = sum(len("".join(x.split())) for x in node.items if isinstance(x, str))
        for child in node.nodes():
            if not child.noise:
                node.chars += child.chars
                node.tags += child.tags + 1
                node.link_chars += child.link_chars
                node.link_tags += child.link_tags + (child.tag == "a")
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.tags
    ratio = body.link_chars / max(1, body.chars)
    for node in nodes:
        node.density = _density(node, ratio)
    for node in nodes:
        node.density_sum = sum(c.density for c in node.nodes() if not c.noise)


def _density(node: Node, ratio: float) -> float:
    """Characters per tag times a logarithm that falls as links take over."""
    c, t, lc, lt = node.chars, max(1, node.tags), max(1, node.link_chars), max(1, node.link_tags)
    if not c:
        return 0.0
    base = math.log(c / max(1, c - node.link_chars) * node.link_chars + ratio * c + math.e)
    share = math.log(max(1.0, c / lc * t / lt))
    return c / t * share / math.log(base) if base > math.e ** 0.1 else c / t * share * 10


def main_nodes(root: Node) -> list[Node]:
    """The subtrees that hold the article, in page order.

    The threshold is the lowest density on the path from the node with the largest sum of child densities up to the
    body. Each node that reaches it gives its subtree with the largest sum, and so do its children outside
    of what is chosen, and theirs. Headings and paragraphs right beside a chosen subtree belong to it unless they are mostly links,
    since short ones never reach the threshold. A chosen subtree inside an article element stands for that whole element, headings included.
    """
    nodes = _ordered(root)
    body = next((n for n in nodes if n.tag == "body"), root)
    measure(nodes, body)
    inside = _ordered(body)
    if not body.chars:
        return []
    best = max(inside, key=lambda n: n.density_sum)
    if best.density_sum == 0:
        return [body]
    threshold, node = math.inf, best
    while node is not None and node is not body.parent:
        if node.chars:
            threshold = min(threshold, node.density)
        node = node.parent
    largest: dict[Node, Node] = {}  # per node, the subtree with the largest sum; the first of equal ones
    for node in reversed(inside):
        largest[node] = max([node, *[largest[c] for c in node.nodes() if not c.noise]], key=lambda n: n.density_sum)
    chosen: set[Node] = set()
    stack = [body]
    while stack:
        node = stack.pop()
        if node.noise or not node.chars or node in chosen:
            continue
        if node.density >= threshold:
            top = largest[node]
            top = node if top.density_sum == 0 else top
            whole = top
            while whole is not None and whole.tag != "article":
                whole = whole.parent
            chosen.add(whole or top)
            if node in chosen:
                continue
        stack += reversed(node.nodes())
    for parent in {n.parent for n in chosen if n is not body}:
        chosen.update(c for c in parent.nodes() if c.tag in BESIDE and not c.noise and c.chars > 2 * c.link_chars)
    return _topmost(body, chosen)


def _topmost(root: Node, chosen: set[Node]) -> list[Node]:
    """The chosen nodes that aren't below another one, in page order."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if node in chosen:
            out.append(node)
        elif not node.noise:
            stack += reversed(node.nodes())
    return out


def blocks(node: Node) -> list[str]:
    """Texts of the blocks below a node, white space turned into one space."""
    out: list[str] = []
    inline: list[str] = []

    def close() -> None:
        if text := " ".join("".join(inline).split()):
            out.append(text)
        inline.clear()

    stack: list = [node]
    while stack:
        item = stack.pop()
        if isinstance(item, str):
            inline.append(item)
        elif item is None:
            close()
        elif item.noise:
            inline.append(" ")
        elif item.tag == "br":
            inline.append(" ")
        else:
            if item.tag in BLOCK:
                close()
                stack.append(None)
            stack += reversed(item.items)
    close()
    return out


def main_text(page: str | None) -> str:
    """The article of a page, one block a line; empty if there is none."""
    if not page:
        return ""
    return "\n".join(b for node in main_nodes(parse(page)) for b in blocks(node))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for arrow in slices(batches, "_html"):
        texts = [main_text(x) for x in arrow.column("_html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [arrow.column("page"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page", "text", "n_chars"],
        )


def extract_main_text(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """One row per page: page (all its columns but the html), text, n_chars.

    Text is that of the elements that the density rule picks, without menus, headers, footers, sidebars, notices,
    adverts, forms, scripts, styles and comments, which are known by element, role, or class and id.

    NULL and empty pages, and pages without text, give an empty text. A page without tags is one block. Repeated
    rows give equal texts, no rows none. Pages may be of any length and nesting.
    """
    others = [c for c in pages.columns if c != html_col]
    rows = pages.select(F.struct(*others).alias("page"), F.col(html_col).cast("string").alias("_html"))
    return rows.mapInArrow(_extract, rows.select("page").schema.add("text", "string").add("n_chars", "long"))
