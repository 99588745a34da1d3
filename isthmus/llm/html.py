"""Main text of web pages by composite text density (operator 10).

One pass over the tags builds the tree of block elements; inline tags only add to the counts of the block that holds them. Elements
whose name or role says that they are no article (menus, page headers and footers, sidebars, notices, adverts, forms, scripts, reader
comments, hidden parts) are left out of the tree; words of a class or id say so too, but inside an article or main element only the plain
ones do (SAYS_NOT), and words that an article's own parts may have (MAY_NOT) are left to the density. Every node has characters C, tags T,
and of them those in links, LC and LT; its composite density is C / T, adjusted for links against the body's share of links (Sun, Song
and Liao, 2011). The subtree whose children's densities have the greatest sum is the article, or the outermost article or main element
around it, which is kept whole. The least density on its path up to the body is the threshold: every other part of the page that is at
least as dense joins the article, with the sparser text blocks beside it under one parent and headings before the article; lists of links
below it leave, but for those inside an article or main element.

Null, empty and textless pages have an empty text. Ties go to the outermost subtree. Repeated rows are extracted each; a null id or url stays
null. Pages of any length and depth are taken whole, in one pass.
"""

from __future__ import annotations

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isthmus.llm.common import dealt, read, tidy

# Element names of HTML by what they mean here, and words of class, id and role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template svg math".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li listing main menu nav ol optgroup option p plaintext pre search section summary table tbody td tfoot th thead tr caption ul".split())
CLOSES_P = BLOCK - {"body", "html", "option", "optgroup", "legend", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
DROP = frozenset("nav footer aside form button select datalist dialog menu head object audio video canvas map fieldset search".split())
SAYS_NOT = frozenset(
    "ad ads advert advertisement adverts advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices popup modal overlay "
    "sidebar aside nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager toolbar topbar masthead footer site-header comment comments commentlist "
    "discussion disqus replies reply respond share sharing social related recommended recommendations newsletter subscribe subscription signup login search "
    "hidden complementary contentinfo".split()
)
MAY_NOT = frozenset("side rail widget widgets copyright legal disclaimer tags toc alert foot header".split())
SAYS_YES = frozenset("article content main body text story post entry".split())
TEXT = frozenset("p h1 h2 h3 h4 h5 h6 hgroup ul ol li dl dt dd pre listing blockquote figure".split())
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "tbody": ("tr", "td", "th", "tbody", "thead"), "tfoot": ("tr", "td", "th", "tbody", "thead")}
FENCE = {"li": ("ul", "ol", "menu", "dir"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",), "tbody": ("table",), "tfoot": ("table",)}

TOKEN = re.compile(r"<!--(?:.*?-->|.*\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
ATTRS = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?(?=[\s/]|$)", re.I)
WORDS = re.compile(r"[a-z]+(?:-header)?")


class Node:
    __slots__ = ("tag", "up", "items", "c", "t", "lc", "lt", "drop", "density", "links", "inside")

    def __init__(self, tag: str, up: Node | None, drop: bool = False) -> None:
        self.tag, self.up, self.drop = tag, up, drop
        self.items: list[Node | str] = []
        self.c = self.t = self.lc = self.lt = self.links = 0
        self.density = 0.0
        #: Whether it is an article or main element, or within one.
        self.inside = tag in ("article", "main") or up is not None and up.inside


def dropped(tag: str, attrs: str, up: Node) -> bool:
    """Whether an element under ``up`` says by its name or attributes that it is no article."""
    if tag in DROP or tag == "header" and not up.inside:
        return True
    if not attrs or tag in ("body", "html"):
        return False
    said = set()
    for name, a, b, c in ATTRS.findall(attrs):
        name, value = name.lower(), a or b or c
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        said.update(WORDS.findall(value.lower()))
    if tag in ("article", "main"):
        return bool(said & {"comment", "comments"})
    not_it = said & SAYS_NOT or not up.inside and said & MAY_NOT
    return bool(not_it) and not (said & SAYS_YES and not said & {"comment", "comments", "ad", "ads", "advert", "sidebar", "nav", "menu", "footer"})


def tree(page: str) -> Node:
    """The block tree; tags left open close where HTML closes them, or at the end."""
    root = Node("html", None)
    at, links, pos, n = root, 0, 0, len(page)
    while pos < n:
        m = TOKEN.search(page, pos)
        if not m:
            add(at, page[pos:], links)
            break
        if m.start() > pos:
            add(at, page[pos : m.start()], links)
        pos = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            if tag == "a":
                links = 0
            elif tag == "br":
                add(at, " ", 0)
            elif tag in BLOCK or tag in DROP:
                node = at
                while node and node.tag != tag:
                    node = node.up
                if node and node.up:
                    at, links = node.up, 0
            continue
        attrs = m[3] or m[6] or ""
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(page, pos)
            if not attrs.rstrip().endswith("/") or tag not in ("svg", "math"):
                pos = end.end() if end else n
            continue
        if tag == "a":
            links = 1
            at.lt += 1
            at.links += 1
        if tag in BLOCK or tag in DROP or tag == "header":
            if tag in ("html", "body"):
                continue
            links = 0
            if tag in CLOSES_P:
                at = close(at, ("p",), ())
            if tag in SIBLINGS:
                at = close(at, SIBLINGS[tag], FENCE[tag])
            if tag in ("article", "main"):
                up = at
                while up:
                    if up.tag in ("nav", "header", "aside"):
                        at = up.up
                    up = up.up
            node = Node(tag, at, dropped(tag, attrs, at))
            node.t = 1
            at.items.append(node)
            if tag not in VOID:
                at = node
        else:
            at.t += 1
            if tag == "br":
                add(at, " ", 0)
            elif tag not in VOID and attrs and dropped(tag, attrs, at):
                node = Node(tag, at, True)  # an inline element that says it is no text, up to its end tag
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, pos)
                if end:
                    pos = end.end()
    return root


def close(at: Node, tags: tuple[str, ...], fence: tuple[str, ...]) -> Node:
    """Closes the nearest open element of these, unless one of the fence stands between."""
    node = at
    stops = fence or ("td", "th", "table", "button", "article", "section", "div", "ul", "ol", "blockquote")
    while node.up:
        if node.tag in tags:
            at = node.up
            if not fence:
                return at
        elif node.tag in stops:
            break
        node = node.up
    return at


def add(at: Node, text: str, links: int) -> None:
    if "&" in text:
        text = html.unescape(text)
    at.items.append(text)
    size = len(text) - text.count(" ")
    at.c += size
    if links:
        at.lc += size


def measure(root: Node) -> list[Node]:
    """Counts of every node that is kept, children before parents, then composite densities."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        node.items = [x for x in node.items if isinstance(x, str) or not x.drop]
        order.append(node)
        stack.extend(x for x in node.items if not isinstance(x, str))
    order.reverse()
    for x in order:
        if x.up:
            for k in ("c", "t", "lc", "lt", "links"):
                setattr(x.up, k, getattr(x.up, k) + getattr(x, k))
    share = root.lc / max(root.c, 1)
    for x in order:
        if x.c:
            base = math.log(x.c / max(x.c - x.lc, 1) * x.lc + share * x.c + math.e)
            x.density = x.c / max(x.t, 1)
            if base > 1 + 1e-9:
                x.density *= math.log(max(x.c / max(x.lc, 1) * max(x.t, 1) / max(x.lt, 1), 1.0)) / math.log(base)
    return order


def density_sum(x: Node) -> float:
    """Of its children; a block's own text, with the inline tags in it, counts as a child."""
    inner = [i for i in x.items if not isinstance(i, str)]
    if not inner:
        return x.density
    own = sum(len(i) - i.count(" ") for i in x.items if isinstance(i, str) and not i.isspace())
    return sum(i.density for i in inner) + own / max(1, x.t - sum(i.t for i in inner))


def blocks(x: Node, floor: float, out: list[str]) -> None:
    """Blocks of a subtree in page order; iterative, so that no depth of a page matters."""
    line: list[str] = []
    stack: list = [iter(x.items)]

    def flush() -> None:
        if text := " ".join("".join(line).split()):
            out.append(text)
        line.clear()

    while stack:
        item = next(stack[-1], None)
        if item is None:
            stack.pop()
            if not stack or stack[-1].__class__ is not _Cells:
                flush()
            else:
                line.append(" ")
        elif isinstance(item, str):
            line.append(item)
        elif item.inside or not (item.links >= 2 and item.density < floor and item.lc > 0.6 * item.c):
            if item.tag in ("td", "th"):
                line.append(" ")
            else:
                flush()
            stack.append(_Cells(item.items) if item.tag == "tr" else iter(item.items))
    flush()


class _Cells:
    """An iterator over a table row, whose cells stay in one block."""

    def __init__(self, items: list) -> None:
        self.it = iter(items)

    def __next__(self):
        return next(self.it)


def prune(order: list[Node], path: list[Node], floor: float) -> None:
    """Leaves in the tree the article (the first of path, which leads up to the body), headings beside the path, and every other part
    that reaches the threshold. Where text blocks are taken, the sparser ones of the same parent belong to them."""
    best, above = path[0], {id(x): inner for inner, x in zip(path, path[1:], strict=False)}
    whole: set[int] = set()
    for x in reversed(order):  # parents first
        if x is best or id(x.up) in whole or id(x) not in above and x.density >= floor and x.density > 0:
            whole.add(id(x))
    holds = set(whole)
    for x in order:
        if id(x) in whole:
            continue
        inner = [i for i in x.items if not isinstance(i, str)]
        own = sum(len(i) - i.count(" ") for i in x.items if isinstance(i, str) and not i.isspace())
        said = own > 0 and own / max(1, x.t - sum(i.t for i in inner)) >= floor > 0
        at = [k for k, i in enumerate(x.items) if (said and not i.isspace() if isinstance(i, str) else id(i) in holds)]
        if not at:
            continue
        taken = set(at)
        if said or any(id(i) in holds and (i.tag in TEXT or i.tag == "section" and x.up or i.tag == "div" and all(isinstance(j, str) for j in i.items)) for i in inner):
            taken.update(range(at[0], at[-1] + 1))
            taken.update(k for k, i in enumerate(x.items) if isinstance(i, str) or i.tag in TEXT or i.tag == "table")
        if id(x) in above:
            for k, i in enumerate(x.items):
                if i is above[id(x)]:
                    break
                if not isinstance(i, str) and i.tag in ("h1", "hgroup", "header") and i.density >= min(floor, 1.0):
                    taken.add(k)
        x.items = [i for k, i in enumerate(x.items) if k in taken]
        x.links = 0  # what it holds was taken, so it is no list of links
        holds.add(id(x))


def densest(order: list[Node]) -> Node:
    """The node whose children's densities have the greatest sum; of equals the outermost. Children come before parents."""
    best, most = order[-1], -1.0
    for x in order:
        if (s := density_sum(x)) >= most:
            best, most = x, s
    return best


def main_text(page: str | None) -> str:
    """The article's blocks joined by two \\n; '' for null, empty or textless pages."""
    if not page:
        return ""
    root = tree(page)
    order = measure(root)
    if not root.c:
        return ""
    path = [densest(order)]
    while path[-1].up:
        path.append(path[-1].up)
    floor = min(x.density for x in path)
    # the outermost article or main is the article, whatever part of it is densest
    first = max((k for k, x in enumerate(path) if x.tag in ("article", "main")), default=0)
    prune(order, path[first:], floor)
    out: list[str] = []
    blocks(root, floor, out)
    return "\n\n".join(out)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row of pages (page_id, url, html)."""

    @tidy
    def run(batches):
        for batch in batches:
            texts = [main_text(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op10_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, from its whole html."""
    return extract(dealt(read(spark, sf_dir, "pages")))
