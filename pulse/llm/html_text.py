"""Main text of HTML pages by tree scoring.

The page becomes a light element tree.  Elements that never hold the article
(scripts, styles, navigation, page headers and footers, asides, forms,
hidden parts) and elements whose class, id or role names a menu, sidebar,
advert, notice or reader comments are cut out.  Where only one part of a longer
name says so and the word has other meanings (market-share, side-by-side), the
text decides: inside the article a paragraph of some length and few links keep
the part, elsewhere more running text than the rest of the page has; a single
paragraph, heading or list item of such a name stays.  A form around the page's body
is no such part: one that holds the article, <main> or <h1>, or more running
text than the rest of the page, loses only its controls.  Every paragraph then scores
points (one, one per comma, one per hundred characters up to three) and
passes them on: all to its parent, half to its grandparent, a third of that
share further up.  A container's points are discounted by its link density.
The best container is kept; of its siblings those whose own points reach a
fifth of the winner's, and paragraphs of some length with few links.

Text comes out in page order as blocks: runs of text between block element
borders, character references decoded, white space runs one space, trimmed,
joined by an empty line.  Nothing else is dropped or shortened.

Broken markup is read leniently: unclosed elements end with their parent, an
open paragraph ends where the next block begins, a tag cut off at the end of
the page is ignored.  A null or blank page gives the empty text; repeated rows
are extracted alike; an empty table gives an empty result.  The page tree is
the only state, so memory is bounded by the page.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.llm.common import ship

ship(__name__)

# --- fixed values: element names of HTML -----------------------------------------------------------------
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe noembed xmp svg math".split())
CUT = frozenset("head script style noscript template textarea title iframe noembed svg math nav footer aside form "
                "button select option dialog menu object embed canvas audio video map".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
                  "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section "
                  "summary table tbody td tfoot th thead tr ul caption search".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
TEXTUAL = HEADINGS | {"p", "pre", "blockquote", "li", "dd", "td"}
ENDS_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
           "th": ("td", "th"), "option": ("option",)}
SCOPE = frozenset("ul ol dl table article section div main body html blockquote".split())
#: Words of a class, id or role that name something beside the article.
BESIDE = frozenset("ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion "
                   "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toolbar "
                   "sidebar side aside widget related recommended recommendations "
                   "footer foot masthead topbar siteheader sitefooter "
                   "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe signup "
                   "subscription paywall login comment comments commentlist disqus replies reply respond "
                   "share sharing social copyright complementary contentinfo search skip hidden".split())
#: Those that name other things too when they are one part of a longer name, as in market-share or recipe-menu.
WEAK = frozenset("side share sharing skip search menu foot hidden widget".split())
# -----------------------------------------------------------------------------------------------------------
#: Inside the article a part with a weak name stays if it has a paragraph of this length and no more than this share of links.
RUNNING, LINKS = 60, 0.3

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                   r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(>|\Z)", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|style|aria-hidden)\b\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
NAME = re.compile(r"[a-z]+")
HUMP = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Node:
    __slots__ = ("tag", "parent", "parts", "cut", "named", "weak", "points")

    def __init__(self, tag: str, parent: Node | None, cut: bool):
        self.tag, self.parent, self.parts, self.cut, self.points = tag, parent, [], cut, 0.0
        self.named = False  # cut for its class, id or role only
        self.weak = False   # cut unless its text says otherwise


def _beside(attributes: str) -> tuple[bool, bool]:
    """Whether the element is named as something beside the article, and whether only a part of a longer name says so."""
    weak = False
    for name, value in ATTRIBUTE.findall(attributes):
        name, written = name.lower(), value.strip("\"'")
        value = written.lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True, False
        if name == "style":
            if "display:none" in value.replace(" ", ""):
                return True, False
        elif name != "aria-hidden":
            # the names or their parts, for site-footer, cookieNotice and the like
            found = BESIDE.intersection(NAME.findall(value)) | BESIDE.intersection(x.lower() for x in HUMP.findall(written))
            if found - WEAK or found.intersection(value.split()):
                return True, False
            weak = weak or bool(found)
    return weak, weak


def parse(page: str) -> Node:
    """The element tree; a node's parts are texts and nodes in page order."""
    root = Node("#page", None, False)
    at, here, end, articles = root, 0, len(page), 0
    forms: list[Node] = []
    weak: list[Node] = []
    while here < end:
        mark = TOKEN.search(page, here)
        if mark is None:
            at.parts.append(page[here:])
            break
        if mark.start() > here:
            at.parts.append(page[here:mark.start()])
        here = mark.end()
        tag = (mark[2] or "").lower()
        if not tag or not mark[4]:
            continue
        if mark[1]:
            node = at
            while node is not root and node.tag != tag:
                node = node.parent
            if node is not root:
                at = node.parent
            elif tag == "p":
                at.parts.append(Node("p", at, False))
            continue
        if tag in BLOCK:
            at = _close(at, ("p",), SCOPE | HEADINGS | {"li", "td", "th", "dd", "dt"})
        if tag in ENDS_BY:
            at = _close(at, ENDS_BY[tag], SCOPE)
        cut = tag in CUT or (tag == "header" and not _inside(at, ("article", "main")))
        node = Node(tag, at, cut)
        if not cut and tag not in ("body", "html", "main"):
            node.named, node.weak = _beside(mark[3])
            if node.weak and tag in TEXTUAL:
                node.named = node.weak = False
            node.cut = node.named and not node.weak
            weak += [node] if node.weak else []
        at.parts.append(node)
        if tag in ("main", "h1") or (tag == "article" and not articles):
            _uncut(node if tag == "article" else at, tag)  # a layout named after its sidebar still holds the article
        articles += tag == "article"
        if tag == "form":
            forms.append(node)
        closed = mark[3].rstrip().endswith("/")
        if tag in RAW and not (closed and tag in ("svg", "math")):
            close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, here)
            here = close.end() if close else end
        elif tag not in VOID and not closed:
            at = node
    weak = [x for x in weak if x.weak]
    for node in reversed(weak):  # inner ones first
        node.cut = not _inside(node, ("article", "main")) or not _running(node)
    wrapped = [x for x in forms + weak if x.cut]
    if wrapped:
        _unwrap(root, wrapped)
    return root


def _uncut(node: Node | None, tag: str) -> None:
    """Keeps what holds the article: elements cut for their names, forms, and anything around <main>."""
    while node is not None:
        if node.named or tag == "main" or (node.tag == "form" and not _inside(node, ("article", "main"))):
            node.cut = node.named = node.weak = False
        node = node.parent


def _running(node: Node) -> bool:
    """Whether a part has a paragraph of some length and few links."""
    inside, sizes = _measure(node)
    length, linked = sizes[id(node)]
    return linked <= LINKS * length and any(sizes[id(x)][0] >= RUNNING for x in inside if x.tag in ("p", "pre", "blockquote"))


def _unwrap(root: Node, cut: list[Node]) -> None:
    """Keeps the cut forms and weakly named parts that hold more running text than the page beside them."""
    sizes = _measure(root)[1]
    for form in cut:
        inside, lengths = _measure(form)
        # a paragraph inside another is counted once
        running = sum(lengths[id(x)][0] for x in inside if x.tag in ("p", "pre", "blockquote")
                      and not _inside(x.parent, ("p", "pre", "blockquote")))
        if running > sizes[id(root)][0] and not _inside(form, ("article", "main")):
            form.cut = False


def _close(at: Node, tags: tuple[str, ...], stop: frozenset) -> Node:
    """Ends the nearest open element of ``tags``, unless one of ``stop`` is open inside it."""
    node = at
    while node.parent is not None:
        if node.tag in tags:
            return node.parent
        if node.tag in stop:
            return at
        node = node.parent
    return at


def _inside(node: Node | None, tags: tuple[str, ...]) -> bool:
    while node is not None:
        if node.tag in tags:
            return True
        node = node.parent
    return False


def _blocks(top: Node) -> list[str]:
    """The texts between block borders below a node, without cut parts."""
    out: list[str] = []
    run: list[str] = []

    def flush() -> None:
        text = " ".join(html.unescape("".join(run)).split())
        if text:
            out.append(text)
        run.clear()

    stack: list = [iter((top,))]
    closing: list[bool] = []
    while stack:
        part = next(stack[-1], None)
        if part is None:
            stack.pop()
            if closing and closing.pop():
                flush()
        elif isinstance(part, str):
            run.append(part)
        elif part.cut:
            if part.tag in BLOCK:
                flush()
        else:
            if part.tag == "br":
                run.append(" ")
            block = part.tag in BLOCK
            if block:
                flush()
            parts = part.parts
            if part.tag == "header":
                parts = [x for x in parts if isinstance(x, Node) and x.tag in HEADINGS | {"hgroup"}]
            stack.append(iter(parts))
            closing.append(block)
    flush()
    return out


def _measure(root: Node) -> tuple[list[Node], dict[int, tuple[int, int]]]:
    """Nodes in page order (cut parts left out), and per node its text length and linked length."""
    order: list[Node] = []
    stack = [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(x for x in reversed(node.parts) if isinstance(x, Node) and not x.cut)
    sizes: dict[int, tuple[int, int]] = {}
    for node in reversed(order):
        text = linked = 0
        for part in node.parts:
            if isinstance(part, str):
                text += len(part.strip())
            elif not part.cut:
                a, b = sizes[id(part)]
                text, linked = text + a, linked + b
        sizes[id(node)] = (text, text if node.tag == "a" else linked)
    return order, sizes


def main_text(page: str | None) -> str:
    """The article's text blocks, joined by an empty line."""
    if not page or not page.strip():
        return ""
    root = parse(page)
    order, sizes = _measure(root)
    scored: list[Node] = []
    for node in order:
        own = "".join(x for x in node.parts if isinstance(x, str))
        paragraph = node.tag in ("p", "pre", "blockquote", "td", "li", "dd")
        if not paragraph and not (node.tag in BLOCK and own.strip() and node.tag not in HEADINGS):
            continue
        length, linked = sizes[id(node)]
        if not length:
            continue
        points = (1 + own.count(",") + min(length / 100, 3)) * (1 - linked / length)
        above, share, level = (node.parent if paragraph else node), 1.0, 0
        while above is not None:
            if above.tag not in ("#page", "html"):
                above.points += points * share
                scored.append(above)
            level += 1
            share = 0.5 if level == 1 else 0.5 / (3 * (level - 1))
            above = above.parent
    best, most = None, 0.0
    for node in dict.fromkeys(scored):
        length, linked = sizes[id(node)]
        value = node.points * (1 - linked / max(length, 1)) + (25 if node.tag in ("article", "main") else 0)
        node.points = value
        if value > most:
            best, most = node, value
    if best is None:
        return "\n\n".join(_blocks(root))
    while best.parent is not None and best.tag in ("p", "ul", "ol", "dl", "table", "tbody", "tr", "td", "blockquote", "li"):
        best = best.parent  # a list or a table is part of an article, not the whole of it
    kept = [best]
    if best.parent is not None and best.tag not in ("body", "html", "#page"):
        kept = [x for x in best.parent.parts if isinstance(x, Node) and not x.cut
                and (x is best or _belongs(x, most, sizes))]
    return "\n\n".join(b for node in kept for b in _blocks(node))


def _belongs(node: Node, most: float, sizes: dict) -> bool:
    length, linked = sizes[id(node)]
    if not length:
        return False
    if node.points >= max(10.0, most / 5):
        return True
    density = linked / length
    return node.tag == "p" and (density < 0.25 if length > 80 else density == 0)


def extract(pages: DataFrame, html_col: str = "html", out: str = "text") -> DataFrame:
    """The input with the main text of every page in column ``out``."""
    @F.pandas_udf("string")
    def article(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(main_text, na_action=None)

    return pages.withColumn(out, article(F.col(f"`{html_col}`")))


def op2_query(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
