"""Main text of web pages by tree scoring (operator 7).

Every paragraph passes points for its length and its commas to its ancestors,
the nearer the more; a container's points are discounted by its link density.
The container with most points is kept, with those siblings that look like part
of the article.  Elements that never are text of the article (menus, forms,
scripts, adverts, notices, reader comments and the like) are left out before.

Cases.  Null html counts as empty; a page without text gives ''.  Broken
markup (unclosed elements, stray end tags, a page cut anywhere) is read as far
as it goes.  Pages are independent, so repeated rows give repeated results and
a long page costs time in proportion to its length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import slices, table, with_fields

# Fixed values of the HTML standard and of common page templates.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes")
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer
 form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul""".split())
LEFT_OUT = frozenset("""script style noscript template head title nav header footer aside form button select option input textarea label
 iframe object embed canvas svg math audio video dialog menu fieldset xmp noembed noframes""".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
UNLIKELY = frozenset("""ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs byline comment comments
 commentlist consent cookie cookies disclaimer discuss disqus feedback footer footnav gdpr header login masthead menu modal nav navbar navigation
 newsletter notice notices notification pager pagination paywall popup promo promoted promotion related recommended register replies reply
 respond rss search share sharing shoutbox sidebar sidenav signin signup skip social sponsor sponsored subscribe subscription teaser
 toolbar topbar tracking tweet warning widget widgets""".split())
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "option": ({"option"}, {"select"})}
TABLE = frozenset(("table", "tbody", "thead", "tfoot", "tr", "td", "th"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
PARAGRAPHS = frozenset(("p", "pre", "td", "blockquote", "li", "dd"))

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+(?=>|\Z)|[^>]*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Element:
    __slots__ = ("tag", "parent", "children", "points", "size", "linked", "commas", "own")

    def __init__(self, tag: str, parent: Element | None) -> None:
        self.tag, self.parent = tag, parent
        self.children: list[Element | str] = []
        self.points = 0.0
        self.size = self.linked = self.commas = 0


def left_out(tag: str, attributes: str) -> bool:
    if tag in LEFT_OUT:
        return True
    if not attributes or tag in ("html", "body", "article", "main"):
        return False
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in ("class", "id"):
            if any(part.lower() in UNLIKELY for part in PART.findall(value)):
                return True
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and HIDDEN.search(value):
            return True
        elif name == "role" and value.lower() in ROLES:
            return True
    return False


def parse(html: str) -> Element:
    """The tree of a page, without what is left out."""
    root = top = Element("html", None)
    at, n = 0, len(html)
    skipped: list[str] = []  # open elements inside one that is left out
    lower = None
    while at < n:
        m = TOKEN.search(html, at)
        stop = m.start() if m else n
        if stop > at and not skipped:
            top.children.append(unescape(html[at:stop]))
        if not m:
            break
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if skipped:
                if tag in skipped:
                    while skipped.pop() != tag:
                        pass
                    continue
                if not _ends_skip(tag, skipped, top):
                    continue
                skipped.clear()  # the end of an open ancestor, or of the page
            place = top
            while place is not None and place.tag != tag:
                place = place.parent if not (tag not in BLOCK and place.tag in BLOCK) else None
            if place is not None and place.parent is not None:
                top = place.parent
            continue
        if tag in RAW:
            if lower is None:
                lower = html.lower() if len(html.lower()) == n else re.sub("[A-Z]", lambda c: c[0].lower(), html)
            end = lower.find(f"</{tag}", at)
            if end < 0:
                break
            at = lower.find(">", end) + 1 or n
            continue
        if skipped:
            _imply_ends(tag, skipped, top)
        if tag in VOID:
            if not skipped and tag in ("br", "hr"):
                top.children.append(" " if tag == "br" else Element("hr", top))
            continue
        closed = m[3].endswith("/") and tag not in BLOCK
        if skipped:
            if not closed:
                skipped.append(tag)
            continue
        if left_out(tag, m[3]):
            if tag in BLOCK:
                top = _close_paragraph(top)
                top.children.append(Element("hr", top))
            if not closed:
                skipped.append(tag)
            continue
        if tag in BLOCK:
            top = _close_paragraph(top)
        if tag in CLOSES:
            top = _close(top, *CLOSES[tag])
        if tag in ("html", "body") and root.children and tag == "html":
            continue
        element = Element(tag, top)
        top.children.append(element)
        if not closed:
            top = element
    return root


def _imply_ends(tag: str, skipped: list[str], top: Element) -> None:
    """Ends what the start of ``tag`` ends inside a left-out element; that itself, or an ancestor, may be among it."""
    if tag in BLOCK:
        for k in range(len(skipped) - 1, -1, -1):
            if skipped[k] == "p":
                del skipped[k:]
            if k >= len(skipped) or skipped[k] in BLOCK:
                break
        else:
            if _close_paragraph(top) is not top:
                skipped.clear()
    if skipped and tag in CLOSES:
        which, scope = CLOSES[tag]
        first = len(skipped)
        for k in range(len(skipped) - 1, -1, -1):
            if skipped[k] in scope:
                break
            if skipped[k] in which:
                first = k
        else:
            inner = tag in ("li", "dt", "dd") and any(x in BLOCK and x not in ("address", "div", "p") for x in skipped)
            if first == len(skipped) and not inner and _close(top, which, scope) is not top:
                first = 0
        del skipped[first:]


def _ends_skip(tag: str, skipped: list[str], top: Element) -> bool:
    """Whether an end tag belongs to an open ancestor of the left-out element."""
    if tag in ("body", "html"):
        return True
    if "table" in skipped or tag not in TABLE and any(x in ("td", "th", "caption") for x in skipped):
        return False  # cells are closed to other end tags
    if tag == "li" and any(x in CLOSES["li"][1] for x in skipped):
        return False
    if tag not in BLOCK and any(x in BLOCK for x in skipped):
        return False
    place = top
    while place is not None and place.tag != tag:
        place = place.parent if not (tag not in BLOCK and place.tag in BLOCK) else None
    return place is not None and place.parent is not None


def _close_paragraph(top: Element) -> Element:
    place = top
    while place is not None and place.tag != "p":
        if place.tag in BLOCK:
            return top
        place = place.parent
    return place.parent if place is not None and place.parent is not None else top


def _close(top: Element, which: set[str], scope: set[str]) -> Element:
    place = top
    while place is not None and place.tag not in scope:
        if place.tag in which and place.parent is not None:
            top = place.parent
            if place.tag in ("tr", "li", "dt", "dd", "option"):
                return top
        place = place.parent
    return top


def measure(root: Element) -> list[Element]:
    """Sums text, linked text and commas up the tree; all elements, ancestors first."""
    order, stack = [], [root]
    while stack:
        e = stack.pop()
        order.append(e)
        stack += [c for c in e.children if not isinstance(c, str)]
    for e in reversed(order):
        own = " ".join(" ".join(c for c in e.children if isinstance(c, str)).split())
        e.own = len(own)
        e.size += len(own)
        e.commas += sum(map(own.count, (",", "،", "、", "，")))
        if e.tag == "a":
            e.linked = e.size
        if e.parent is not None:
            e.parent.size += e.size
            e.parent.linked += e.linked
            e.parent.commas += e.commas
    return order


def link_density(e: Element) -> float:
    return e.linked / e.size if e.size else 0.0


def best_container(order: list[Element], min_size: int = 25) -> Element:
    """The element with most points (the outer one of equals)."""
    holders = []
    for e in order:
        direct = e.own >= min_size and e.tag not in PARAGRAPHS and e.tag in BLOCK
        if (e.tag in PARAGRAPHS or direct) and e.size >= min_size:
            points = (1 + e.commas + min(e.size / 100, 3)) * (1 - link_density(e))
            place, share = (e if direct else e.parent), 1.0
            while place is not None and share > 0.05:
                if place.tag not in PARAGRAPHS or direct:
                    place.points += points * share
                    share /= 2
                    holders.append(place)
                place = place.parent
    best, most = order[0], 0.0
    for e in order:
        if e.points:
            points = e.points * (1 - link_density(e)) * (3 if e.tag in ("article", "main") else 1)
            if points > most and e.tag != "html":
                best, most = e, points
    best.points = most or 1.0
    return best


def joins_article(e: Element, best: Element) -> bool:
    """Whether a sibling of the best container is kept with it."""
    if e.tag in HEADINGS:
        return link_density(e) < 0.3
    if e.points * (1 - link_density(e)) >= max(4.0, 0.2 * best.points):
        return True
    return e.tag == "p" and (e.size > 80 and link_density(e) < 0.25 or e.size > 0 and not e.linked)


def blocks(e: Element, out: list[str]) -> None:
    """The text blocks below an element in page order; an explicit stack, as broken pages nest deeply."""
    parts: list[str] = []

    def flush() -> None:
        text = " ".join("".join(parts).split())
        if text:
            out.append(text)
        parts.clear()

    stack: list[Element | str | None] = [e]
    while stack:
        x = stack.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            parts.append(x)
        else:
            if x.tag in BLOCK:
                flush()
                stack.append(None)
            stack += reversed(x.children)
    flush()


def main_text(html: str | None) -> str:
    """The article of a page, its blocks joined by one newline."""
    if not html:
        return ""
    root = parse(html)
    best = best_container(measure(root))
    out: list[str] = []
    if best.parent is None or best.tag in ("body", "html"):
        blocks(best, out)
    else:
        for e in best.parent.children:
            if e is best or not isinstance(e, str) and joins_article(e, best):
                blocks(e, out)
    return "\n".join(out)


def extract(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """The columns of ``pages`` but the html, with the main text."""
    rest = pages.drop(text) if text != html else pages
    kept = [f for f in rest.schema if f.name != html]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, html):
            found = [main_text(x) for x in batch.column(batch.schema.get_field_index(html)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in names),
                                              pa.array(found, pa.string())], [*names, text])

    return rest.mapInArrow(run, with_fields(kept, f"`{text}` string"))


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages).withColumn("n_chars", F.char_length("text").cast("long"))
