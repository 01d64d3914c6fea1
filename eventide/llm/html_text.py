"""Main text of a web page by composite text density.

The page becomes a tree of elements; end tags that authors leave out are
implied.  What can not be article text is pruned first:

* scripts, styles, forms, menus, asides, footers and the like by their tag, and
  what is hidden or has such a role;
* elements with a class or id that is, as a whole name, one of such furniture
  (``sidebar``, ``site-footer``, ``ad-box``): every part of the name must be a
  word of furniture or of layout, so ``related-work`` is none.  Headings and
  inline elements are never told by names, nor sections of an article with
  an article's paragraphs;
* reader comments, by name, role or microdata in any mark-up, articles within
  them included, and what follows a heading that says no more than "Comments".

Furniture that holds an article, main element or h1 stays only if the page has
none elsewhere and most of its text is in it; a page header stays for the only h1.

Every remaining block element gets its number of characters and tags, and of
those inside links; inline mark-up counts as the text of its block.  Its composite density is the characters per tag, damped by a
logarithm whose base grows with the share of link text, as in the published
method of content extraction via text density.  The element whose children's
densities have the largest sum is the article's core; the least density on its
path to the body is the page's threshold; of each element that reaches it, as
all above it do, the element below with the largest sum is marked.  Content is,
for each child of the body, the whole container of its marked elements: the
article they stand in, else the main element, else the least one that also has
a headline, else the least one.  Text directly in the body is content unless it
is mostly links.  When no container has a headline, one outside is content, and
so are the blocks of the body behind it that are mostly plain text and no
copyright line.

Text: character references are decoded, each block is one line (``br`` ends a
block), white space inside a block is one space, empty blocks are left out.

Defined results: null, empty and text-less pages give an empty string; a page
without a body element is all body; an unclosed comment or script runs to the
end of the page; pages of any length are worked on whole, in time in proportion;
of elements with equal density sums the one that begins first counts as the
largest; equal rows get equal texts; an empty table gives no rows, and other
columns are not touched.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Element names by what they mean for the tree and the text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe xmp noembed noframes".split())
DROPPED = RAW | frozenset("head nav footer aside form button select svg canvas object dialog menu".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul br".split()
)
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",),
}
LIMITS = {
    "li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"),
    "th": ("tr", "table"), "option": ("select",),
}
FURNITURE = frozenset(
    "ad ads advert advertisement advertising adverts breadcrumb breadcrumbs consent cookie cookies footer gdpr menu modal "
    "nav navbar navigation newsletter notice notices popup promo promoted promotion related share sharing sidebar social "
    "sponsor sponsored subscribe subscription toolbar widget widgets".split()
)
PAGE_HEADER = frozenset("banner header masthead".split())
COMMENT_WORDS = frozenset(
    "comment comments commentlist disqus pingback pingbacks replies reply respond responses trackback trackbacks".split()
)
LAYOUT = frozenset(
    "area bar block bottom box buttons col column container fixed global group inner items item left links list main outer "
    "overlay panel primary right row secondary section site slot sticky top unit wrap wrapper".split()
)
COMMENT_PARTS = LAYOUT | frozenset(
    "article author body content entry form header meta page post posts reader readers story text thread title user users view".split()
)
COMMENT_HEADING = re.compile(
    r"\W*\d*\s*(?:(?:reader|user|your)s?\W+)?(?:comments?|replies|responses|leave a (?:comment|reply)|kommentare?|"
    r"commentaires?|comentarios?)\s*(?:\(\s*\d+\s*\))?\W*\d*\W*", re.I
)
COPYRIGHT = re.compile(r"\s*(?:©|&copy;|\(c\)\s|copyright\b)|.*\ball rights reserved\b", re.I | re.S)
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar".split())
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
CORE = frozenset(("article", "main"))
#: Characters that the text of a section of an article has at least.
ARTICLE_CHARS = 140
INLINE = frozenset(
    "abbr acronym b bdi bdo big br cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)

#: A value is quoted only where a quote follows the equals sign; other quotes are plain characters.
TOKEN = re.compile(
    r"""<(?:!--.*?(?:-->|\Z)|[!?][^>]*>?|(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:"[^"]*"|'[^']*'|[^\s"'>][^\s>]*)|[^>])*+)>?)""", re.S
)
#: A stray quoted string, or a whole name with its value; a value is always consumed, so nothing is found inside one.
ATTRIBUTE = re.compile(
    r""""[^"]*"|'[^']*'|([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*))?)?"""
)
#: A slash at the end of an unquoted value is part of it and closes nothing.
UNQUOTED_END = re.compile(r"""=\s*[^\s"'>][^\s>]*\Z|=\s*/\Z""")
NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


class Element:
    __slots__ = ("tag", "parts", "parent", "noise", "core", "chars", "links", "tags", "link_tags", "density", "total", "best",
                 "held")

    def __init__(self, tag: str, parent: "Element | None", attributes: str = "") -> None:
        self.tag, self.parent, self.parts = tag, parent, []
        self.noise = "tag" if tag in DROPPED else _noise(attributes) if attributes.strip() else ""


def _noise(attributes: str) -> str:
    """What an element's attributes say: hidden, role, comments, furniture, header, or nothing."""
    said = ""
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return "hidden"
        if name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return "hidden"
        if name == "role" and value.lower() in NOISE_ROLES:
            said = "role"
        elif name in ("class", "id", "aria-label", "itemprop"):
            said = said or _name_noise(value)
        elif name == "itemtype" and value.rstrip("/").lower().endswith("/comment"):
            said = said or "comments"
    return said


def _name_noise(value: str) -> str:
    for name in value.split():
        words = {w.lower() for w in NAME_WORD.findall(name) if not w.isdigit()}
        if words & COMMENT_WORDS and words <= COMMENT_WORDS | COMMENT_PARTS | FURNITURE:
            return "comments"
        if words & FURNITURE and words <= FURNITURE | PAGE_HEADER | LAYOUT:
            return "furniture"
        if words & PAGE_HEADER and words <= PAGE_HEADER | LAYOUT:
            return "header"
    return ""


def parse(page: str) -> Element:
    """The tree under an element that stands for the whole page."""
    top = here = Element("html", None)
    at, has_body = 0, False
    while (m := TOKEN.search(page, at)) is not None:
        if m.start() > at:
            here.parts.append(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        # A page has one body, and what comes behind its end tag still belongs to it.
        if tag == "html" or tag == "body" and (m[1] or has_body):
            continue
        if m[1]:
            here = _closed(here, tag)
            continue
        has_body = has_body or tag == "body"
        here = _opened(here, tag)
        child = Element(tag, here, m[3])
        here.parts.append(child)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif tag not in VOID and (not m[3].endswith("/") or UNQUOTED_END.search(m[3])):
            here = child
    here.parts.append(page[at:])
    return top


def _closed(here: Element, tag: str) -> Element:
    """Where parsing goes on after an end tag; one that closes nothing is ignored."""
    node = here
    while node.parent is not None:
        if node.tag == tag:
            return node.parent
        node = node.parent
    return here


def _opened(here: Element, tag: str) -> Element:
    """Where a start tag's element belongs, after the end tags it implies."""
    closes, limits = CLOSES.get(tag, ()), LIMITS.get(tag, ())
    if tag in BLOCKS and tag not in ("br", "body"):
        closes, limits = (*closes, "p"), (*limits, *(BLOCKS - {"p", *closes}))
    node = here
    while closes and node.parent is not None and node.tag not in limits:
        if node.tag in closes:
            return node.parent
        node = node.parent
    return here


def _prune(top: Element) -> None:
    """Takes the noise out, and notes which elements hold the article's core."""
    order = _in_order(top)
    for x in reversed(order):
        below = [p for p in x.parts if isinstance(p, Element)]
        x.core = x.tag in CORE or x.tag == "h1" or any(p.core for p in below)
        if x.tag in RAW:
            x.chars = x.links = 0
            continue
        x.chars = sum(len(p.strip()) for p in x.parts if isinstance(p, str)) + sum(p.chars for p in below)
        x.links = x.chars if x.tag == "a" else sum(p.links for p in below)
    inside: dict[Element, bool] = {}  # within an article or main element that is no noise
    clean: dict[Element, bool] = {}  # not within noise
    cores = heads = False  # whether an article or main element, or an h1, stands outside all noise
    for x in order:
        above = x.parent is None or clean[x.parent]
        named = x.parent is not None and inside[x.parent]
        x.noise = _told(x, named)
        clean[x] = above and not x.noise
        inside[x] = named or x.tag in CORE and clean[x]
        cores = cores or clean[x] and x.tag in CORE and x.chars > x.links
        heads = heads or clean[x] and x.tag == "h1" and x.chars > 0
    for x in order:
        spared = x.noise not in ("tag", "hidden") and x.core and not cores and (
            x.noise == "header" and not heads or x.chars - x.links > (top.chars - top.links) / 2
        )
        if spared:
            x.noise = ""
        x.parts = _without_comments(x.parts)
    for x in order:
        x.parts = [p for p in x.parts if not isinstance(p, Element) or not p.noise]
        x.core = False
    for x in reversed(_in_order(top)):
        x.core = x.tag in CORE or x.tag == "h1" or any(isinstance(p, Element) and p.core for p in x.parts)


def _in_order(top: Element) -> list[Element]:
    """All elements in page order, parents before children."""
    order, stack = [], [top]
    while stack:
        x = stack.pop()
        order.append(x)
        stack += [p for p in reversed(x.parts) if isinstance(p, Element)]
    return order


def _told(x: Element, in_article: bool) -> str:
    """The noise that counts for an element at its place."""
    if x.tag == "body" or not x.noise and x.tag != "header":
        return ""
    if x.tag == "header":
        return x.noise if x.noise == "hidden" else "" if in_article else "header"
    if x.noise == "tag":
        # A form around an article or a headline is the page's own, not one to fill in.
        return "" if x.tag == "form" and x.core else "tag"
    if x.noise in ("hidden", "role"):
        return x.noise
    if x.tag in HEADINGS or x.tag in INLINE or x.tag == "a":
        return ""
    article_like = x.tag in ("section", "article", "main") and x.chars >= ARTICLE_CHARS and 3 * x.links < x.chars
    if in_article and x.noise != "comments" and article_like:
        return ""
    return x.noise


def _without_comments(parts: list) -> list:
    """The parts of an element without a heading of reader comments and what it heads."""
    kept, skip = [], ""
    for p in parts:
        if isinstance(p, Element) and p.tag in HEADINGS:
            if skip and p.tag <= skip:
                skip = ""
            if not skip and p.tag != "h1" and p.chars < 60 and COMMENT_HEADING.fullmatch(" ".join(_blocks([p]))):
                skip = p.tag
        if not skip:
            kept.append(p)
    return kept


def _measure(top: Element) -> list[Element]:
    """Counts, densities and density sums of all elements, children before parents."""
    stack, order = [top], []
    while stack:
        x = stack.pop()
        order.append(x)
        stack += [p for p in x.parts if isinstance(p, Element)]
    order.reverse()
    for x in order:
        below = [p for p in x.parts if isinstance(p, Element)]
        x.chars = sum(len(" ".join(p.split())) for p in x.parts if isinstance(p, str)) + sum(p.chars for p in below)
        x.tags = sum(p.tags + (p.tag not in INLINE) for p in below)
        x.links = x.chars if x.tag == "a" else sum(p.links for p in below)
        x.link_tags = (x.tag == "a") + sum(p.link_tags for p in below)
    share = top.links / top.chars if top.chars else 0.0
    for x in order:
        x.total = sum(p.density for p in x.parts if isinstance(p, Element))
        x.density = x.total if x.tag in INLINE else _density(x, share)
        x.best = None if x.tag in INLINE else x  # the element with the largest sum, itself or below
        for p in x.parts:
            if isinstance(p, Element) and p.best and (x.best is None or p.best.total > x.best.total):
                x.best = p.best
    return order


def _density(x: Element, share: float) -> float:
    """Characters per tag, damped where much of the text is link text."""
    if not x.chars:
        return 0.0
    tags, links = max(x.tags, 1), max(x.links, 1)
    plain = max(x.chars - x.links, 1)
    base = math.log(x.chars / plain * x.links + share * x.chars + math.e)
    damp = math.log(x.chars / links * tags / max(x.link_tags, 1))
    return x.chars / tags * (max(damp, 0.0) / math.log(base) if base > 1.0000001 else 1.0)


def _content(body: Element) -> list[Element]:
    """The elements that are content, in page order."""
    order = _measure(body)
    core = max((x for x in reversed(order) if x.tag not in INLINE), key=lambda x: x.total)
    if core.total <= 0:
        return [body]
    threshold, node = core.density, core
    while node is not body:
        node = node.parent
        threshold = min(threshold, node.density)
    if core is body:
        return [body]
    marked = _marked(body, threshold)
    for x in order:  # children before parents
        x.held = (x in marked) + sum(p.held for p in x.parts if isinstance(p, Element))
    found: list[tuple[Element | None, Element | None]] = []  # a child of the body, and what is kept of it
    run = _run()
    for part in [*body.parts, None]:
        if isinstance(part, str) or part is not None and (part.tag in INLINE or part.tag == "a") and not part.held:
            run.parts.append(part)
            continue
        if _tells(run):
            found.append((None, run))
        run = _run()
        if part is not None:
            held = _container(part) if part.held else None
            # A container of links, or a copyright line, is furniture unless the core is in it.
            if held is not None and core not in _in_order(part) and (held.chars <= 2 * held.links or _is_copyright(held)):
                held = None
            found.append((part, held))
    kept = [x for _, x in found if x is not None]
    if any(_holds(x, "h1") for x in kept):
        return kept
    headlines = {x for x in order if x.tag == "h1" and x.chars > 2 * x.links}
    kept, headed = [], False
    for part, x in found:
        if part is None:
            kept.append(x)
        elif x is None and headed and part.chars > 2 * part.links and not _is_copyright(part):
            kept.append(part)
        else:
            kept += _first(part, headlines | {x})
        headed = headed or part is not None and not headlines.isdisjoint(_in_order(part))
    return kept or [core]


def _is_copyright(x: Element) -> bool:
    return x.chars < 300 and COPYRIGHT.match(" ".join(_blocks([x]))) is not None


def _run() -> Element:
    """A block that stands for text and inline mark-up directly in the body."""
    return Element("p", None)


def _tells(run: Element) -> bool:
    """Whether a run holds text, and more of it outside links than inside."""
    _measure(run)
    return run.chars > 2 * run.links


def _marked(body: Element, threshold: float) -> set[Element]:
    """Of each element that reaches the threshold, as all above it do, the one below with the largest sum."""
    marked: set[Element] = set()
    stack: list[Element] = [body]
    while stack:
        for x in stack.pop().parts:
            if isinstance(x, Element) and x.density >= threshold:
                marked.add(x.best or x)
                stack.append(x)
    return marked


def _container(top: Element) -> Element:
    """What holds all marked elements under ``top``: their article, or main, or what has their headline, or the least."""
    article = main = headed = None
    node = top
    while True:
        if node.tag == "article":
            article = article or node
        elif node.tag == "main":
            main = main or node
        if node.core:
            headed = node
        below = [p for p in node.parts if isinstance(p, Element) and p.held == node.held]
        if not below:
            return article or main or headed or node
        node = below[0]


def _holds(top: Element, tag: str) -> bool:
    stack = [top]
    while stack:
        x = stack.pop()
        if x.tag == tag:
            return True
        stack += [p for p in x.parts if isinstance(p, Element)]
    return False


def _first(top: Element, wanted: set[Element | None]) -> list[Element]:
    """The outermost wanted elements, in page order."""
    out, stack = [], [top]
    while stack:
        x = stack.pop()
        if x in wanted:
            out.append(x)
        else:
            stack += [p for p in reversed(x.parts) if isinstance(p, Element)]
    return out


def _blocks(nodes: list[Element]) -> list[str]:
    """Lines of text: one per block, in page order."""
    out: list[str] = []
    line: list[str] = []

    def end() -> None:
        text = " ".join(html.unescape("".join(line)).split())
        if text:
            out.append(text)
        line.clear()

    for node in nodes:
        stack: list[Element | str | None] = [None, node]  # None: the end of a block
        while stack:
            x = stack.pop()
            if x is None:
                end()
            elif isinstance(x, str):
                line.append(x)
            else:
                if x.tag in BLOCKS:
                    end()
                    stack.append(None)
                stack += reversed(x.parts)
    return out


def main_text(page: str | None) -> str:
    if not page:
        return ""
    top = parse(page)
    _prune(top)
    body = next((p for p in top.parts if isinstance(p, Element) and p.tag == "body"), top)
    return "\n".join(_blocks(_content(body)))


def extract(page: Column | str) -> Column:
    """String column: the main text of each whole page."""

    @F.pandas_udf("string")
    def extracted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pages.map(main_text, na_action=None)

    return extracted(page)
