"""Main text of web pages by tag-path ratios.

A page is read into blocks of text, each with its tag path: the block-level elements from the root to it, with their classes. Text
length outside links and punctuation are summed over all blocks of a path; their means per block are the path's ratios. Both rows of
ratios are smoothed over neighbouring blocks in page order and fused with the path's own. Paths whose fused ratio reaches a share of the
page's mean, weighted by text, are content, and the blocks of these paths are the result, but for lesser headings that other text follows; nothing else adds a block.

What a page's markup says only weighs a path's ratio: elements that seldom hold an article (nav, footer, form, ...) and words of class, id
and role that speak of menus, adverts or comments lower it, each for itself; <article> and <main>, the surroundings of the first heading,
headings and list items raise it; elements that stand beside others of the same path, each with its own text and no heading first, as
comments do, lower it. Since the threshold is relative, what holds the whole page changes nothing. Text that is not shown
(head, template, hidden elements, ...) and controls (button, select) are left out before.

Work grows with the page's length, whatever its depth.

Defined cases: null or empty html, or a page without text, gives the empty string. Pages cut off at any point are read as
far as they go. Repeated rows and null page_ids are rows like any other. Other columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements of HTML, by what they mean here.
RAW = "script style textarea title iframe noembed noframes xmp"
NOT_SHOWN = {"head", "noscript", "template", "button", "select", "option", "svg", "math", "object", "canvas", "audio", "video", "map", "datalist"}
ASIDE = {"nav", "footer", "aside", "form", "dialog", "menu", "header"}
ITEMS = {"li", "dt", "dd", "blockquote", "pre", "figcaption", "caption", "td", "th"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
BLOCKS = NOT_SHOWN | ASIDE | {
    "html", "body", "div", "p", "section", "article", "main", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li", "dl", "dt", "dd",
    "table", "caption", "thead", "tbody", "tfoot", "tr", "td", "th", "fieldset", "legend", "blockquote", "pre", "figure", "figcaption", "address", "details",
    "summary", "center", "hgroup", "search",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Elements whose start tag ends an open element of the second set, within the third.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
# Words of class, id and role that mark what is no article.
MARKS = set(
    "ad ads adv advert adverts advertisement advertising adbox adslot banner promo promotion sponsor sponsored sidebar menu nav navbar navigation breadcrumb"
    " breadcrumbs header masthead footer comment comments disqus reply replies respond cookie cookies consent gdpr notice notices alert popup modal overlay newsletter"
    " subscribe subscription signup login share sharing social related recommended recommendations widget widgets toolbar pagination pager copyright disclaimer skip"
    " search form complementary contentinfo dialog hidden".split()
)
#: Words beside these that say that it is one: content-with-sidebar.
SPEAKING = set("content article main post entry story".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>" + RAW.replace(" ", "|") + r")(?=[\s/>])(?P<rawattrs>(?>\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>.*?(?:</(?P=raw)(?=[\s/>])[^>]*(?:>|\Z)|\Z)|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<attrs>(?>\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|\Z)"
    r"|<(?P<end2>/?)(?P<tag2>[a-z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)",
    re.S | re.I,
)
NAMED = re.compile(r"\b(class|id|role|aria-hidden|hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
CLASS = re.compile(r"\b(class)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
#: Blocks of running text; what else holds text is a part of the page.
PROSE = HEADINGS | {"p", "ul", "ol", "li", "dl", "dt", "dd", "blockquote", "pre", "figure", "figcaption", "table", "caption", "thead", "tbody", "tfoot", "tr", "td", "th", "header", "hgroup", "address"}
#: Threshold of a path as a share of the page's mean ratio, and part of a path's own ratios in the fused one; the rest is that of its surroundings.
SHARE, OWN = 0.4, 0.6
#: Code points and punctuation marks of a block beyond which it says no more of its path.
LONG, MANY = 400, 10
#: Weights of a mark, of an element that seldom holds an article, of elements that repeat, and of an article, a main element, the
#: surroundings of the first heading, headings and list items.
MARKED, BESIDE, REPEATED, ARTICLE, MAIN, FIRST, HEADING, ITEM = 0.15, 0.05, 0.15, 3.0, 1.5, 2.0, 6.0, 3.0
PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？]")


def _hidden(attrs: str) -> bool:
    for m in NAMED.finditer(attrs):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or name == "aria-hidden" and value.strip().lower() == "true":
            return True
        if name == "style" and "display:none" in value.lower().replace(" ", ""):
            return True
    return False


def _marked(attrs: str, within: bool) -> bool:
    """within: inside an article, where a header is the article's own."""
    for m in NAMED.finditer(attrs):
        if m[1].lower() in ("class", "id", "role"):
            words = {w.lower() for w in WORD.findall(m[2] or m[3] or m[4] or "")}
            if words & (MARKS - {"header"} if within else MARKS) and not words & SPEAKING:
                return True
    return False


class Page:
    """Blocks of text in page order and the elements around them. Element 0 is the page itself; of every element there is its parent,
    tag, tag path (a number), the element that holds its text as prose, whether it is shown, its weight and whether it is in an article."""

    def __init__(self) -> None:
        self.tag, self.parent, self.path, self.holder = ["#"], [-1], [0], [0]
        self.shown, self.weight, self.article = [True], [1.0], [False]
        self.paths: dict[tuple[int, str], int] = {}
        self.element: list[int] = []  # of each block, like the following
        self.text: list[str] = []
        self.links: list[int] = []

    def open(self, parent: int, tag: str, attrs: str) -> int:
        name = m[2] or m[3] or m[4] or "" if (m := CLASS.search(attrs)) else ""
        path = self.paths.setdefault((self.path[parent], f"{tag}.{name}"), len(self.paths) + 1)
        within = self.article[parent]
        own = bool(attrs) and not attrs.isspace() and tag not in ("html", "body", "main")
        weight = self.weight[parent]
        if tag in ASIDE and not (tag == "header" and within):
            weight *= BESIDE
        if own and _marked(attrs, within):
            weight *= MARKED
        if tag == "article" and not within:
            weight *= ARTICLE
        elif tag == "main":
            weight *= MAIN
        self.tag.append(tag)
        self.parent.append(parent)
        self.path.append(path)
        self.shown.append(self.shown[parent] and tag not in NOT_SHOWN and not (own and _hidden(attrs)))
        self.weight.append(weight)
        self.article.append(within or tag in ("article", "main"))
        at = len(self.tag) - 1
        self.holder.append(self.holder[parent] if tag in PROSE else at)
        return at


def read(page: str) -> Page:
    out = Page()
    stack, still = [0], Counter()  # open elements, and how many there are of each tag
    pieces: list[str] = []
    links = anchor = 0

    def flush() -> None:
        nonlocal links
        text = " ".join("".join(pieces).split())
        if text:
            out.element.append(stack[-1])
            out.text.append(text)
            out.links.append(links)
        pieces.clear()
        links = 0

    def add(raw: str) -> None:
        nonlocal links
        text = html.unescape(raw) if "&" in raw else raw
        pieces.append(text)
        if anchor:
            links += len(text.strip())

    def close(kinds: set[str], within: set[str]) -> None:
        """Ends the innermost open element of these kinds, unless one of `within` is met first."""
        if any(still[k] for k in kinds):
            for i in range(len(stack) - 1, 0, -1):
                tag = out.tag[stack[i]]
                if tag in kinds:
                    still.subtract(out.tag[e] for e in stack[i:])
                    del stack[i:]
                    return
                if tag in within:
                    return

    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            continue
        if m["end"] or m["end2"]:
            if tag == "a":
                anchor = max(0, anchor - 1)
            elif tag in BLOCKS:
                flush()
                close({tag}, {"body"} if tag not in ("html", "body") else set())
        elif tag == "br":
            pieces.append("\n")
        elif tag == "hr":
            flush()
        elif tag == "a":
            anchor = 1
        elif tag in BLOCKS and tag not in VOID:
            flush()
            anchor = 0
            if tag in IMPLIED:
                close(*IMPLIED[tag])
            elif out.tag[stack[-1]] == "p":
                close({"p"}, set())
            stack.append(out.open(stack[-1], tag, m["attrs"] if m["tag"] else m["attrs2"]))
            still[tag] += 1
    if at < len(page):
        add(page[at:])
    flush()
    return out


def _smoothed(values: list[float]) -> list[float]:
    """Weighted with the neighbours on both sides (a Gaussian of one block)."""
    weights = [math.exp(-d * d / 2) for d in range(3)]
    out = []
    for i in range(len(values)):
        total = weight = 0.0
        for d in range(-2, 3):
            if 0 <= i + d < len(values):
                total += weights[abs(d)] * values[i + d]
                weight += weights[abs(d)]
        out.append(total / weight)
    return out


def _repeated(page: Page, blocks: list[int]) -> set[int]:
    """Elements that stand beside another of the same path, where they hold several texts and do not begin with a heading, as comments do."""
    first: dict[int, str] = {}
    texts: Counter = Counter()
    for b in blocks:
        e = page.holder[page.element[b]]
        while e:  # a unit's texts can stand one element deeper; a deeper one is a unit of its own
            first.setdefault(e, page.tag[page.element[b]])
            texts[e] += 1
            if page.holder[page.element[b]] != e:
                break
            e = page.parent[e]
    kinds: dict[tuple[int, int], list[int]] = {}
    for e in first:
        kinds.setdefault((page.parent[e], page.path[e]), []).append(e)
    return {e for units in kinds.values() if len(units) > 1 and sum(texts[e] for e in units) >= 2 * len(units) for e in units if first[e] not in HEADINGS and page.tag[e] not in ("section", "article", "body")}


def _around_first_heading(page: Page, blocks: list[int]) -> set[int]:
    """The element that holds the first heading with text beside it, and those within; a heading alone in its element speaks for the
    element around."""
    h1 = next((b for b in blocks if page.tag[page.element[b]] == "h1" and page.weight[page.element[b]] >= 1), None)
    if h1 is None:
        return set()
    texts = Counter(page.holder[page.element[b]] for b in blocks)
    at = page.holder[page.element[h1]]
    while at and page.parent[at] > 0 and texts[at] < 2:
        at = page.holder[page.parent[at]]
    inside = {at}
    for e in range(at + 1, len(page.tag)):  # an element comes after the one around it
        if page.parent[e] in inside:
            inside.add(e)
    return inside


def path_ratios(page: Page, blocks: list[int]) -> tuple[dict[int, float], dict[int, float]]:
    """The fused ratio of every tag path: text outside links and punctuation for each block of the path, both smoothed over the page, and
    weighted by what the markup says; and the weights of running text."""
    sums: dict[int, list[int]] = {}
    for b in blocks:
        s = sums.setdefault(page.path[page.element[b]], [0, 0, 0])
        s[0] += 1
        s[1] += min(LONG, max(0, len(page.text[b]) - page.links[b]))
        s[2] += min(MANY, len(PUNCTUATION.findall(page.text[b])))
    rows = [sums[page.path[page.element[b]]] for b in blocks]
    text = [t / n for n, t, _ in rows]
    marks = [1 + p / n for n, _, p in rows]
    again, near_heading = _repeated(page, blocks), _around_first_heading(page, blocks)
    fused: dict[int, list[float]] = {}
    weights = {}
    for b, t, p, near_t, near_p in zip(blocks, text, marks, _smoothed(text), _smoothed(marks), strict=True):
        e = page.element[b]
        tag = page.tag[e]
        kind = HEADING if tag in HEADINGS else ITEM if tag in ITEMS else 1
        weight = page.weight[e] * (REPEATED if {page.holder[e], page.parent[page.holder[e]]} & again else 1) * (FIRST if e in near_heading else 1)
        fused.setdefault(page.path[e], []).append(kind * weight * math.sqrt(t * p) ** OWN * math.sqrt(near_t * near_p) ** (1 - OWN))
        if kind == 1:
            weights[b] = weight
    return {path: sum(v) / len(v) for path, v in fused.items()}, weights or dict.fromkeys(blocks, 1.0)


def main_text(page: str | None, share: float = SHARE) -> str:
    """The blocks of content joined by line feeds. share: of the mean fused ratio, weighted by text, the threshold of a path."""
    p = read(page or "")
    blocks = [b for b in range(len(p.text)) if p.shown[p.element[b]]]
    if not blocks:
        return ""
    ratio, weight = path_ratios(p, blocks)
    size = {b: len(p.text[b]) for b in blocks}
    least = share * sum(ratio[p.path[p.element[b]]] * size[b] * w for b, w in weight.items()) / sum(size[b] * w for b, w in weight.items())
    linked: dict[int, list[int]] = {}
    for b, n in size.items():
        s = linked.setdefault(p.path[p.element[b]], [0, 0])
        s[0] += p.links[b]
        s[1] += n
    content = {path for path, (links, n) in linked.items() if ratio[path] >= least and 2 * links <= n}
    out, follows = [], True
    for b in reversed(blocks):
        chosen, tag = p.path[p.element[b]] in content, p.tag[p.element[b]]
        if chosen and (follows or tag == "h1" or tag not in HEADINGS):
            out.append(p.text[b])
        if tag not in HEADINGS:
            follows = chosen
    return "\n".join(reversed(out))


def extract(pages: DataFrame, share: float = SHARE) -> DataFrame:
    """page_id, url, text, n_chars (code points of text) for every row of pages."""

    @F.arrow_udf("string")
    def text(column: pa.Array) -> pa.Array:
        return pa.array([main_text(p, share) for p in column.to_pylist()], pa.string())

    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), text(F.col("html").cast("string")).alias("text"))
    return slim.withColumn("n_chars", F.length("text").cast("long"))
