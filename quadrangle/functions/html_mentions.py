"""What a school's page says about images and links: one record for each mention, unscored. A small parser over the
standard library's tokenizer; scoring is done with column expressions."""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import unquote

from quadrangle.functions.urls import resolved

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
# Patterns of addresses in style text, lazy-loading attributes, links and attributes, and telling names.
CSS_URL = re.compile(r"""url\(\s*["']?([^"')]+)["']?\s*\)""", re.I)
LAZY = re.compile(r"data-(?:src|image|lazy|original|url)(?:-|$)")
LINK = re.compile(r"<a\b([^>]*)>(.*?)</a\s*>", re.I | re.S)
ATTRIBUTE = re.compile(r"""([:\w-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")
TELLING = re.compile(r"(logo|brand|identity|image|school|header)", re.I)
NAMED = ("id", "class", "role", "aria-label", "aria-labelledby", "title")
REGIONS = ("nav", "main", "footer")

#: Characters of a page that are parsed before what was found there is passed on.
PART = 1 << 20

FIELDS = ("phase", "source", "raw_url", "base_score", "signal", "structure", "ancestry", "region", "svg")


def _short(text: str, n: int) -> str:
    return re.sub(r"\s+", " ", text)[:n]


def attributes(tag_text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(tag_text)}


def metadata(tag: str, attrs: dict[str, str]) -> str:
    own = ("alt", "class", "id", "title", "role", "aria-label", "type")
    return "; ".join([f"tag={tag}", *(f"{k}={_short(v, 240)}" for k, v in attrs.items() if v and (k in own or k.startswith("data-")))])


def _decoded(text: str) -> str | None:
    """The text without percent escapes; None if one of them is malformed or they are no UTF-8."""
    if re.search(r"%(?![0-9A-Fa-f]{2})", text):
        return None
    try:
        return unquote(text, errors="strict")
    except UnicodeDecodeError:
        return None


def _entries(item: dict) -> list[tuple[str, object]]:
    """An object's entries in the order in which scripts see them: whole numbers first, then as written."""
    numbers = sorted((k for k in item if k.isascii() and k.isdigit() and str(int(k)) == k and int(k) < 2**32 - 1), key=int)
    return [(k, item[k]) for k in (*numbers, *(k for k in item if k not in set(numbers)))]


def described_urls(value: str) -> list[str]:
    """Addresses under the keys url, src and href of a JSON descriptor at any depth, in the order of the document, quoted in whatever way;
    [] if it is none."""
    for text in (value, _decoded(value)):
        if text is None:
            continue
        try:
            found, todo = {}, [("", json.loads(text.replace("&quot;", '"')))]
        except (ValueError, RecursionError):
            continue
        while todo:
            key, item = todo.pop()
            if isinstance(item, str):
                if key.lower() in ("url", "src", "href"):
                    found[item] = None
            elif isinstance(item, list):
                todo += (("", x) for x in reversed(item))
            elif isinstance(item, dict):
                todo += reversed(_entries(item))
        if found:
            return list(found)
    return []


def asset_urls(attrs: dict[str, str]) -> list[str]:
    out: dict[str, None] = {}
    for k, v in attrs.items():
        if not v:
            continue
        if k == "srcset" or k.endswith("-srcset"):
            out |= dict.fromkeys(p.split()[0] for p in v.split(",") if p.strip())
        elif k in ("src", "href") or LAZY.match(k):
            out |= dict.fromkeys(described_urls(v) or [v.strip()])
    return list(out)


class _Page(HTMLParser):
    def __init__(self, text: str):
        super().__init__(convert_charrefs=True)
        self.source_text, self.open, self.found, self.manifests = text, [], [], []
        self.lines: array | None = None
        self.svgs: list[tuple[int, list]] = []

    def parts(self) -> Iterator[list[tuple]]:
        """What each part of the page adds."""
        for lo in range(0, len(self.source_text), PART):
            self.feed(self.source_text[lo : lo + PART])
            yield self._taken()
        self.close()
        yield self._taken()

    def _taken(self) -> list[tuple]:
        found, self.found = self.found, []
        return found

    def _offset(self) -> int:
        if self.lines is None:
            self.lines = array("q", [0, *(m.end() for m in re.finditer("\n", self.source_text))])
        line, column = self.getpos()
        return self.lines[line - 1] + column

    def _ancestry(self, tag: str, attrs: dict[str, str]) -> tuple[str, str]:
        parts, region = [], "document"
        for name, own in [(tag, attrs), *reversed(self.open)]:
            details = dict.fromkeys(f"{k}={_short(own[k], 160)}" for k in NAMED if own.get(k))
            details |= dict.fromkeys(f"{k}={_short(v, 160)}" for k, v in own.items() if k.startswith("data-") and v and TELLING.search(f"{k} {v}"))
            if details or name in ("header", "a", *REGIONS):
                parts.append(name + (f"({'; '.join(details)})" if details else ""))
            if name == "header":
                region = "header"
            elif region == "document" and name in REGIONS:
                region = name
        return " > ".join(parts), region

    def _add(self, phase: int, source: str, url: str | None, signal: str, structure: str, ancestry: str, region: str, base: int = 0, svg: str | None = None) -> None:
        if url or svg:
            self.found.append((phase, source, url, base, signal, structure, ancestry, region, svg))

    def handle_starttag(self, tag, attr_list):
        attrs = {k.lower(): v or "" for k, v in reversed(attr_list)}
        attrs = {k: attrs[k] for k in dict.fromkeys(k.lower() for k, _ in attr_list)}
        about = metadata(tag, attrs)
        if tag == "link":
            rel, href = attrs.get("rel", "").lower(), attrs.get("href")
            if "manifest" in rel and href:
                self.manifests.append(href)
            if "icon" in rel or "image_src" in rel:
                self._add(1, "document-icon" if "icon" in rel else "metadata-image", href, about, "head", "head", "head")
        elif tag == "meta":
            marker = f"{attrs.get('property', '')} {attrs.get('name', '')}".lower()
            if "og:image" in marker or "twitter:image" in marker or marker == "image":
                self._add(2, "metadata-image", attrs.get("content"), about, "head", "head", "head")
        elif tag in ("img", "source") and not (self.open and self.open[-1][0] == "video"):
            ancestry, region = self._ancestry(tag, attrs)
            for url in asset_urls(attrs):
                self._add(3, "picture-source" if tag == "source" else "image-element", url, about, ancestry, ancestry, region)
        if attrs.get("style"):
            ancestry, region = self._ancestry(tag, attrs)
            for m in CSS_URL.finditer(attrs["style"]):
                self._add(4, "css-background", m[1], about, ancestry, ancestry, region)
        if tag == "svg":
            self.svgs.append((self._offset(), [about, *self._ancestry(tag, attrs)]))
        if tag not in VOID:
            self.open.append((tag, attrs))

    def handle_startendtag(self, tag, attr_list):
        self.handle_starttag(tag, attr_list)
        if tag not in VOID and self.open:
            self.open.pop()
            if tag == "svg":
                self._svg_ends(self._offset() + len(self.get_starttag_text() or ""))

    def _svg_ends(self, end: int) -> None:
        if self.svgs:
            start, (about, ancestry, region) = self.svgs.pop()
            self._add(6, "inline-svg", None, about, f"{about} {ancestry}", ancestry, region, 65, self.source_text[start:end])

    def handle_endtag(self, tag):
        if any(name == tag for name, _ in self.open):
            while self.open.pop()[0] != tag:
                pass
        if tag == "svg":
            end = self.source_text.find(">", self._offset())
            self._svg_ends(len(self.source_text) if end < 0 else end + 1)


def _found(html: str, page: _Page) -> Iterator[tuple]:
    for part in page.parts():
        yield from part
    for m in CSS_URL.finditer(html):
        yield 5, "css-background", m[1], 0, m[1], "stylesheet", "stylesheet", "stylesheet", None
    yield 7, "favicon-fallback", "/favicon.ico", 10, "favicon", "", "", "", None


def streamed(html: str, page_url: str) -> Iterator[tuple]:
    """(ord, records of FIELDS) with resolved addresses, as the page is read; ord gives the order of discovery: by phase, then by place."""
    for n, f in enumerate(_found(html, _Page(html))):
        url = resolved(f[2], page_url) if f[2] else None
        if url or f[8]:
            yield (f[0] << 40) + n, *f[:2], url, *f[3:]


def mentions(html: str, page_url: str) -> list[tuple]:
    """The records of streamed() in the order of discovery."""
    return [f[1:] for f in sorted(streamed(html, page_url), key=lambda f: f[0])]


def manifests(html: str, page_url: str) -> list[str]:
    """The addresses of a page's web manifests."""
    page = _Page(html)
    for _ in page.parts():
        pass
    urls = (resolved(m, page_url) for m in page.manifests)
    return list(dict.fromkeys(u for u in urls if u))


def links(html: str, page_url: str) -> list[tuple[str, str]]:
    """(address, text about it) of all links in page order."""
    out = []
    for m in LINK.finditer(html):
        attrs = attributes(m[1])
        url = resolved(attrs.get("href", ""), page_url)
        if url:
            out.append((url, f"{url} {attrs.get('title', '')} {re.sub('<[^>]*>', ' ', m[2])}".lower()))
    return out
