"""Host names of other scripts in the form that the URL standard gives them: UTS 46 mapping without transitional processing, validity, the
joiner and bidi rules, and Punycode. The tables follow by rule from the Unicode properties that Python knows."""

from __future__ import annotations

import functools
import re
import unicodedata

# Fixed values of the standards: what stays as it is although case folding would change it, what is left out (code points that are
# ignorable by default), what is never valid beside the categories below, and a full stop of its own.
KEPT = frozenset((0xDF, 0x3C2, 0x200C, 0x200D))
IGNORED = (
    (0xAD, 0xAD), (0x34F, 0x34F), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180F), (0x200B, 0x200B), (0x2060, 0x2064), (0x206A, 0x206F),
    (0x3164, 0x3164), (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF), (0xFFA0, 0xFFA0), (0x1BCA0, 0x1BCA3), (0x1D173, 0x1D17A), (0xE0100, 0xE01EF),
)
NEVER = ((0x2FF0, 0x2FFF), (0x31EF, 0x31EF), (0xFFFC, 0xFFFD))
INVALID_KINDS = frozenset(("Cc", "Cf", "Cs", "Co", "Cn", "Zs", "Zl", "Zp"))
CAPITAL_SHARP_S, IDEOGRAPHIC_STOP, STOPS = 0x1E9E, chr(0x3002), frozenset((0x3002, 0xFF0E, 0xFF61))
ZWNJ, ZWJ, VIRAMA = chr(0x200C), chr(0x200D), 9
RIGHT_TO_LEFT = frozenset(("R", "AL", "AN"))
IN_RTL = frozenset(("R", "AL", "AN", "EN", "ES", "CS", "ET", "ON", "BN", "NSM"))
IN_LTR = frozenset(("L", "EN", "ES", "CS", "ET", "ON", "BN", "NSM"))


def _within(code: int, ranges: tuple[tuple[int, int], ...]) -> bool:
    return any(a <= code <= b for a, b in ranges)


@functools.lru_cache(maxsize=1 << 14)
def mapped(char: str) -> str | None:
    """What a character becomes in a host name, or None if it must not be there."""
    code = ord(char)
    if code < 128:
        return char.lower()
    if code in KEPT:
        return char
    if code == CAPITAL_SHARP_S:
        return chr(0xDF)
    if _within(code, IGNORED):
        return ""
    if code in STOPS:
        return "."
    if _within(code, NEVER):
        return None
    out = unicodedata.normalize("NFD", char)
    for _ in range(2):
        out = unicodedata.normalize("NFKC", out.casefold())
    if "." in out or IDEOGRAPHIC_STOP in out or any(ord(c) >= 128 and unicodedata.category(c) in INVALID_KINDS and not _within(ord(c), IGNORED) for c in out):
        return None
    return "".join(c for c in out if not _within(ord(c), IGNORED))


@functools.cache
def _joining() -> tuple[frozenset[str], frozenset[str]]:
    """Arabic letters that join the next letter, and that join the one before: those that have an initial, and a final form."""
    before, after = set(), set()
    for code in (*range(0xFB50, 0xFE00), *range(0xFE70, 0xFEFD)):
        name, whole = unicodedata.name(chr(code), ""), unicodedata.normalize("NFKC", chr(code))
        if len(whole) == 1 and "LIGATURE" not in name:
            if name.endswith("INITIAL FORM"):
                before.add(whole)
            elif name.endswith("FINAL FORM"):
                after.add(whole)
    return frozenset(before), frozenset(after)


def _joiner_fits(label: str, at: int) -> bool:
    """A joiner may follow a virama; the non-joiner may also part two letters that would join."""
    if at and unicodedata.combining(label[at - 1]) == VIRAMA:
        return True
    if label[at] == ZWJ:
        return False
    left = next((c for c in reversed(label[:at]) if unicodedata.category(c) not in ("Mn", "Me", "Cf")), "")
    right = next((c for c in label[at + 1 :] if unicodedata.category(c) not in ("Mn", "Me", "Cf")), "")
    before, after = _joining()
    return left in before and right in after


def _fits_direction(label: str) -> bool:
    """The rule for labels of a name that has letters written from right to left."""
    kinds = [unicodedata.bidirectional(c) for c in label]
    last = next((k for k in reversed(kinds) if k != "NSM"), "")
    if kinds[0] in ("R", "AL"):
        return set(kinds) <= IN_RTL and last in ("R", "AL", "EN", "AN") and not {"EN", "AN"} <= set(kinds)
    return kinds[0] == "L" and set(kinds) <= IN_LTR and last in ("L", "EN")


def _valid(label: str) -> bool:
    if unicodedata.normalize("NFC", label) != label or unicodedata.category(label[0]).startswith("M") or label.startswith("xn--"):
        return False
    if any(mapped(c) != c for c in label):
        return False
    return all(_joiner_fits(label, i) for i, c in enumerate(label) if c in (ZWNJ, ZWJ))


@functools.lru_cache(maxsize=1 << 14)
def to_ascii(host: str) -> str | None:
    """The host name in lower case, labels of other scripts in Punycode; None if it is none."""
    if host.isascii() and not re.search(r"(?:^|\.)xn--", host, re.I):
        return host.lower()
    parts = [mapped(c) for c in host]
    if None in parts:
        return None
    labels, out = [], []
    for label in unicodedata.normalize("NFC", "".join(parts)).split("."):
        if label.startswith("xn--"):
            try:
                label = label[4:].encode("ascii").decode("punycode")
            except UnicodeError:
                return None
            if label.isascii():
                return None
        labels.append(label)
    foreign = [x for x in labels if not x.isascii()]
    if not all(map(_valid, foreign)):
        return None
    if any(unicodedata.bidirectional(c) in RIGHT_TO_LEFT for x in foreign for c in x) and not all(map(_fits_direction, filter(None, labels))):
        return None
    for label in labels:
        out.append(label if label.isascii() else f"xn--{label.encode('punycode').decode('ascii')}")
    return ".".join(out)
