"""Scores of logo candidates, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quadrangle.functions.text import truncated
from quadrangle.functions.urls import url_path

# Points of tokens in an address or its surroundings; then words, patterns, sources and limits of the rules.
TOKEN_POINTS = {
    "logo": 30, "wordmark": 22, "branding": 18, "brand": 16, "identity": 16, "emblem": 15, "crest": 15, "seal": 12, "mark": 12,
    "hero": -28, "banner": -25, "background": -20, "cover": -18, "social": -16, "share": -16, "thumbnail": -14, "avatar": -12,
    "advert": -25, "recaptcha": -70, "gstatic": -50, "facebook": -30, "twitter": -30, "linkedin": -30, "wordpress": -20,
}
PAGE_TOKENS = ("about", "branding", "brand", "identity", "media", "contact", "who-we-are", "who_we_are")
NAME_STOP_WORDS = ("a", "an", "and", "at", "career", "college", "center", "for", "high", "in", "of", "school", "technical", "the", "university")
REJECTED = (
    r"(?i)recaptcha|gstatic\.com|wp-includes/images/w-logo|(?:social.*sprite|sprite.*social)|(?:facebook|twitter|linkedin)[-_]?button"
    r"|powered\s+by\s+edlio|\bedlio\b|\baeries\b|google[-_ ]?translate|(?:search|menu|close)[-_ ]?icon"
)
DIRECT = r"(?i)(?:^|[\s_\-./])(?:logo|wordmark|brand(?:ing)?|identity|emblem|crest|seal)(?:$|[\s_\-./])"
HEADER = r"(?i)<header\b|\bheader\b|headerlogo|header-logo|logoimage|logo-image"
CONTAINER = (
    r"""(?i)\bid\s*=\s*["'][^"']*logo|\bclass\s*=\s*["'][^"']*logo|\balt\s*=\s*["'][^"']*logo"""
    r"|(?:school|site|brand)[-_ ]?logo|logo[-_ ]?(?:image|container|wrapper|link)"
)
SVG_CONTEXT = r"""(?i)(?:school|site|header|brand|main)[_-]?logo|logo[-_ ]?(?:image|container|wrapper|link)|\bclass\s*=\s*["'][^"']*\blogo\b"""
FAVICON_SOURCES = ("document-icon", "web-manifest", "favicon-fallback")
GENERIC_SOURCES = ("image-element", "picture-source", "css-background")
MIN_SCORE, AI_THRESHOLD = 75, 0.8


def token_score(text: Column, tokens: dict[str, int] = TOKEN_POINTS) -> Column:
    """The points of all tokens that the text contains, each counted once."""
    low = F.lower(text)
    total = F.lit(0)
    for token, points in tokens.items():
        total = total + F.when(F.contains(low, F.lit(token)), points).otherwise(0)
    return total


def token_reasons(text: Column, prefix: str = "", tokens: dict[str, int] = TOKEN_POINTS) -> Column:
    low = F.lower(text)
    hits = [F.when(F.contains(low, F.lit(t)), F.lit(f"{prefix}{'signal' if p > 0 else 'penalty'}:{t}")) for t, p in tokens.items()]
    return F.array_compact(F.array(*hits))


def has_positive_signal(text: Column) -> Column:
    low = F.lower(text)
    return F.exists(F.array(*(F.lit(t) for t, p in TOKEN_POINTS.items() if p > 0)), lambda t: F.contains(low, t))


def name_tokens(name: Column) -> Column:
    return F.filter(F.split(F.lower(name), "[^a-z0-9]+"), lambda t: (F.length(t) >= 3) & ~t.isin(*NAME_STOP_WORDS))


def institution_match(name: Column, text: Column) -> Column:
    """struct(score, reasons): 12 for each word of the name in the text, 30 at most, and 35 for its initials."""
    low = F.lower(text)
    tokens = name_tokens(name)
    matched = F.filter(tokens, lambda t: F.contains(low, t))
    acronym = F.array_join(F.transform(tokens, lambda t: F.substring(t, 1, 1)), "")
    by_acronym = (F.length(acronym) >= 3) & F.contains(low, acronym)
    score = F.least(F.lit(30), F.size(matched) * 12) + F.when(by_acronym, 35).otherwise(0)
    reasons = F.concat(
        F.transform(matched, lambda t: F.concat(F.lit("institution:"), t)),
        F.when(by_acronym, F.array(F.concat(F.lit("institution-acronym:"), F.upper(acronym)))).otherwise(F.array().cast("array<string>")),
    )
    return F.struct(score.alias("score"), reasons.alias("reasons"))


def structure_score(text: Column) -> Column:
    return F.when(text.rlike(HEADER), 28).otherwise(0) + F.when(text.rlike(CONTAINER), 26).otherwise(0)


def structure_reasons(text: Column) -> Column:
    return F.array_compact(F.array(F.when(text.rlike(HEADER), F.lit("structure:header")), F.when(text.rlike(CONTAINER), F.lit("structure:logo-container"))))


def signal_text(url: Column, metadata: Column) -> Column:
    """Path, query and surroundings of an address, in lower case."""
    query = F.regexp_extract(url, r"(\?[^#]*)", 1)
    return F.lower(F.concat(F.lit("/"), url_path(url), F.lit(" "), F.when(query == "?", "").otherwise(query), F.lit(" "), metadata))


def rejected_asset(text: Column) -> Column:
    return text.rlike(REJECTED)


def direct_signal(url: Column, metadata: Column) -> Column:
    return signal_text(url, metadata).rlike(DIRECT)


def shape_score(initial: Column, width: Column, height: Column) -> Column:
    """0 to 100, from the candidate's own score and the image's shape."""
    ratio = width / height
    shape = F.when((ratio >= 0.65) & (ratio <= 1.7), 4).when((ratio > 4) | (ratio < 0.25), -12).otherwise(0)
    return F.greatest(F.lit(0), F.least(F.lit(100), 30 + initial + shape + F.when((width >= 32) & (height >= 32), 2).otherwise(0)))


def review_score(score: Column, kind: Column, eligible: Column) -> Column:
    """The score, capped for what an assessment says is no logo; no assessment (a null kind) leaves it."""
    return (
        F.when(kind.isin("photo", "document", "screenshot"), F.least(score, F.lit(5)))
        .when((kind == "icon") & ~eligible, F.least(score, F.lit(12)))
        .when((kind == "unknown") & ~eligible, F.least(score, F.lit(20)))
        .otherwise(score)
    )


def acceptable(kind: Column, eligible: Column, source: Column, favicon_fallback: Column) -> Column:
    icon = favicon_fallback & source.isin(*FAVICON_SOURCES) & (kind == "icon")
    return F.coalesce(eligible & (kind.isin("logo", "wordmark", "seal", "crest") | icon), F.lit(False))


def selection_status(chosen: Column, accepted_kind: Column, confidence: Column, threshold: float = AI_THRESHOLD) -> Column:
    """What came of a selection: chosen is the candidate's rank, or null for none."""
    return F.when(chosen.isNull(), "no_match").when(~accepted_kind, "rejected_kind").when(confidence >= threshold, "accepted").otherwise("below_threshold")


def asset_name(url: Column) -> Column:
    """The last part of an address's path, for people to read."""
    name = F.regexp_extract(F.regexp_replace(url_path(url), "/+$", ""), "([^/]*)$", 1)
    return F.when(F.coalesce(url, F.lit("")) == "", "inline SVG").when(~url.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*://"), url).when(name == "", "unnamed asset").otherwise(name)


def compact_metadata(text: Column) -> Column:
    """The first five telling attributes of an element's metadata, in 120 characters."""
    parts = F.transform(F.split(text, ";"), lambda x: F.trim(x))
    useful = F.array_join(F.slice(F.filter(parts, lambda x: x.rlike(r"(?i)^(?:tag|alt|class|id|title|role|aria-[\w-]+)=")), 1, 5), "; ")
    return truncated(F.when(useful != "", useful).otherwise(text), 120)


def compact_ancestry(text: Column) -> Column:
    """The element itself and its telling ancestors, four at most, in 180 characters."""
    parts = F.filter(F.transform(F.split(text, " > "), lambda x: F.trim(x)), lambda x: x != "")
    telling = F.filter(parts, lambda x: x.rlike(r"(?i)\b(?:header|nav|footer|logo|brand|identity|school|district|crest|seal|wordmark)\b"))
    chosen = F.slice(F.array_distinct(F.concat(F.slice(parts, 1, 1), telling)), 1, 4)
    short = F.array_join(F.transform(chosen, lambda x: truncated(x, 70)), " > ")
    return truncated(F.when(short != "", short).otherwise(text), 180)
