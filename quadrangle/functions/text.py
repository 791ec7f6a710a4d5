"""Text functions of the catalog, as column expressions.

Everything is built in but the compatibility decomposition of non-ASCII names, which Spark lacks; it goes through Arrow,
and ASCII rows are sent there as null.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The code points of white space as a script trims it.
SPACE_CODES = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF)
SPACES = "".join(f"\\x{{{c:X}}}" for c in SPACE_CODES)
# What the source files write for "missing".
MISSING = ("-1", "-2", "-3")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trimmed(c: Column | str) -> Column:
    """c without Unicode white space at either end."""
    return F.btrim(_col(c), F.lit("".join(map(chr, SPACE_CODES))))


def clean(c: Column | str) -> Column:
    """Trimmed text; null and the sentinels for missing values are ''."""
    t = trimmed(F.coalesce(_col(c), F.lit("")))
    return F.when(t.isin(*MISSING), "").otherwise(t)


def cleaned_or_null(c: Column | str) -> Column:
    return F.nullif(clean(c), F.lit(""))


def present(c: Column | str) -> Column:
    """True if there is more than white space."""
    return F.coalesce(trimmed(_col(c).cast("string")) != "", F.lit(False))


def sql_blank(c: Column | str) -> Column:
    """Null, or nothing but U+0020."""
    c = _col(c)
    return c.isNull() | (F.trim(c) == "")


def same_as_exported(value: Column | str, stored: Column | str) -> Column:
    """Equality in which a stored null is the empty text."""
    return _col(value) == F.coalesce(_col(stored), F.lit(""))


def join_parts(parts: Iterable[Column | str]) -> Column:
    """The cleaned parts that are not blank, joined by ', '; null if there is none."""
    kept = F.filter(F.array(*map(clean, parts)), lambda x: x != "")
    return F.when(F.size(kept) > 0, F.array_join(kept, ", "))


@functools.cache
def _other():
    import regex

    return regex.compile(r"[^\p{L}\p{N}]+")


def normalized_text(text: str) -> str:
    """The normal form of one name; the column form below agrees with it."""
    plain = "".join(ch for ch in unicodedata.normalize("NFKD", text) if not 0x300 <= ord(ch) <= 0x36F).lower().replace("&", " and ")
    return _other().sub(" ", plain).strip(" ")


@F.pandas_udf(StringType())
def _normalized_other(names: pd.Series) -> pd.Series:
    return names.map(normalized_text, na_action="ignore")


def normalize_name(c: Column | str) -> Column:
    """Compatibility-decomposed, without accents, lower case, '&' as 'and', words of letters and digits with one space between
    them. Null gives ''."""
    c = F.coalesce(_col(c).cast("string"), F.lit(""))
    ascii_form = F.trim(F.regexp_replace(F.replace(F.lower(c), F.lit("&"), F.lit(" and ")), "[^a-z0-9]+", " "))
    is_ascii = ~c.rlike(r"[^\x00-\x7F]")
    return F.when(is_ascii, ascii_form).otherwise(_normalized_other(F.when(~is_ascii, c)))


# The codes of the 50 states.
STATE_BY_CODE = {
    "01": "AL", "02": "AK", "04": "AZ", "05": "AR", "06": "CA", "08": "CO", "09": "CT", "10": "DE", "12": "FL", "13": "GA",
    "15": "HI", "16": "ID", "17": "IL", "18": "IN", "19": "IA", "20": "KS", "21": "KY", "22": "LA", "23": "ME", "24": "MD",
    "25": "MA", "26": "MI", "27": "MN", "28": "MS", "29": "MO", "30": "MT", "31": "NE", "32": "NV", "33": "NH", "34": "NJ",
    "35": "NM", "36": "NY", "37": "NC", "38": "ND", "39": "OH", "40": "OK", "41": "OR", "42": "PA", "44": "RI", "45": "SC",
    "46": "SD", "47": "TN", "48": "TX", "49": "UT", "50": "VT", "51": "VA", "53": "WA", "54": "WV", "55": "WI", "56": "WY",
}
STATES = tuple(sorted(STATE_BY_CODE.values()))


def state_from_code(c: Column | str) -> Column:
    """The state of a code, padded to two digits; null for other codes."""
    code = clean(c)
    padded = F.when(F.length(code) < 2, F.lpad(code, 2, "0")).otherwise(code)
    return F.element_at(F.create_map(*(F.lit(x) for pair in STATE_BY_CODE.items() for x in pair)), padded)


def stable_id(source: Column | str, source_id: Column | str) -> Column:
    """An id that depends on the source key alone, so that a repeated import gives the same one."""
    return F.sha2(F.concat(_col(source), F.lit(chr(0)), _col(source_id)), 256)


def first_n(c: Column | str, n: int) -> Column:
    return F.substring(_col(c), 1, n)


def collapsed(c: Column | str, n: int | None = None) -> Column:
    """White space as single spaces, trimmed, at most n characters."""
    t = trimmed(F.regexp_replace(_col(c), f"[{SPACES}]+", " "))
    return first_n(t, n) if n else t


def truncated(c: Column | str, n: int) -> Column:
    """At most n characters, the last one an ellipsis if something was left out."""
    c = _col(c)
    return F.when(F.length(c) <= n, c).otherwise(F.concat(F.substring(c, 1, n - 1), F.lit(chr(0x2026))))


def error_text(c: Column | str) -> Column:
    return collapsed(c, 500)


def escape_html(c: Column | str) -> Column:
    c = _col(c)
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(raw), F.lit(safe))
    return c


def file_safe(c: Column | str) -> Column:
    """Characters other than letters, digits, '_' and '-' as '_'."""
    return F.regexp_replace(_col(c), "(?i)[^a-z0-9_-]", "_")


def preview_name(institution_id: Column | str, rank: Column | str, vision: bool = False) -> Column:
    return F.concat(file_safe(institution_id), F.lit("-candidate-"), _col(rank).cast("string"), F.lit("-vision.webp" if vision else ".webp"))


def logo_object_key(category: Column | str, institution_id: Column | str) -> Column:
    folder = F.when(_col(category) == "college", "colleges").otherwise("high-schools")
    return F.concat(F.lit("education/"), folder, F.lit("/"), _col(institution_id), F.lit(".webp"))
