"""Web addresses: parsing by the public URL standard, as far as http and https addresses need it."""

from __future__ import annotations

import functools
import re
from typing import NamedTuple
from urllib.parse import quote, unquote_to_bytes

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from quadrangle.functions.hosts import to_ascii

# Fixed values of the URL standard.
PORTS = {"http": 80, "https": 443, "ftp": 21, "ws": 80, "wss": 443}
FORBIDDEN_IN_HOST = re.compile(r"[\x00-\x20#/:<>?@\[\\\]^|%\x7f]")
PATH_SAFE = "!$%&'()*+,-./:;=@[]\\^_|~"
QUERY_SAFE = "!$%&()*+,-./:;=?@[]\\^_`{|}~"


class Url(NamedTuple):
    scheme: str
    username: str
    password: str
    host: str
    port: int | None
    path: str
    query: str | None

    @property
    def origin(self) -> str:
        return f"{self.scheme}://{self.host}" + (f":{self.port}" if self.port is not None else "")

    def text(self) -> str:
        """The serialised address, without its fragment."""
        login = self.username + (f":{self.password}" if self.password else "")
        port = f":{self.port}" if self.port is not None else ""
        query = f"?{self.query}" if self.query is not None else ""
        return f"{self.scheme}://{login}{'@' if login else ''}{self.host}{port}{self.path}{query}"


def _number(part: str) -> int | None:
    base, digits = 10, part
    if part[:2].lower() == "0x":
        base, digits = 16, part[2:]
    elif len(part) > 1 and part[0] == "0":
        base, digits = 8, part[1:]
    if not digits:
        return 0 if part else None
    try:
        return int(digits, base) if digits.isascii() and digits.isalnum() else None
    except ValueError:
        return None


def _ipv4(host: str) -> str | None:
    """The dotted form of a host whose last label is a number, or None if it is no address."""
    parts = host.rstrip(".").split(".") if host.endswith(".") else host.split(".")
    numbers = [_number(p) for p in parts]
    if len(parts) > 4 or None in numbers or any(n > 255 for n in numbers[:-1]) or numbers[-1] >= 256 ** (5 - len(numbers)):
        return None
    value = numbers[-1] + sum(n << 8 * (3 - i) for i, n in enumerate(numbers[:-1]))
    return ".".join(str(value >> s & 255) for s in (24, 16, 8, 0))


def _host(raw: str) -> str | None:
    if raw.startswith("["):
        import ipaddress

        try:
            return f"[{ipaddress.IPv6Address(raw[1:-1]).compressed}]" if raw.endswith("]") else None
        except ValueError:
            return None
    try:
        host = unquote_to_bytes(raw).decode("utf-8")
    except UnicodeDecodeError:
        return None
    host = to_ascii(host)
    if not host or FORBIDDEN_IN_HOST.search(host):
        return None
    last = host.rstrip(".").rsplit(".", 1)[-1] if not host.endswith("..") else ""
    if last and (last.isdigit() or re.fullmatch(r"0x[0-9a-f]*", last)):
        return _ipv4(host)
    return host


def _segments(path: str, base: list[str]) -> str:
    out = list(base)
    parts = re.split(r"[/\\]", path)
    for i, part in enumerate(parts):
        plain = part.lower().replace("%2e", ".")
        if plain == "..":
            if out:
                out.pop()
            if i == len(parts) - 1:
                out.append("")
        elif plain == ".":
            if i == len(parts) - 1:
                out.append("")
        else:
            out.append(quote(part, safe=PATH_SAFE))
    return "/" + "/".join(out)


def parse(text: str, base: Url | None = None) -> Url | None:
    """The parsed address, or None. Schemes other than the web's give None too."""
    text = re.sub(r"[\t\n\r]", "", re.sub(r"^[\x00-\x20]+|[\x00-\x20]+$", "", text))
    text = text.partition("#")[0]
    m = re.match(r"([a-zA-Z][a-zA-Z0-9+.-]*):", text)
    if m:
        scheme, rest = m[1].lower(), text[m.end() :]
        if scheme not in PORTS:
            return None
        if not (base and base.scheme == scheme and not re.match(r"[/\\]", rest)):
            rest = "//" + rest.lstrip("/\\")
    elif base:
        scheme, rest = base.scheme, text
    else:
        return None
    rest, question, query = rest.partition("?")
    found = quote(query, safe=QUERY_SAFE) if question else None
    if re.match(r"[/\\]{2}", rest):
        authority, slash, path = re.match(r"([^/\\]*)([/\\]?)(.*)", rest.lstrip("/\\"), re.S).groups()
        login, at, place = authority.rpartition("@")
        username, _, password = login.partition(":")
        bracket = re.fullmatch(r"(\[[^\]]*\]|[^:]*)(?::(\d*))?", place)
        host = _host(bracket[1]) if bracket and bracket[1] else None
        if host is None:
            return None
        port = int(bracket[2]) if bracket[2] else None
        if port is not None and port > 65535:
            return None
        return Url(scheme, quote(username, safe="%"), quote(password, safe="%"), host, None if port == PORTS[scheme] else port, _segments(path, []), found)
    before = base.path[1:].split("/")
    if re.match(r"[/\\]", rest):
        return base._replace(path=_segments(rest[1:], []), query=found)
    if not rest:
        return base._replace(query=found if question else base.query)
    return base._replace(path=_segments(rest, before[:-1]), query=found)


@functools.lru_cache(maxsize=1024)
def _base(text: str) -> Url | None:
    """A page's parsed address, which all its links are taken relative to."""
    return parse(text)


def imported(text: str | None) -> str | None:
    """The address of an import file as it stands, https:// put before it where a scheme is missing; None if invalid."""
    address = text if re.match(r"https?://", text, re.I) else f"https://{text}"
    return address if parse(address) else None


def researched(text: str) -> tuple[str | None, str | None]:
    """(address, problem) of a researched website."""
    text = text.strip()
    if not text:
        return None, None
    scheme = re.match(r"\s*([a-zA-Z][a-zA-Z0-9+.-]*):", text)
    if scheme and scheme[1].lower() not in ("http", "https"):
        return None, "Website must use http or https."
    url = parse(text)
    if url is None:
        return None, "Website is not a valid absolute URL."
    if url.username or url.password:
        return None, "Website must include a hostname and cannot include credentials."
    return url.text(), None


def resolved(text: str | None, base: str | None = None) -> str | None:
    """An http or https address without its fragment, taken relative to base; None for other kinds."""
    text = (text or "").strip()
    if not text or re.match(r"(?:data|blob|javascript|mailto|tel):", text, re.I):
        return None
    if base:
        start = _base(base)
        url = parse(text, start) if start else None
    else:
        url = parse(text if re.match(r"[a-z][a-z\d+.-]*://", text, re.I) else f"https://{text}")
    return url.text() if url and url.scheme in ("http", "https") else None


@F.pandas_udf(StringType())
def imported_website(cleaned: pd.Series) -> pd.Series:
    """Of cleaned, non-blank texts; null if invalid."""
    return cleaned.map(imported, na_action="ignore")


@F.pandas_udf(StructType().add("website", StringType()).add("detail", StringType()))
def researched_website(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([researched(t or "") for t in texts], columns=["website", "detail"], dtype="object")


@F.pandas_udf(StringType())
def resolved_url(texts: pd.Series, bases: pd.Series) -> pd.Series:
    return pd.Series([resolved(t, b) for t, b in zip(texts, bases, strict=True)], dtype="object")


# ---------------------------------------------------------------- native, on addresses that are parsed already


def host_without_www(url: Column) -> Column:
    return F.regexp_replace(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]*)", 1)), r"^www\.", "")


def same_site(url: Column, root: Column) -> Column:
    """True if the hosts are equal but for 'www.', or one is a sub-domain of the other."""
    a, b = host_without_www(url), host_without_www(root)
    return (a != "") & (b != "") & ((a == b) | F.endswith(a, F.concat(F.lit("."), b)) | F.endswith(b, F.concat(F.lit("."), a)))


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*/?([^?#]*)", 1)


def asset_identity(url: Column) -> Column:
    """Origin and path, from behind a version folder if there is one: renditions of one image are one asset."""
    origin = F.lower(F.regexp_extract(url, r"^([a-zA-Z][a-zA-Z0-9+.-]*://)(?:[^/?#@]*@)?[^/?#]*", 1))
    place = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1))
    path = F.concat(F.lit("/"), url_path(url))
    versioned = F.regexp_extract(path, r"(?i)/v\d+/(.+)$", 1)
    rest = F.when(versioned != "", versioned).otherwise(F.regexp_replace(path, "^/", ""))
    return F.when(origin == "", url).otherwise(F.concat(origin, place, F.lit("/"), rest))


def is_video(url: Column, context: Column) -> Column:
    return url_path(url).rlike(r"(?i)\.(mp4|webm|mov|m4v|avi|mkv|ogv|m3u8)$") | context.rlike(r"(?i)\b(video|audio)/(mp4|webm|mpeg|ogg|quicktime)\b")
