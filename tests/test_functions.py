import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quadrangle.functions import hosts, html_mentions, scoring
from quadrangle.functions import text as T
from quadrangle.functions import urls as U

NBSP, BOM = chr(0xA0), chr(0xFEFF)


def one(spark, column, **values):
    rows = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)) if values else spark.range(1)
    return rows.select(column.alias("x")).first()[0]


@pytest.mark.parametrize(
    ("given_text", "expected"),
    [(None, ""), ("-1", ""), (" -3 ", ""), ("-4", "-4"), (f"{BOM} a b{NBSP}", "a b"), (f"{chr(0x2003)}x{chr(0x3000)}", "x"), ("", "")],
)
def test_clean(spark, given_text, expected):
    assert one(spark, T.clean("a"), a=given_text) == expected


@pytest.mark.parametrize(
    ("name", "expected"),
    [
        ("São & Co College", "sao and co college"), ("École №5", "ecole no5"), ("AT&T High", "at and t high"), ("O'Brien–Smith", "o brien smith"),
        (chr(0xFB01) + chr(0xBD), "fi1 2"), ("...", ""), (None, ""), (" A  b ", "a b"),
    ],
)
def test_normalize_name(spark, name, expected):
    assert one(spark, T.normalize_name("a"), a=name) == expected


@settings(max_examples=200, deadline=None)
@given(st.text())
def test_normal_form_is_stable(text):
    once = T.normalized_text(text)
    assert T.normalized_text(once) == once


def test_states_and_parts(spark):
    rows = spark.createDataFrame([("1",), ("06",), ("001",), ("11",), ("",), (None,)], "a string").select(T.state_from_code("a")).collect()
    assert [r[0] for r in rows] == ["AL", "CA", None, None, None, None]
    assert one(spark, T.join_parts(["a", F.lit("-2"), F.lit(" b ")]), a="x") == "x, b"
    assert one(spark, T.join_parts([F.lit(""), F.lit(None).cast("string")])) is None
    assert one(spark, T.preview_name("a", F.lit(2), vision=True), a="x/y.1") == "x_y_1-candidate-2-vision.webp"
    assert one(spark, T.logo_object_key(F.lit("college"), "a"), a="7") == "education/colleges/7.webp"
    assert one(spark, T.escape_html("a"), a='<a b="c">&') == "&lt;a b=&quot;c&quot;&gt;&amp;"


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("www.x.edu", "https://www.x.edu"), ("HTTP://X.edu", "HTTP://X.edu"), ("https:///x.edu", "https:///x.edu"), ("https://x.edu/a b", "https://x.edu/a b"),
        ("ftp://x", "https://ftp://x"), ("https://a_b.edu", "https://a_b.edu"), ("https://1.2.3.999", None), ("http://bad host", None), ("https://", None),
    ],
)
def test_imported_website(text, expected):
    assert U.imported(text) == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("https://a.org/#top", ("https://a.org/", None)), ("HTTPS://A.org", ("https://a.org/", None)), ("https://a.org:443/x/../y?q=1", ("https://a.org/y?q=1", None)), ("", (None, None)),
        ("ftp://x.org", (None, "Website must use http or https.")), ("mailto:a@b", (None, "Website must use http or https.")),
        ("https://u:p@x.org", (None, "Website must include a hostname and cannot include credentials.")), ("x.org", (None, "Website is not a valid absolute URL.")),
        ("http://[::1]:8080/", ("http://[::1]:8080/", None)), ("http://0x7f.1/", ("http://127.0.0.1/", None)), ("https://bücher.de", ("https://xn--bcher-kva.de/", None)),
    ],
)
def test_researched_website(text, expected):
    assert U.researched(text) == expected


@pytest.mark.parametrize(
    ("text", "base", "expected"),
    [
        ("/a/./b/../c", "https://x.org/p/q?z", "https://x.org/a/c"), ("d", "https://x.org/p/q", "https://x.org/p/d"), ("?k", "https://x.org/p/q", "https://x.org/p/q?k"),
        ("//y.org/é", "https://x.org/", "https://y.org/%C3%A9"), ("javascript:1", "https://x.org/", None), ("data:x", "https://x.org/", None), ("", "https://x.org/", None),
        ("x.org/a#f", None, "https://x.org/a"), (None, None, None), ("#top", "https://x.org/p", "https://x.org/p"),
    ],
)
def test_resolved(text, base, expected):
    assert U.resolved(text, base) == expected


@settings(max_examples=200, deadline=None)
@given(st.text())
def test_parsed_addresses_are_stable(text):
    url = U.parse("https://" + text)
    assert url is None or U.parse(url.text()) == url


def test_sites_and_assets(spark):
    def same(a, b):
        return one(spark, U.same_site(F.lit(a), F.lit(b)))

    assert same("https://www.x.edu/a", "http://x.edu") and same("https://sub.x.edu", "https://www.x.edu") and same("https://x.edu", "https://sub.x.edu")
    assert not same("https://ax.edu", "https://x.edu") and not same("nonsense", "https://x.edu")
    asset = [one(spark, U.asset_identity(F.lit(u))) for u in ("https://C.org/resize/v12/logo.png?w=1", "https://c.org/v7/logo.png", "https://c.org/a/logo.png?x")]
    assert asset == ["https://c.org/logo.png", "https://c.org/logo.png", "https://c.org/a/logo.png"]
    assert one(spark, U.is_video(F.lit("https://c.org/a.MP4"), F.lit(""))) and one(spark, U.is_video(F.lit("https://c.org/a"), F.lit("type=video/mp4")))


def test_scores(spark):
    def points(text):
        return one(spark, scoring.token_score(F.lit(text)))

    assert (points("branding"), points("wordmark"), points("Logo hero"), points("x")) == (34, 34, 2, 0)
    match = one(spark, scoring.institution_match(F.lit("Lincoln Park North High School"), F.lit("lincoln lpn park")))
    assert match.score == 59 and match.reasons == ["institution:lincoln", "institution:park", "institution-acronym:LPN"]
    assert one(spark, scoring.structure_score(F.lit('<header class="site-logo">'))) == 54
    assert one(spark, scoring.shape_score(F.lit(40), F.lit(64), F.lit(64))) == 76
    assert one(spark, scoring.shape_score(F.lit(40), F.lit(500), F.lit(10))) == 58
    assert one(spark, scoring.review_score(F.lit(90), F.lit("photo"), F.lit(True))) == 5
    assert one(spark, scoring.direct_signal(F.lit("https://x.org/img/logo.png"), F.lit(""))) and not one(spark, scoring.direct_signal(F.lit("https://x.org/catalogo"), F.lit("")))
    assert one(spark, scoring.rejected_asset(F.lit("/social-sprite.png")))


def test_compact_texts(spark):
    assert one(spark, scoring.asset_name(F.lit("https://x.org/a/logo.png?x"))) == "logo.png" and one(spark, scoring.asset_name(F.lit("https://x.org/"))) == "unnamed asset"
    assert one(spark, scoring.asset_name(F.lit(""))) == "inline SVG" and one(spark, scoring.asset_name(F.lit("logo"))) == "logo"
    assert one(spark, scoring.compact_metadata(F.lit("tag=img; data-lazy=x; alt=Logo; src=y"))) == "tag=img; alt=Logo"
    assert one(spark, scoring.compact_ancestry(F.lit("img > div(x) > header(class=h) > a"))) == "img > header(class=h)"
    assert one(spark, T.truncated("a", 4), a="abcdef") == "abc" + chr(0x2026) and one(spark, T.error_text("a"), a=" a\n b ") == "a b"


PAGE = """<html><head><link rel="icon" href="/i.ico"><link rel="manifest" href="m.json"><meta property="og:image" content="/pic.jpg"><meta name="twitter:image" content="/school-logo.png"></head>
<body><header><a href="/"><img class="site-logo" src="/logo.png" data-image-sizes='[{"url":"/resize/v1/x/logo.png"},{"url":"/resize/v2/x/logo.png"}]'></a><svg class="school-logo"><title>Lincoln</title></svg></header>
<main><img srcset="/a.jpg 1x, /b.jpg 2x"><div style="background:url(hero.jpg)"></div><video><source src="v.mp4"></video><img src="/social-sprite.png"></main>
<a href="/about">About us</a><a href="https://other.org/about">x</a></body></html>"""


def test_mentions():
    found, manifests = html_mentions.mentions(PAGE, "https://x.edu/"), html_mentions.manifests(PAGE, "https://x.edu/")
    urls = [f[2] for f in found if f[2]]
    assert manifests == ["https://x.edu/m.json"]
    assert urls[0] == "https://x.edu/i.ico" and urls[-1] == "https://x.edu/favicon.ico"
    assert "https://x.edu/resize/v1/x/logo.png" in urls and "https://x.edu/b.jpg" in urls and "https://x.edu/v.mp4" not in urls
    (svg,) = [f for f in found if f[8]]
    assert svg[8].startswith("<svg class") and svg[8].endswith("</svg>") and svg[7] == "header"
    logo = next(f for f in found if f[2] == "https://x.edu/logo.png")
    assert logo[6].startswith("img(class=site-logo") and "header" in logo[6] and logo[7] == "header"
    assert [u for u, _ in html_mentions.links(PAGE, "https://x.edu/")] == ["https://x.edu/", "https://x.edu/about", "https://other.org/about"]
    assert html_mentions.mentions("", "https://x.edu/")[0][1] == "favicon-fallback"
    assert html_mentions.described_urls("{&quot;a&quot;: {&quot;SRC&quot;: &quot;u&quot;}}") == ["u"] and html_mentions.described_urls("/a.png") == []


@pytest.mark.parametrize(
    ("host", "expected"),
    [
        ("fa\u00df.de", "xn--fa-hia.de"), ("FA\u1e9e.DE", "xn--fa-hia.de"), ("B\u00fccher.example", "xn--bcher-kva.example"), ("bu\u0308cher.example", "xn--bcher-kva.example"),
        ("\u03b2\u03cc\u03bb\u03bf\u03c2.com", "xn--nxasmm1c.com"), ("\u65e5\u672c\u8a9e\u3002jp", "xn--wgv71a119e.jp"), ("\uff45\uff58\uff0e\uff43om", "ex.com"), ("ex\u00adample.com", "example.com"),
        ("\u2615.example", "xn--53h.example"), ("XN--FA-HIA.de", "xn--fa-hia.de"), ("Plain.Host_1", "plain.host_1"), ("a..b", "a..b"), ("\ufb01n.fi", "fin.fi"),
        ("\u0915\u094d\u200d\u0937.com", "xn--11b2ezcw70k.com"), ("\u0646\u0627\u0645\u0647\u200c\u0627\u06cc.com", "xn--mgba3gch31f060k.com"), ("\u05d0\u05d1.com", "xn--4dbc.com"),
        ("a\u200db.com", None), ("a\u200cb.com", None), ("xn--a.com", None), ("xn--zzzzzz99999.com", None), ("\u0301a.com", None), ("\u202ea.com", None), ("a\ue000.com", None),
        ("\u05d0a.com", None), ("\u05d01\u0661.com", None), ("1\u05d0.com", None), ("\u2488a.com", None), ("a\u2025b", None), ("xn--FA-ia9b.com", None),
    ],
)
def test_hosts(host, expected):
    assert hosts.to_ascii(host) == expected


def test_hosts_of_other_scripts_in_addresses():
    assert U.resolved("https://fa\u00df.de/x") == "https://xn--fa-hia.de/x"
    assert U.resolved("https://a\u200db.com/") is None and U.imported("a\u200db.com") is None


@given(st.text(st.characters(exclude_categories=("Cs", "Cn")), min_size=1, max_size=12))
def test_hosts_do_not_change_again(host):
    once = hosts.to_ascii(host)
    assert once is None or (once.isascii() and hosts.to_ascii(once) == once)


def test_mapping_like_the_published_table():
    """Against a copy of the standard's table, where one is installed; code points that this Python does not know are left out."""
    idna = pytest.importorskip("idna")
    for code in (*range(128, 0x3400), *range(0xA000, 0xAC00), *range(0xF900, 0x10000), *range(0x10000, 0x1FC00), *range(0xE0000, 0xE0200)):
        if unicodedata.category(chr(code)) in ("Cn", "Cs"):
            continue
        try:
            theirs = idna.uts46_remap(chr(code), std3_rules=False)
        except idna.IDNAError:
            theirs = None
        mine = hosts.mapped(chr(code))
        assert (mine and unicodedata.normalize("NFC", mine)) == theirs or (mine is None and theirs is None), hex(code)
