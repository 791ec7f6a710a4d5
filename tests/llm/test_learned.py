"""HTML extraction on pages of known content, toxicity by held-out accuracy, and the pipeline stage by stage."""

import random
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from cases import altered, prose
from quadrangle.llm import htmltext, linedup, queries, stages, suffixdedup, toxicity

# ---------------------------------------------------------------- 4

LONG = "A sentence that is long enough to be prose, with commas, and a full stop. Another one follows it, so that the path is plain."
MENU = "<nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li></ul></nav>"


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{{}}</style><script>var x = '</p><p>no';</script>{head}</head><body>{body}</body></html>"


@pytest.mark.parametrize(
    ("html", "expected"),
    [
        (None, ""),
        ("", ""),
        ("<html><body></body></html>", ""),
        (page(f"{MENU}<article><h1>Head</h1><p>{LONG}</p><p>Short.</p></article><footer>&copy; x</footer>"), f"Head\n{LONG}\nShort."),
        (page(f"{MENU}<div class='ad'>Buy now, it is cheap.</div><article><h1>H</h1><p><b>{LONG}<br><p>{LONG}</article>"), f"H\n{LONG}\n{LONG}"),
        (page(f"<header><p>{LONG}</p></header><main><p>{LONG}</p><p>a &lt;b&gt;\n  c&nbsp;d &#233;&eacute;</p></main><aside>{LONG}</aside>"), f"{LONG}\na <b> c d éé"),
        (page(f"<div id='content-with-sidebar'><h2>Title</h2><p>{LONG}</p><p>{LONG}</p></div><div class='sidebar'><p>{LONG}</p></div>"), f"Title\n{LONG}\n{LONG}"),
        (page(f"<div><div><p>{LONG}</p><ul><li>One item</li><li>Two <i>items</i></li></ul><p>{LONG}</p></div><section id='comments'><p>{LONG}</p></section></div>"), f"{LONG}\nOne item\nTwo items\n{LONG}"),
        (page(f"<article><p>{LONG}</p><form><p>Your name, please.</p><button>Send</button></form><div role='alert'>Notice.</div><!-- <p>no</p> --><p>{LONG}</p></article>"), f"{LONG}\n{LONG}"),
        (page(f"<article><p>{LONG}</p><ul class='related'><li><a href='x'>Other story</a></li></ul><noscript>no</noscript><svg><text>no</text></svg></article>"), LONG),
        (page(f"<div class='page-header'>Site name</div><article><header class='entry-header'><h1>Own</h1></header><p>{LONG}</p></article>"), f"Own\n{LONG}"),
        (f"<article><p>{LONG}</p><p>cut o", f"{LONG}\ncut o"),
        ("<p>plain text only", "plain text only"),
        ("no markup at all &amp; so on", "no markup at all & so on"),
        (f'<article><p title="a > b">{LONG}</p><p class="x>{LONG}</p></article>', f"{LONG}\n{LONG}"),
    ],
)
def test_pages(html, expected):
    assert htmltext.main_text(html) == expected


def test_extract(spark, sf_dir):
    rows = [(1, "u", page(f"<article><p>{LONG} \U0001f600</p></article>"), "x"), (None, None, None, "x"), (1, "u", page(f"<article><p>{LONG}</p></article>"), "x")]
    out = htmltext.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string"))
    assert sorted((r.n_chars, r.text) for r in out.collect()) == [(0, ""), (len(LONG), LONG), (len(LONG) + 2, f"{LONG} \U0001f600")]
    assert htmltext.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    # the driver's pages hold their text in an article of headings and paragraphs, which plain patterns can cut out
    import html
    import re

    for r in queries.op4_html_extraction(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "html"), "page_id").collect():
        article = re.search("<article>(.*?)(?:</article>|$)", r.html, re.S)[1]
        parts = (" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split("</?(?:p|h1)>", article))
        assert r.text == "\n".join(p for p in parts if p)


def noisy(n=3):
    """A page without <article> or known class words: what is no article is told by its paths' ratios alone."""
    text = "".join(f"<p>{LONG} Number {i}.</p>" + ("<div class='x1'>12 people like this</div>" if i == 0 else "") for i in range(n))
    return page(
        "<div class='q1'><a href='/'>Home</a> <a href='/n'>News</a> <a href='/s'>Sports results</a></div>"
        f"<div class='q2'><h1>The Title</h1><div class='q3'><div class='x2'>Posted in: News</div>{text}<ul><li>One item</li><li>Two items</li></ul><div class='x3'>Buy cheap shoes now</div></div>"
        "<div class='q4'><div class='u'><span>Ann</span></div><div class='v'><p>I agree, it is so.</p></div><div class='u'><span>Bob</span></div><div class='v'><p>Not me, no.</p></div></div></div>"
        "<div class='q5'>All rights reserved</div>"
    )


def test_ratios_decide():
    expected = "\n".join(["The Title", *(f"{LONG} Number {i}." for i in range(3)), "One item", "Two items"])
    assert htmltext.main_text(noisy()) == expected
    assert htmltext.main_text(noisy(), share=0.0) != expected  # without the threshold the page's other blocks stay


PARA, FOOT = f"<p>{LONG}</p>", "<footer><p>Copyright 2020 by us, all rights reserved.</p></footer>"


def comments(head="", tag="div"):
    return f"<div class=z>{''.join(f'<{tag} class=q>{head}<p>{LONG} {LONG}</p></{tag}>' for _ in range(3))}</div>"


TEMPLATES = {
    "sections": (f"{MENU}<main><section class=s1><h2>One</h2>{PARA}</section><section class=s2><h2>Two</h2>{PARA}</section><section class=s3>{PARA}</section></main>{FOOT}", ["One", LONG, "Two", LONG, LONG]),
    "split wrappers": (f"{MENU}<div class=a>{PARA}</div><div class=b>{PARA}</div><div class=c>{PARA}</div>{FOOT}", [LONG] * 3),
    "title apart": (f"{MENU}<div class=w><div class=t><h1>The title</h1></div><div class=body>{PARA * 3}</div></div>{FOOT}", ["The title", *[LONG] * 3]),
    "comments with authors": (f"{MENU}<div class=w><h1>T</h1>{PARA * 2}</div>{comments('<span>Ann</span>')}{FOOT}", ["T", LONG, LONG]),
    "comments after an article": (f"{MENU}<article><h1>T</h1>{PARA * 2}</article>{comments()}{FOOT}", ["T", LONG, LONG]),
    "comments without a title": (f"{MENU}<div class=w>{PARA * 2}</div>{comments('<div class=u>Ann</div>')}{FOOT}", [LONG, LONG]),
    "comments within an article": (f"{MENU}<article><h1>T</h1>{PARA * 2}{comments('<i>Ann, today</i>')}</article>{FOOT}", ["T", LONG, LONG]),
    "page in a form": (f"<form action=/>{MENU}<div class=x><h1>Title</h1>{PARA * 2}</div>{FOOT}</form>", ["Title", LONG, LONG]),
    "form in main": (f"<main><form>{PARA}</form></main>", [LONG]),
    "advert of its own class": (f"{MENU}<article><h1>T</h1>{PARA}<p class=zz>Buy cheap shoes now</p>{PARA}</article>", ["T", LONG, LONG]),
    "list": (f"{MENU}<article><h1>T</h1>{PARA}<ul><li>One item</li><li>Two items</li></ul>{PARA}</article>", ["T", LONG, "One item", "Two items", LONG]),
    "long list": (f"{MENU}<article><h1>T</h1>{PARA}<ul>{''.join(f'<li>Item number {i}</li>' for i in range(12))}</ul>{PARA}</article>", ["T", LONG, *(f"Item number {i}" for i in range(12)), LONG]),
    "line breaks": (f"{MENU}<div id=c>{LONG}<br><br>{LONG}</div>{FOOT}", [f"{LONG} {LONG}"]),
    "short paragraphs": (f"{MENU}<article><h1>Title here</h1><p>Short one.</p>{PARA}<p>No.</p></article>", ["Title here", "Short one.", LONG, "No."]),
    "cookie notice": (f"<div class='cookie-notice'>{PARA}</div>{MENU}<div class=c>{PARA * 2}</div>", [LONG, LONG]),
    "aside": (f"<article><h1>T</h1>{PARA}<aside>{PARA}</aside>{PARA}</article>", ["T", LONG, LONG]),
    "quotation and code": (f"<article><h1>T</h1>{PARA}<blockquote>A quoted line, of someone.</blockquote><pre>code = 1</pre>{PARA}</article>", ["T", LONG, "A quoted line, of someone.", "code = 1", LONG]),
    "headings and a box of links": (
        f"{MENU}<div class=c><h1>T</h1>{PARA}<h2>Sub</h2>{PARA * 2}<h3>Deep</h3>{PARA}</div><div class=side><h3>Most read</h3><ul><li><a href=/1>Some long headline of an article</a></li></ul></div>{FOOT}",
        ["T", LONG, "Sub", LONG, LONG, "Deep", LONG],
    ),
    "paragraphs as divs": (f"<div class=m><div class=t>Tiny</div>{''.join(f'<div class=para>{LONG}</div>' for _ in range(4))}</div>", [LONG] * 4),
    "wrapped paragraphs": (f"{MENU}<h1>T</h1><div class=lead>{PARA}</div><div class=all>{''.join(f'<div class=par>{PARA}</div>' for _ in range(8))}</div>{FOOT}", ["T", *[LONG] * 9]),
    "several posts": (f"{MENU}<main>{''.join(f'<article class=post><h2>Post {i}</h2>{PARA * 2}</article>' for i in range(3))}</main>{FOOT}", [x for i in range(3) for x in (f"Post {i}", LONG, LONG)]),
    "table layout": (f"<table><tr><td class=l><a href=/>Home</a><br><a href=/x>Else</a></td><td class=m><h1>Head</h1>{PARA * 2}</td></tr></table>", ["Head", LONG, LONG]),
}


@pytest.mark.parametrize("name", list(TEMPLATES))
def test_templates(name):
    html, expected = TEMPLATES[name]
    assert htmltext.main_text(page(html)).split("\n") == expected


def test_the_threshold_decides(spark, sf_dir):
    """Without it all of a page comes out, on every page of the driver and on nearly all templates; with a high one nothing short of the best path."""
    pages = [r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("html").collect()]
    assert all(len(htmltext.main_text(p, share=0.0)) > len(htmltext.main_text(p)) > len(htmltext.main_text(p, share=1.5)) for p in pages)
    assert sum(htmltext.main_text(page(h), share=0.0) != "\n".join(e) for h, e in TEMPLATES.values()) >= 15
    for html, _ in TEMPLATES.values():  # blocks leave as the threshold grows, none comes
        sizes = [len(htmltext.main_text(page(html), share=s)) for s in (0, 0.2, 0.4, 0.8, 1.2, 3)]
        assert sizes == sorted(sizes, reverse=True)


def plain_ratios(blocks):
    """Path ratios of (path, text) blocks without links or markup, one after the other, as the method is told."""
    import math
    import re

    of = {}
    for path, text in blocks:
        of.setdefault(path, []).append((min(htmltext.LONG, len(text)), min(htmltext.MANY, len(re.findall(r"[.,;:!?]", text)))))
    mean = {p: (sum(t for t, _ in v) / len(v), 1 + sum(m for _, m in v) / len(v)) for p, v in of.items()}
    out = {}
    for i, (path, _) in enumerate(blocks):
        near = [0.0, 0.0, 0.0]
        for j in range(max(0, i - 2), min(len(blocks), i + 3)):
            w = math.exp(-((i - j) ** 2) / 2)
            near = [near[0] + w, near[1] + w * mean[blocks[j][0]][0], near[2] + w * mean[blocks[j][0]][1]]
        own, around = math.sqrt(mean[path][0] * mean[path][1]), math.sqrt(near[1] * near[2]) / near[0]
        out.setdefault(path, []).append(own**htmltext.OWN * around ** (1 - htmltext.OWN))
    return {p: sum(v) / len(v) for p, v in out.items()}


def test_ratios_like_brute_force():
    rnd = random.Random(5)
    for _ in range(50):
        blocks = [(rnd.choice("abc"), "word, " * rnd.randint(1, 120)) for _ in range(rnd.randint(1, 12))]
        read = htmltext.read("<body>" + "".join(f"<section class={c}>{t}</section>" for c, t in blocks))
        ratio, weights = htmltext.path_ratios(read, list(range(len(blocks))))
        wanted = plain_ratios([(c, t.strip()) for c, t in blocks])
        got = {c: ratio[read.path[read.element[b]]] for b, (c, _) in enumerate(blocks)}
        assert got == pytest.approx(wanted) and set(weights.values()) == {1.0}


def test_deep_and_long_pages():
    """Work grows with the page, not with its depth; nothing is cut off."""
    import time

    def seconds(n):
        began = time.perf_counter()
        out = htmltext.main_text("<div>Text here, for all. " * n)
        assert out.count("Text here, for all.") == n
        return time.perf_counter() - began

    seconds(500)
    assert seconds(40_000) < 30 * max(seconds(4_000), 0.02)
    words = " ".join(["word"] * 300_000) + "."
    assert htmltext.main_text(page(f"<article><p>{words}</p></article>")) == words


# ---------------------------------------------------------------- 8


def test_toxicity_on_held_out_rows(spark, sf_dir):
    from pathlib import Path

    folder = sf_dir.replace("sf0.01", "sf0.1")
    folder = folder if Path(folder).exists() else sf_dir
    scores = queries.op8_toxicity(spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = scores.where("held_out").join(labels, "doc_id").select("toxic", "score", "predicted").collect()
    bad, good = [r.score for r in rows if r.toxic], [r.score for r in rows if not r.toxic]
    auc = sum((b > g) + (b == g) / 2 for b in bad for g in good) / (len(bad) * len(good))
    assert auc > 0.9
    assert sum(r.predicted for r in rows if not r.toxic) <= 0.05 * len(good)


def test_toxicity_odd_cases(documents, no_documents, spark):
    labels = spark.createDataFrame([(i, 1, int(i % 7 == 0)) for i in range(60)] + [(None, 1, 1), (3, 0, None)], "doc_id long, quality int, toxic int")
    docs = documents(1)
    out = toxicity.classify(docs, labels)
    assert out.count() == docs.count() and out.where("score is null or score < 0 or score > 1").count() == 0
    assert {r[0] for r in out.where("doc_id is null").select("held_out").collect()} == {False}
    assert toxicity.classify(docs, labels.limit(0)).where("predicted = 1").count() == 0
    assert toxicity.classify(no_documents, labels).count() == 0
    # labels of held-out rows change nothing
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert sorted(map(str, toxicity.classify(docs, turned).collect())) == sorted(map(str, out.collect()))


# ---------------------------------------------------------------- the pipeline


@pytest.fixture
def folder(spark, tmp_path):
    """Tables with planted cases: toxic rows, a repeated line, near and exact copies, and a passage that two documents share."""
    rnd = random.Random(7)
    own = [prose(rnd, 120) for _ in range(80)]
    line = "Please accept all of the cookies of this very site before reading on."
    passage = prose(rnd, 90)
    rows = {i: t for i, t in enumerate(own)}
    rows[80] = own[0]
    rows[81] = altered(rnd, own[1].replace("\n", " "), 0.0) + " end"
    rows[82], rows[83] = own[2][:200] + "\n" + line + "\nx" + own[3][:150], own[4][:200] + "\n" + line.replace("very", "verry") + "\ny" + own[5][:150]
    rows[84], rows[85] = "q" + prose(rnd, 60) + passage, "r" + prose(rnd, 60) + passage
    for i in range(100, 160):
        rows[i] = prose(rnd, 60) + " vileword nastyphrase horridterm " + prose(rnd, 10)
    data = [(i, t, "en", f"s{i % 4}", len(t)) for i, t in rows.items()] + [(200, None, "en", "s", 0)]
    spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, 1, int(i >= 100)) for i in rows if i < 80 or i >= 100]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path), rows


def test_stages(spark, folder):
    path, rows = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    schema = docs.columns
    kept = {}
    for n, (name, stage) in enumerate(stages.STAGES):
        out = stage(spark, docs, path)
        out.write.parquet(f"{path}/{n}")
        docs = spark.read.parquet(f"{path}/{n}")
        if n < 4:
            assert docs.columns == schema
        kept[name] = {r.doc_id: r for r in docs.collect()}
    tox, lines, near, repeats = (kept[k] for k in ("toxicity", "line_dedup", "minhash_near_dedup", "suffix_array_dedup"))
    assert not [i for i in tox if 100 <= i < 160] and {0, 1, 2, 3, 4, 5, *range(80, 86), 200} <= set(tox) and len(tox) > 82
    assert "cookies" in lines[82].text and "cookies" not in lines[83].text and lines[83].n_chars == len(lines[83].text)
    assert 80 not in near and 81 not in near and {0, 1, 82, 83, 84, 85} <= set(near)
    left = [repeats[i].text for i in (84, 85)]
    windows = Counter(t[i : i + 200] for r in repeats.values() for t in {(r.text or "").encode()} for i in range(len(t) - 199))
    assert all(len(t) < len(near[i].text) for i, t in zip((84, 85), left, strict=True)) and max(windows.values(), default=1) == 1
    packed = docs.groupBy("doc_id").agg(F.sum("size").alias("n")).collect()
    assert {r.doc_id: r.n for r in packed} == {i: len(r.text or "") for i, r in repeats.items()}


def test_run(spark, folder):
    path, _ = folder
    out = stages.run(spark, path)
    assert out.count() > 80 and 4 <= len(stages.STAGES) <= 5 and stages.ORACLE_SQL is None


def test_stages_on_nothing(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert stages.run(spark, str(tmp_path)).count() == 0


def python_workers(spark):
    """MB of its own that each Python worker holds, by pid."""
    pids = [int(p.name) for p in Path("/proc").iterdir() if p.name.isdigit()]
    out = {}
    for pid in pids:
        try:
            if b"pyspark.daemon" in Path(f"/proc/{pid}/cmdline").read_bytes():
                out[pid] = sum(map(int, re.findall(r"\nPrivate_\w+:\s+(\d+)", Path(f"/proc/{pid}/smaps_rollup").read_text()))) / 1024
        except OSError:
            pass
    return out


@pytest.mark.skipif(not Path("/proc/self/smaps_rollup").exists(), reason="memory is read from /proc")
def test_waiting_workers_keep_little_memory(spark):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghij", k=7)) for _ in range(3000)]
    line = spark.createDataFrame([(" ".join(rng.choices(words, k=600)),) for _ in range(50)], "text string")
    many = spark.range(120).crossJoin(line).selectExpr("id as doc_id", "text").coalesce(1)
    model = (np.arange(1, 100, dtype=np.uint64) << np.uint64(50), np.ones(99, np.float32), 0.0)

    def worked():
        toxicity.with_score(many, model).write.format("noop").mode("overwrite").save()
        linedup.line_table(many).write.format("noop").mode("overwrite").save()
        suffixdedup.anchors(many, 200, 40, True).write.format("noop").mode("overwrite").save()

    held = python_workers(spark)
    worked()
    more = {pid: mb - held.get(pid, 0) for pid, mb in python_workers(spark).items() if mb - held.get(pid, 0) > 5}
    assert more and max(more.values()) < 90, more
