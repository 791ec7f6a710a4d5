"""Logo candidates from pages: discovery, scores, one candidate for each asset, and the crawl over a table of pages.

Pages are parsed in Arrow batches; all rules and scores are column expressions.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from quadrangle.functions import scoring as S
from quadrangle.functions import urls as U
from quadrangle.functions.html_mentions import FIELDS, links, manifests, streamed
from quadrangle.functions.text import collapsed
from quadrangle.sources.scratch import measured, settings, written

MENTION = StructType([StructField(n, IntegerType() if n in ("phase", "base_score") else StringType()) for n in FIELDS])
MAX_PAGES, MAX_INVENTORY = 4, 144
#: Addresses that are broadcast to the pages.
FEW_ADDRESSES = 100_000
#: Institutions for each part of a crawl's shuffles, and the bytes of a shuffle that a task is given (eight times as many of files). Pages
#: of one template, and their addresses, take little room there and much in memory, where tasks of the usual size would hold ever more.
CRAWL_ROWS, CRAWL_BYTES = 20_000, 1 << 20


#: Mentions and characters of them that leave a task at a time.
BATCH_MENTIONS, BATCH_CHARS = 4096, 1 << 21


@F.arrow_udf(ArrayType(StringType()))
def _manifests(html: pa.Array, url: pa.Array) -> pa.Array:
    return pa.array([manifests(h or "", u or "") for h, u in zip(html.to_pylist(), url.to_pylist(), strict=True)], pa.list_(pa.string()))


@F.arrow_udf(ArrayType(StructType([StructField("url", StringType()), StructField("about", StringType())])))
def _links(html: pa.Array, url: pa.Array) -> pa.Array:
    kind = pa.list_(pa.struct([("url", pa.string()), ("about", pa.string())]))
    pages = zip(html.to_pylist(), url.to_pylist(), strict=True)
    return pa.array([[{"url": a, "about": b} for a, b in links(h or "", u or "")] for h, u in pages], kind)


def page_mentions(pages: DataFrame) -> DataFrame:
    """pages (id, name, page_url, html and what else) with one row for each mention, `ord` being its place in the order of discovery.

    A page's mentions leave the task in batches while the page is being read, so a page with any number of them takes the memory of its
    text and one batch."""
    keep = [c for c in pages.columns if c != "html"]
    kinds = [pa.int64(), *(pa.int32() if f.dataType == IntegerType() else pa.string() for f in MENTION.fields)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, of, chars = [], [], 0
            own = b.select(keep)

            def full(own: pa.RecordBatch = own) -> pa.RecordBatch:
                found = [pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
                return pa.RecordBatch.from_arrays([*own.take(pa.array(of)).columns, *found], [*keep, "ord", *FIELDS])

            html, url = b.column("html"), b.column("page_url")
            for i in range(len(b)):
                for found in streamed(html[i].as_py() or "", url[i].as_py() or ""):
                    rows.append(found)
                    of.append(i)
                    chars += sum(len(x) for x in found if isinstance(x, str))
                    if len(rows) >= BATCH_MENTIONS or chars >= BATCH_CHARS:
                        yield full()
                        rows, of, chars = [], [], 0
            if rows:
                yield full()

    kept = pages.select(*keep).schema.fields
    return pages.select(*keep, "html").mapInArrow(run, StructType([*kept, StructField("ord", LongType()), *MENTION.fields]))


def manifest_urls(pages: DataFrame, at_most: int = 2) -> DataFrame:
    return pages.select("id", "page_url", F.explode(F.slice(_manifests("html", "page_url"), 1, at_most)).alias("manifest_url"))


def manifest_mentions(manifests: DataFrame) -> DataFrame:
    """Mentions of the first eight icons of web manifests (id, name, page_url, manifest as JSON text)."""
    icons = F.from_json("manifest", "struct<icons: array<struct<src: string, sizes: string, purpose: string>>>")["icons"]
    rows = manifests.select(*(c for c in manifests.columns if c != "manifest"), F.posexplode(F.slice(icons, 1, 8)).alias("_n", "_i"))
    about = F.concat_ws(" ", F.coalesce("_i.sizes", F.lit("")), F.coalesce("_i.purpose", F.lit("")))
    none = F.lit("")
    return rows.where("_i.src is not null").select(
        *(c for c in rows.columns if c not in ("_n", "_i")), (F.lit(8 << 40) + F.col("_n")).alias("ord"), F.lit(8).alias("phase"), F.lit("web-manifest").alias("source"), U.resolved_url("_i.src", "page_url").alias("raw_url"),
        F.lit(28).alias("base_score"), about.alias("signal"), none.alias("structure"), none.alias("ancestry"), none.alias("region"), F.lit(None).cast("string").alias("svg"),
    ).where("raw_url is not null")


def scored(found: DataFrame) -> DataFrame:
    """Mentions that can be a logo, with key, qualification, initial_score and reasons."""
    image, svg = found.where("svg is null"), found.where("svg is not null")
    url, around = F.col("raw_url"), F.concat_ws(" ", "signal", "ancestry")
    generic, fallback = F.col("source").isin(*S.GENERIC_SOURCES), F.col("source").isin(*S.FAVICON_SOURCES)
    text, direct = S.signal_text(url, around), S.direct_signal(url, around)
    image = image.where(~U.is_video(url, F.col("signal")) & ~S.rejected_asset(text))
    image = image.where(F.when(F.col("source") == "css-background", direct).otherwise(generic | fallback | direct))
    near = S.token_score(around)
    near = F.when(generic, (near * F.lit(0.35)).cast("int")).otherwise(near)
    match = S.institution_match(F.col("name"), text)
    images = image.withColumn("_match", match).withColumns(
        {
            "key": U.asset_identity(url),
            "url": url,
            "qualification": F.when(direct, "strong").otherwise("fallback"),
            "metadata": collapsed("signal", 500),
            "initial_score": F.col("base_score") + S.token_score(url) + near + F.col("_match.score") + S.structure_score(F.col("structure")),
            "reasons": F.concat(
                F.array(F.concat(F.lit("source:"), "source")), S.token_reasons(url, "url-"), S.token_reasons(around, "context-"), F.col("_match.reasons"), S.structure_reasons(F.col("structure"))
            ),
        }
    )
    context = F.concat_ws(" ", "signal", "ancestry")
    last = F.lower(F.when(F.length(context) > 500, F.substring(context, -500, 500)).otherwise(context))
    title = F.regexp_replace(F.regexp_extract("svg", r"(?is)<title\b[^>]*>(.*?)</title\s*>", 1), "<[^>]*>", " ")
    signals = F.concat_ws(" ", title, F.when(F.length("signal") > 500, F.substring("signal", -500, 500)).otherwise(F.col("signal")), "ancestry")
    svg = svg.where(~S.rejected_asset(last) & last.rlike(S.SVG_CONTEXT) & ~S.rejected_asset(signals))
    svg = svg.withColumn("_match", S.institution_match(F.col("name"), signals)).where(S.has_positive_signal(signals) | (F.col("_match.score") != 0))
    svgs = svg.withColumns(
        {
            "key": F.concat(F.lit("inline-svg:"), F.sha2(F.concat("page_url", "svg"), 256)),
            "url": F.lit(None).cast("string"),
            "qualification": F.lit("strong"),
            "metadata": collapsed(signals, 500),
            "initial_score": F.col("base_score") + S.token_score(signals) + F.col("_match.score") + S.structure_score(context),
            "reasons": F.concat(F.array(F.lit("source:inline-svg")), S.token_reasons(signals), F.col("_match.reasons"), S.structure_reasons(context)),
        }
    )
    out = ["key", "url", "qualification", "metadata", "initial_score", "reasons"]
    keep = [c for c in found.columns if c not in ("raw_url", "base_score", "signal", "structure", "phase")]
    return images.select(*keep, *out).unionByName(svgs.select(*keep, *out))


def best_per_asset(candidates: DataFrame, by: str = "id", order: Column | None = None) -> DataFrame:
    """One candidate for each asset: the highest score, the earlier of equal ones; `position` counts assets from 1 in the order
    in which each was first met. Both come from one combining aggregate."""
    place = F.col("ord") if order is None else order
    rest = F.struct(*(c for c in candidates.columns if c not in (by, "key")))
    placed = candidates.withColumn("_rest", rest).withColumn("_place", place)
    best = placed.groupBy(by, "key").agg(F.max_by("_rest", F.struct("initial_score", (-F.col("_place")).alias("p"))).alias("b"), F.min("_place").alias("first_seen"))
    return best.select(by, "key", "first_seen", "b.*")


def inventory(candidates: DataFrame, by: str = "id", limit: int = MAX_INVENTORY) -> DataFrame:
    """The first candidates of each institution in order of discovery, with inventory_index."""
    number = F.row_number().over(Window.partitionBy(by).orderBy("first_seen", "key"))
    return candidates.withColumn("inventory_index", number).where(F.col("inventory_index") <= limit)


def stage_timings(runs: DataFrame) -> DataFrame:
    """stage, runs, total_ms: the times (stage, ms) of all institutions, summed for each stage of the work."""
    return runs.groupBy("stage").agg(F.count("*").alias("runs"), F.sum("ms").alias("total_ms"))


def _telling(html: str, url: str, tokens: tuple[str, ...]) -> Column:
    """An array of url, score, ord: the links of a page that a token marks."""

    def entry(link: Column, ord: Column) -> Column:
        about = link["about"]
        matches = sum((F.contains(about, F.lit(t)).cast("int") for t in tokens), F.lit(0))
        return F.struct(link["url"].alias("url"), (matches * 10 + S.token_score(about)).alias("score"), ord.alias("ord"), matches.alias("n"))

    return F.filter(F.transform(_links(html, url), entry), lambda x: x["n"] > 0)


def _best_links(scores: DataFrame) -> DataFrame:
    """Of equal addresses the best placed one: highest score, then first on the page."""
    return scores.groupBy("id", "page_url", "url").agg(F.max("score").alias("score"), F.max_by(-F.col("ord"), F.struct("score", (-F.col("ord")).alias("o"))).alias("o")).select(
        "id", "page_url", "url", "score", (-F.col("o")).alias("ord")
    )


def relevant_links(pages: DataFrame, tokens: tuple[str, ...] = S.PAGE_TOKENS) -> DataFrame:
    """id, page_url, url, score of links within the site (root_url) that a token marks; best first, each once, by `ord`."""
    found = pages.select("id", "page_url", "root_url", F.explode(_telling("html", "page_url", tokens)).alias("_l"))
    return _best_links(found.where(U.same_site(F.col("_l.url"), F.col("root_url"))).select("id", "page_url", "_l.url", "_l.score", "_l.ord"))


def crawl(institutions: DataFrame, pages: DataFrame, max_pages: int = MAX_PAGES, tokens: tuple[str, ...] = S.PAGE_TOKENS) -> DataFrame:
    """The pages (url, html) that are visited for each institution (id, name, website): its site's first page, then the links that matter,
    at most max_pages. visit is the round.

    A round sends addresses to the pages: the wanted ones, each once, broadcast where they are few. Pages that are met are written down,
    parsed once however many institutions want them, and only their links that matter go back to the institutions. HTML meets the visits
    in one join at the end, of the met pages alone. Of pages with equal addresses one counts: that with the smallest HTML in binary order."""
    spark = institutions.sparkSession
    state = institutions.select("id", "name", U.resolved_url("website", F.lit(None).cast("string")).alias("root_url")).where("root_url is not null")
    narrow = {"adaptive__advisoryPartitionSizeInBytes": str(CRAWL_BYTES), "files__maxPartitionBytes": str(8 * CRAWL_BYTES)}
    with settings(spark, **narrow):
        state, seen = measured(state.withColumn("queue", F.array("root_url")).hint("rebalance", "id"), F.count("*").alias("n"))
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-seen["n"] // CRAWL_ROWS))
        with settings(spark, shuffle__partitions=str(parts)):
            return _crawled(state, pages, min(max_pages, MAX_PAGES), max_pages, parts, tokens)


def _crawled(state: DataFrame, pages: DataFrame, rounds: int, max_pages: int, parts: int, tokens: tuple[str, ...]) -> DataFrame:
    """crawl() from its first state (id, name, root_url, queue), as a table."""
    asked, visits, met = None, [], []
    for visit in range(rounds):
        at = state.select("id", "name", "root_url", F.get("queue", F.lit(visit)).alias("page_url"), F.lit(visit).alias("visit")).where("page_url is not null")
        wanted = at.select("page_url").distinct()
        if asked is not None:  # pages of earlier rounds are at hand
            wanted = wanted.join(asked, "page_url", "left_anti")
        wanted, seen = measured(wanted, F.count("*").alias("n"))
        asked = wanted if asked is None else asked.unionByName(wanted)
        keys = F.broadcast(wanted) if seen["n"] <= FEW_ADDRESSES else wanted
        # a number of parts is given, since parsing takes long for the bytes that it reads
        found = pages.select(F.col("url").alias("page_url"), "html").join(keys, "page_url").repartition(parts, "page_url")
        found = found.groupBy("page_url").agg(F.min("html").alias("html"))
        met.append(written(found.withColumn("links", _telling("html", "page_url", tokens))))
        visits.append(at)
        if visit + 1 < rounds:
            links_of = reduce(DataFrame.unionByName, met).select("page_url", F.explode("links").alias("l"))
            new = at.select("id", "root_url", "page_url").join(links_of, "page_url").where(U.same_site(F.col("l.url"), F.col("root_url")))
            new = _best_links(new.select("id", "page_url", "l.url", "l.score", "l.ord"))
            # the queue can hold max_pages of them already
            new = new.withColumn("_at", F.row_number().over(Window.partitionBy("id").orderBy(F.desc("score"), "ord", "url"))).where(F.col("_at") <= 2 * max_pages)
            best = F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "ord", "url")))
            both = state.join(new.groupBy("id").agg(best.alias("l")), "id", "left")
            fresh = F.filter(F.transform(F.coalesce("l", F.array().cast("array<struct<s: int, ord: int, url: string>>")), lambda x: x["url"]), lambda u: ~F.array_contains("queue", u))
            state = written(both.withColumn("queue", F.slice(F.concat("queue", fresh), 1, max_pages)).drop("l"))
    return written(reduce(DataFrame.unionByName, visits).join(reduce(DataFrame.unionByName, met).drop("links"), "page_url"))
