"""More catalog queries: source files and their contexts, checked returns of research, crawls, candidates and selections.

They register beside those of catalog_queries, with their DuckDB counterparts, and run over whole tables as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrangle.functions import scoring as S
from quadrangle.functions import urls as U
from quadrangle.operators import candidates, enrich, ingest, review, selection, upsert
from quadrangle.plans import catalog_queries as q
from quadrangle.plans.catalog_queries import query
from quadrangle.sources import files, reports
from quadrangle.sources.scratch import shared_folder, written


def _text(key: Column) -> Column:
    return key.cast("string")


def _folder(spark: SparkSession, name: str) -> str:
    from uuid import uuid4

    return f"{shared_folder(spark)}/quadrangle/{spark.sparkContext.applicationId}/{name}-{uuid4().hex}"


# ---------------------------------------------------------------- source files


def parts_as_public_schools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of a public school file, with missing, invalid and repeated ids."""
    key = F.col("p_partkey")
    return q._table(spark, sf_dir, "part").select(
        F.when(key % 13 == 0, " -1").when(key % 19 == 0, _text(F.floor(key / 2))).otherwise(F.concat(F.lit(" "), _text(key))).alias("NCESSCH"),
        F.when(key % 17 == 0, " ").otherwise(F.col("p_name")).alias("SCH_NAME"),
        q._pick(("Open", "Closed", "Added", "New "), F.col("p_size")).alias("SY_STATUS_TEXT"),
        q._pick(("or", "PR", "NY "), key).alias("LSTATE"),
        F.when(F.col("p_size") % 3 == 0, "Yes").otherwise("No").alias("G_9_OFFERED"),
        F.lit("No").alias("G_10_OFFERED"),
        F.lit(None).cast("string").alias("G_11_OFFERED"),
        F.when(key % 5 == 0, " Yes").otherwise("-2").alias("G_12_OFFERED"),
        F.col("p_type").alias("LCITY"),
        q._pick(q._SITES, key).alias("WEBSITE"),
        key.alias("row_no"),
    )


_PUBLIC_SQL = """x AS (
  SELECT p_partkey AS row_no, CASE WHEN p_partkey % 13 = 0 THEN NULL WHEN p_partkey % 19 = 0 THEN (p_partkey // 2)::VARCHAR ELSE p_partkey::VARCHAR END AS source_id,
    CASE WHEN p_partkey % 17 = 0 THEN '' ELSE p_name END AS name, p_type AS city, p_size % 4 = 1 AS closed, ['OR', 'PR', 'NY'][(p_partkey % 3 + 1)::INT] AS state,
    p_size % 3 = 0 OR p_partkey % 5 = 0 AS grade, CASE WHEN p_partkey % 4 = 1 THEN 'https://www.x.edu' END AS website FROM part
), y AS (SELECT *, source_id IS NOT NULL AND row_number() OVER (PARTITION BY source_id ORDER BY row_no) > 1 AS dup FROM x), z AS (
  SELECT *, list_filter([CASE WHEN source_id IS NULL THEN 'missing_source_id' WHEN source_id = '0' THEN 'invalid_source_id' END, CASE WHEN name = '' THEN 'missing_name' END,
    CASE WHEN closed THEN 'inactive_or_noncurrent_status' END, CASE WHEN state = 'PR' THEN 'outside_50_states' END, CASE WHEN NOT grade THEN 'no_grade_9_to_12_offered' END,
    CASE WHEN dup THEN 'duplicate_source_id' END], lambda r: r IS NOT NULL) AS reasons FROM y)"""


@query(f"WITH {_PUBLIC_SQL} SELECT row_no, source_id, array_to_string(reasons, ',') AS reasons FROM z WHERE len(reasons) > 0")
def q_public_reject_reasons(spark, sf_dir):
    staged = ingest.stage(parts_as_public_schools(spark, sf_dir), ingest.CCD)
    return ingest.rejected(staged).select("row_no", "source_id", F.array_join("reasons", ",").alias("reasons"))


def _public_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.accepted(ingest.stage(parts_as_public_schools(spark, sf_dir), ingest.CCD), ingest.CCD, q._run_ts())


@query(f"""WITH {_PUBLIC_SQL} SELECT sha256('CCD' || chr(0) || source_id) AS id, source_id, name, 'high_school' AS category, city, state, website, 2025 AS source_year
FROM z WHERE len(reasons) = 0""")
def q_public_records(spark, sf_dir):
    return _public_records(spark, sf_dir).select("id", "source_id", "name", "category", "city", "state", "website", "source_year")


@query(f"""WITH {_PUBLIC_SQL} SELECT 'CCD' AS source, 2025 AS source_year, 'schools.csv' AS file_name, count(*) AS row_count, 'completed' AS status
FROM z WHERE len(reasons) = 0 HAVING count(*) > 0""")
def q_import_log(spark, sf_dir):
    log = upsert.import_log(_public_records(spark, sf_dir), ingest.source_url(ingest.CCD), "schools.csv", q._run_ts())
    return log.select("source", "source_year", "file_name", "row_count", "status")


@query("""SELECT 'A' || c_custkey AS source_id, c_name || ', "' || c_mktsegment || '"' || chr(10) || 'x' AS name, 'Town ' || (c_custkey % 10) AS city
FROM customer WHERE c_custkey % 3 <> 0""")
def q_csv_source(spark, sf_dir):
    """A file of private schools, written as CSV by all executors and read back as a source: quotes, commas and line breaks in fields."""
    key = F.col("c_custkey")
    rows = q._table(spark, sf_dir, "customer").select(
        F.concat(F.lit("A"), _text(key)).alias("PPIN"),
        F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"\nx')).alias("PINST"),
        F.lit("-1").alias("PCITY"),
        F.when(key % 3 == 0, "99").otherwise("41").alias("PSTANSI"),
        F.concat(F.lit("Town "), _text(key % 10)).alias("PL_CIT"),
        F.lit("1").alias("P265"), F.lit("-1").alias("P275"), F.lit("-1").alias("P285"), F.lit("-1").alias("P295"),
    )
    folder = _folder(spark, "schools")
    reports.write_csv_table(rows, folder)
    staged = ingest.stage(files.read_source(spark, folder, "PSS"), ingest.PSS)
    return ingest.accepted(staged, ingest.PSS, q._run_ts()).select("source_id", "name", "city")


@query("SELECT o_orderkey, o_orderstatus AS status, o_orderpriority || chr(10) || '\"' AS note FROM orders")
def q_json_stage(spark, sf_dir):
    """A stage table written as JSON lines and read back."""
    rows = q._table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"), F.concat("o_orderpriority", F.lit('\n"')).alias("note"))
    folder = _folder(spark, "stage")
    reports.write_json(rows, folder)
    return files.read_json_lines(spark, folder, rows.schema)


@query(f"""WITH {q.INSTITUTIONS_SQL} SELECT id, name, category FROM inst WHERE id IN (SELECT l_partkey::VARCHAR FROM lineitem WHERE l_linenumber = 7)""")
def q_lookup_keys(spark, sf_dir):
    keys = q._table(spark, sf_dir, "lineitem").where("l_linenumber = 7").select(_text(F.col("l_partkey")).alias("id"))
    return files.lookup(q.parts_as_institutions(spark, sf_dir), keys, ["id"]).select("id", "name", "category")


# ---------------------------------------------------------------- review with all three sources


@query(f"""WITH {q.INSTITUTIONS_SQL}, raw AS (
  SELECT p_partkey::VARCHAR AS source_id, ['IPEDS', 'CCD', 'PSS'][(p_partkey % 3 + 1)::INT] AS source, p_name AS rawName, p_partkey % 3 AS s, p_size, p_brand FROM part WHERE p_size % 10 <> 0
), c AS (
  SELECT source, source_id, rawName, CASE s::INT WHEN 0 THEN 'Inactive/unknown' WHEN 1 THEN 'Open' ELSE 'PSS respondent record' END AS status,
    CASE WHEN s < 2 THEN upper(p_brand) END AS st, CASE WHEN s = 1 THEN '09, ' || p_size WHEN s = 2 THEN '' END AS grades, CASE WHEN s = 1 THEN 'A, B' END AS address,
    CASE WHEN s = 2 AND p_size % 2 = 0 THEN 'Physical city unavailable; mailing city shown as fallback.' ELSE '' END AS notes,
    CASE WHEN s = 2 AND p_size % 2 = 0 THEN 'Mail' WHEN s = 2 THEN 'Town' ELSE 'City' END AS city FROM raw
)
SELECT i.id AS "dbId", i.source, c.rawName AS "rawName", c.status, c.st AS "sourceState", c.city AS "sourceCity", c.address AS "sourceAddress", nullif(c.grades, '') AS "gradeRange",
  CASE WHEN c.source IS NULL THEN 'missing_raw_row' ELSE 'matched_raw_row' END AS "sourceMatch", CASE WHEN c.source IS NULL THEN 'Raw source row was not found.' ELSE c.notes END AS "reviewNotes"
FROM inst i LEFT JOIN c USING (source, source_id)""")
def q_review_sources(spark, sf_dir):
    part = q._table(spark, sf_dir, "part").where("p_size % 10 <> 0").withColumn("id", _text(F.col("p_partkey"))).withColumn("row_no", F.col("p_partkey"))
    own = [part.where(F.col("p_partkey") % 3 == i) for i in range(3)]
    colleges = own[0].select(F.col("id").alias("UNITID"), F.col("p_name").alias("INSTNM"), F.lit("").alias("WEBADDR"), F.lit("City").alias("CITY"), F.col("p_brand").alias("STABBR"), F.lit("3").alias("CYACTIVE"), "row_no")
    public = own[1].select(
        F.col("id").alias("NCESSCH"), F.col("p_name").alias("SCH_NAME"), F.lit("").alias("WEBSITE"), F.lit("City").alias("LCITY"), F.col("p_brand").alias("LSTATE"), F.lit("Open").alias("SY_STATUS_TEXT"),
        F.lit("A").alias("LSTREET1"), F.lit("-1").alias("LSTREET2"), F.lit(" B").alias("LSTREET3"), F.lit("09").alias("GSLO"), _text(F.col("p_size")).alias("GSHI"), "row_no",
    )
    private = own[2].select(F.col("id").alias("PPIN"), F.col("p_name").alias("PINST"), F.when(F.col("p_size") % 2 != 0, "Town").otherwise("-1").alias("PL_CIT"), F.lit("Mail").alias("PCITY"), "row_no")
    members = q.parts_as_institutions(spark, sf_dir).withColumns({"groupId": F.col("category"), "candidate_type": F.lit("same_name_state"), "size": F.lit(1)})
    table = review.review_table(members, review.contexts({"IPEDS": colleges, "CCD": public, "PSS": private}))
    grades = F.nullif(F.col("gradeRange"), F.lit("")).alias("gradeRange")
    return table.select("dbId", "source", "rawName", "status", "sourceState", "sourceCity", "sourceAddress", grades, "sourceMatch", "reviewNotes")


# ---------------------------------------------------------------- research that comes back damaged


@query(f"""WITH {q._RESEARCH_SQL}, d AS (SELECT *, (c_custkey % 50)::INT AS k FROM r), e AS (SELECT * FROM d UNION ALL SELECT * FROM d WHERE k = 3)
SELECT c_custkey + 2 AS row_number, CASE k WHEN 1 THEN 'zz' || c_custkey WHEN 4 THEN '' ELSE id END AS id,
  CASE WHEN k IN (1, 4) THEN 'unknown_local_id' WHEN k = 2 THEN 'modified_reference_fields' WHEN k = 3 THEN 'duplicate_or_blank_id' WHEN problem IS NOT NULL THEN 'invalid_website'
    WHEN found IS NULL THEN 'unresolved' ELSE 'pending' END AS outcome,
  CASE WHEN k IN (1, 4) THEN 'No matching local D1 institution was found.' WHEN k = 2 THEN 'Only website may differ from the exported CSV.'
    WHEN k = 3 THEN 'Each CSV row must have one unique nonblank id.' ELSE problem END AS detail FROM e""")
def q_structural_outcomes(spark, sf_dir):
    """With ids that are unknown, blank or repeated, or names that were changed, no row gets beyond its first outcome."""
    catalog = q.customers_as_catalog(spark, sf_dir)
    k = (F.col("row_number") - 2) % 50
    rows = q._research(catalog)
    damaged = rows.withColumns(
        {
            "id": F.when(k == 1, F.concat(F.lit("zz"), _text(F.col("row_number") - 2))).when(k == 4, " ").otherwise(F.col("id")),
            "name": F.when(k == 2, F.concat("name", F.lit(" Other"))).otherwise(F.col("name")),
        }
    )
    outcomes, _ = enrich.reconcile(damaged.unionByName(damaged.where(k == 3)), catalog)
    return outcomes.select("row_number", "id", "outcome", "detail")


# ---------------------------------------------------------------- crawls and candidates on pages


@query("""WITH c AS (SELECT c_custkey AS k, 'https://c' || c_custkey || '.org/' AS root FROM customer WHERE c_custkey % 7 <> 0)
SELECT k AS id, root AS page_url, 0 AS visit FROM c UNION ALL SELECT k, root || 'brand-media', 1 FROM c WHERE k % 2 = 0
UNION ALL SELECT k, root || 'about', 2 FROM c UNION ALL SELECT k, root || 'identity-brand', 3 FROM c WHERE k % 3 = 0""")
def q_crawl(spark, sf_dir):
    """Customers' sites: the first page links to two pages that matter, one of them often missing, and one of these to more."""
    key = F.col("c_custkey")
    site = F.concat(F.lit("https://c"), _text(key), F.lit(".org"))
    customers = q._table(spark, sf_dir, "customer")
    schools = customers.select(key.alias("id"), F.col("c_name").alias("name"), F.when(key % 7 != 0, site).alias("website"))
    first = '<a href="/about">x</a><a href="/brand-media#top">y</a><a href="/z">z</a><a href="https://other.org/about">o</a>'
    more = '<a href="/contact">x</a><p><a href="/identity-brand"><b>y</b></a><a href="/">about</a></p>'
    pages = F.array(
        *(
            F.struct(F.concat(site, F.lit(path)).alias("url"), F.when(there, F.lit(html)).alias("html"))
            for path, html, there in (("/", first, key >= 0), ("/about", more, key >= 0), ("/brand-media", "<p>", key % 2 == 0), ("/identity-brand", "<p>", key % 3 == 0), ("/contact", "<p>", key >= 0))
        )
    )
    web = customers.select(F.explode(pages).alias("p")).select("p.*").where("html is not null")
    return candidates.crawl(schools, web).select("id", "page_url", "visit")


_IMAGE_HTML = (
    '<html><body><header class="site-header"><a href="/"><img src="/media/v1/logo-{0}.png" alt="Example School logo" srcset="/media/v2/logo-{0}.png 2x"></a></header>'
    '<p><img src="/photo-{0}.jpg" alt="a sunny day"></p><img src="/clip-{0}.mp4" alt="logo"><svg class="site-logo"><title>Example School logo</title><path d="M0 0"/></svg></body></html>'
)
_ORIGIN = "lower(regexp_extract(url, '^(https?://[^/?#]+)', 1))"


@query(f"""SELECT page_id AS id, {_ORIGIN} || '/logo-' || page_id || '.png' AS key, 'image-element' AS source, 'strong' AS qualification FROM pages
UNION ALL SELECT page_id, {_ORIGIN} || '/photo-' || page_id || '.jpg', 'image-element', 'fallback' FROM pages
UNION ALL SELECT page_id, {_ORIGIN} || '/favicon.ico', 'favicon-fallback', 'fallback' FROM pages
UNION ALL SELECT page_id, 'inline-svg', 'inline-svg', 'strong' FROM pages""")
def q_image_candidates(spark, sf_dir):
    """Every page's address with the same kinds of images: renditions of one logo, a photograph, a film, an inline drawing."""
    before, *rest = _IMAGE_HTML.split("{0}")
    html = F.concat(F.lit(before), *(x for part in rest for x in (_text(F.col("page_id")), F.lit(part))))
    pages = q._table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), F.lit("Example School").alias("name"), F.col("url").alias("page_url"), html.alias("html"))
    found = candidates.best_per_asset(candidates.scored(candidates.page_mentions(pages)))
    key = F.when(F.col("source") == "inline-svg", "inline-svg").otherwise(F.col("key"))
    return found.select("id", key.alias("key"), "source", "qualification")


# ---------------------------------------------------------------- every kind of mention, with its score

_SCHOOL = "Lincoln Tech Prep"
_KINDS_HTML = (
    '<html><head><link rel="shortcut icon" href="/icons/fav-{0}.ico" type="image/x-icon"><link rel="stylesheet" href="/s.css">'
    '<meta property="og:image" content="https://cdn.example.org/brand/share-{0}.png"><meta name="image" content="/plain-{0}.png">'
    "<style>.m{background:url('/img/logo-mark-{0}.png')} .x{background:url(/img/plain-{0}.png)}</style></head><body>"
    '<header id="site-header"><a class="brand" href="/"><img alt="Lincoln crest" srcset="/a/crest-{0}.png 1x, /a/second-{0}.png 2x"></a></header>'
    '<nav><img data-image="{{&quot;a&quot;:{{&quot;url&quot;:&quot;/j/one-{0}.png&quot;}},&quot;url&quot;:&quot;/j/two-{0}.png&quot;}}" alt="photo"></nav>'
    '<main><div style="background-image:url(/bg/school-logo-{0}.jpg)"></div><picture><source srcset="/p/wordmark-{0}.webp"></picture>'
    '<img src="/hero-banner-{0}.jpg"><video><source src="/v-{0}.webm"></video></main>'
    '<footer><div class="site-logo"><svg class="footer logo-image"><title>Lincoln mark</title></svg></div></footer></body></html>'
)
_JSON_ABOUT = 'data-image={{"a":{{"url":"/j/one-{0}.png"}},"url":"/j/two-{0}.png"}}'
_IN_HEADER = "img > a(class=brand) > header(id=site-header)"
# what such a page says: path, source, base score, the element and its ancestry
_KINDS = (
    ("/icons/fav-{0}.ico", "document-icon", 0, "tag=link; type=image/x-icon", "head"),
    ("https://cdn.example.org/brand/share-{0}.png", "metadata-image", 0, "tag=meta", "head"),
    ("/plain-{0}.png", "metadata-image", 0, "tag=meta", "head"),
    ("/img/logo-mark-{0}.png", "css-background", 0, "/img/logo-mark-{0}.png", "stylesheet"),
    ("/img/plain-{0}.png", "css-background", 0, "/img/plain-{0}.png", "stylesheet"),
    ("/a/crest-{0}.png", "image-element", 0, "tag=img; alt=Lincoln crest", _IN_HEADER),
    ("/a/second-{0}.png", "image-element", 0, "tag=img; alt=Lincoln crest", _IN_HEADER),
    ("/j/one-{0}.png", "image-element", 0, f"tag=img; {_JSON_ABOUT}; alt=photo", f"img({_JSON_ABOUT}) > nav"),
    ("/j/two-{0}.png", "image-element", 0, f"tag=img; {_JSON_ABOUT}; alt=photo", f"img({_JSON_ABOUT}) > nav"),
    ("/bg/school-logo-{0}.jpg", "css-background", 0, "tag=div", "main"),
    ("/bg/school-logo-{0}.jpg", "css-background", 0, "/bg/school-logo-{0}.jpg", "stylesheet"),
    ("/p/wordmark-{0}.webp", "picture-source", 0, "tag=source", "main"),
    ("/hero-banner-{0}.jpg", "image-element", 0, "tag=img", "main"),
    ("/favicon.ico", "favicon-fallback", 10, "favicon", ""),
)


def _literal(text: str) -> str:
    """A text of _KINDS as SQL, with the page's id in it."""
    return "concat(" + ", page_id, ".join("'" + part.replace("{{", "{").replace("}}", "}").replace("'", "''") + "'" for part in text.split("{0}")) + ")"


def _points_sql(text: str) -> str:
    return "(" + " + ".join(f"CASE WHEN contains(lower({text}), '{t}') THEN {n} ELSE 0 END" for t, n in S.TOKEN_POINTS.items()) + ")"


def _match_sql(text: str) -> str:
    words = " + ".join(f"contains({text}, '{w}')::INT" for w in ("lincoln", "tech", "prep"))
    return f"(least(30, 12 * ({words})) + CASE WHEN contains({text}, 'ltp') THEN 35 ELSE 0 END)"


def _structure_sql(text: str) -> str:
    header, container = (p.replace("'", "''") for p in (S.HEADER, S.CONTAINER))
    return f"(CASE WHEN regexp_matches({text}, '{header}') THEN 28 ELSE 0 END + CASE WHEN regexp_matches({text}, '{container}') THEN 26 ELSE 0 END)"


_KIND_ROWS = " UNION ALL ".join(
    f"SELECT page_id, {'origin || ' if k[0].startswith('/') else ''}{_literal(k[0])} AS url, '{k[1]}' AS source, {k[2]} AS base, {_literal(k[3])} AS about, {_literal(k[4])} AS ancestry FROM o"
    for k in _KINDS
)
_SVG_ABOUT, _SVG_ANCESTRY = "tag=svg; class=footer logo-image", "svg(class=footer logo-image) > div(class=site-logo) > footer"


@query(f"""WITH o AS (SELECT page_id, {_ORIGIN} AS origin FROM pages), k AS ({_KIND_ROWS}), a AS (
  SELECT *, about || ' ' || ancestry AS around, lower(regexp_replace(url, '^https?://[^/]*', '') || '  ' || about || ' ' || ancestry) AS text FROM k
), d AS (SELECT *, regexp_matches(text, '{S.DIRECT}') AS direct, source IN ('image-element', 'picture-source', 'css-background') AS generic FROM a), s AS (
  SELECT page_id AS id, url AS key, source, CASE WHEN direct THEN 'strong' ELSE 'fallback' END AS qualification,
    (base + {_points_sql("url")} + CASE WHEN generic THEN trunc({_points_sql("around")} * 0.35)::INT ELSE {_points_sql("around")} END + {_match_sql("text")} + {_structure_sql("ancestry")})::INT AS initial_score
  FROM d WHERE CASE WHEN source = 'css-background' THEN direct ELSE generic OR source IN ('document-icon', 'favicon-fallback') OR direct END
)
SELECT id, key, source, arg_max(qualification, initial_score) AS qualification, max(initial_score) AS initial_score FROM s GROUP BY id, key, source UNION ALL
SELECT page_id, 'inline-svg', 'inline-svg', 'strong', (65 + {_points_sql("t")} + {_match_sql("lower(t)")} + {_structure_sql("c")})::INT
FROM (SELECT page_id, 'Lincoln mark {_SVG_ABOUT} {_SVG_ANCESTRY}' AS t, '{_SVG_ABOUT} {_SVG_ANCESTRY} {_SVG_ANCESTRY}' AS c FROM pages)""")
def q_candidate_scores(spark, sf_dir):
    """Every page's address with icons, page images, style backgrounds, srcset, a JSON attribute, pictures, a film and a drawing."""
    before, *rest = _KINDS_HTML.replace("{{", "{").replace("}}", "}").split("{0}")
    html = F.concat(F.lit(before), *(x for part in rest for x in (_text(F.col("page_id")), F.lit(part))))
    pages = q._table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), F.lit(_SCHOOL).alias("name"), F.col("url").alias("page_url"), html.alias("html"))
    found = candidates.best_per_asset(candidates.scored(candidates.page_mentions(pages)))
    key = F.when(F.col("source") == "inline-svg", "inline-svg").otherwise(F.col("key"))
    return found.select("id", key.alias("key"), "source", "qualification", "initial_score")


_HOSTS = (  # as written, and as the standard has it; null is no host
    ("fa\u00df.C{0}.DE", "xn--fa-hia.c{0}.de"), ("FA\u1e9e.c{0}.de", "xn--fa-hia.c{0}.de"), ("Bu\u0308CHER.c{0}.de", "xn--bcher-kva.c{0}.de"),
    ("\u65e5\u672c\u8a9e\u3002c{0}\uff0ejp", "xn--wgv71a119e.c{0}.jp"), ("\uff45\uff58{0}.com", "ex{0}.com"), ("ex\u00adample{0}.com", "example{0}.com"), ("\u2615.c{0}.org", "xn--53h.c{0}.org"),
    ("\u03b2\u03cc\u03bb\u03bf\u03c2.c{0}.com", "xn--nxasmm1c.c{0}.com"), ("xn--FA-HIA.c{0}.de", "xn--fa-hia.c{0}.de"), ("a\u200db.c{0}.com", None), ("xn--a.c{0}.com", None), ("\u05d0a.c{0}.com", None),
    ("\u2488.c{0}.com", None), ("\u0646\u0627\u0645\u0647\u200c\u0627\u06cc.com", "xn--mgba3gch31f060k.com"), ("plain-{0}.ORG", "plain-{0}.org"),
)


def _host_case(texts: list[str | None]) -> str:
    parts = ("NULL" if t is None else "concat(" + ", c_custkey, ".join(f"'{x}'" for x in f"https://{t}/a".split("{0}")) + ")" for t in texts)
    return f"CASE c_custkey % {len(texts)} " + " ".join(f"WHEN {i} THEN {p}" for i, p in enumerate(parts)) + " END"


@query(f"SELECT c_custkey AS id, {_host_case([b for _, b in _HOSTS])} AS address FROM customer")
def q_foreign_hosts(spark, sf_dir):
    """Addresses whose hosts have letters of other scripts, or letters that are written in another way."""
    hosts = F.array(*(F.lit(a) for a, _ in _HOSTS))
    key = F.col("c_custkey")
    host = F.replace(F.get(hosts, (key % F.size(hosts)).cast("int")), F.lit("{0}"), _text(key))
    address = U.resolved_url(F.concat(F.lit("https://"), host, F.lit("/a#b")), F.lit(None).cast("string"))
    return q._table(spark, sf_dir, "customer").select(key.alias("id"), address.alias("address"))


@query("SELECT event_type AS stage, count(*) AS runs, sum(trunc(value * 10)::BIGINT)::BIGINT AS total_ms FROM events GROUP BY 1")
def q_stage_timings(spark, sf_dir):
    log = q._table(spark, sf_dir, "events").select(F.col("event_type").alias("stage"), (F.col("value") * 10).cast("long").alias("ms"))
    return candidates.stage_timings(log)


@query(r"""SELECT page_id, page_id % 4 IN (0, 1) AS video FROM pages""")
def q_video_assets(spark, sf_dir):
    kind = F.col("page_id") % 4
    origin = F.lit("https://x.org/a")
    url = F.when(kind == 0, F.concat(origin, F.lit(".MP4?x=1#y"))).otherwise(F.concat(origin, F.lit(".mp4.png")))
    about = F.when(kind == 1, "type=Video/WebM").when(kind == 2, "videos/mp4x").otherwise("")
    return q._table(spark, sf_dir, "pages").select("page_id", U.is_video(url, about).alias("video"))


# ---------------------------------------------------------------- ranking, images and assessments


_INVENTORY_SQL = f"""{q._CANDIDATES_SQL}, i AS (SELECT * FROM (SELECT *, (row_number() OVER (PARTITION BY id ORDER BY first_seen, key))::INT AS inventory_index FROM best)
  WHERE inventory_index <= 144)"""


def _inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = q.events_as_candidates(spark, sf_dir).withColumns({"url": F.col("key"), "page_url": F.lit("")})
    return candidates.inventory(candidates.best_per_asset(rows))


@query(f"""WITH {_INVENTORY_SQL}, n AS (
  SELECT *, source = 'favicon-fallback' AS icon, row_number() OVER (PARTITION BY id, source = 'favicon-fallback' ORDER BY inventory_index) AS place FROM i
), b AS (SELECT *, (place - 1) // 36 AS b FROM n), r AS (SELECT *, row_number() OVER (PARTITION BY id, icon, b ORDER BY initial_score DESC, key) AS br FROM b),
s AS (SELECT *, NOT icon AND br <= 12 AS short FROM r), f AS (
  SELECT *, count(*) FILTER (short) OVER (PARTITION BY id) AS n_short, row_number() OVER (PARTITION BY id, short ORDER BY b, br) AS in_turn,
    row_number() OVER (PARTITION BY id, short ORDER BY initial_score DESC, key) AS by_score, row_number() OVER (PARTITION BY id, icon ORDER BY initial_score DESC, key) AS icon_rank FROM s
), o AS (SELECT *, CASE WHEN short THEN CASE WHEN n_short <= 12 THEN in_turn WHEN by_score <= 12 THEN by_score END WHEN icon AND n_short = 0 AND icon_rank <= 5 THEN icon_rank END AS fr FROM f)
SELECT id, key, CASE WHEN short THEN b + 1 ELSE (inventory_index - 1) // 36 + 1 END::INT AS batch_number, CASE WHEN short THEN br END::INT AS batch_rank, fr::INT AS final_rank,
  CASE WHEN fr IS NOT NULL AND icon THEN 'selected_as_favicon_fallback' WHEN fr IS NOT NULL THEN 'selected_for_visual' WHEN short THEN 'shortlisted_by_text'
    WHEN icon THEN 'deferred_favicon' ELSE 'not_selected_by_text' END AS status FROM o""")
def q_text_tournament(spark, sf_dir):
    ranked = selection.ranked_by_text(_inventory(spark, sf_dir), selection.ScoreRanker())
    return ranked.select("id", "key", "batch_number", "batch_rank", "final_rank", "status")


@query(f"""WITH {_INVENTORY_SQL}, t AS (SELECT *, row_number() OVER (PARTITION BY id, source = 'favicon-fallback' ORDER BY initial_score DESC, key) AS n,
    count(*) FILTER (source <> 'favicon-fallback') OVER (PARTITION BY id) AS others FROM i),
k AS (SELECT * FROM t WHERE CASE WHEN source = 'favicon-fallback' THEN others = 0 AND n <= 5 ELSE n <= 12 END),
g AS (SELECT DISTINCT event_type || '/' || (event_id % 20) AS key, (event_id % 20)::INT AS e FROM events),
w AS (SELECT k.*, (e % 4) AS preview, (e % 6 + 1) * 16 AS w, (e % 9 + 1) * 8 AS h FROM k JOIN g USING (key)),
s AS (SELECT *, greatest(0, least(100, 30 + initial_score + CASE WHEN w / h BETWEEN 0.65 AND 1.7 THEN 4 WHEN w / h > 4 OR w / h < 0.25 THEN -12 ELSE 0 END
  + CASE WHEN w >= 32 AND h >= 32 THEN 2 ELSE 0 END))::INT AS score FROM w),
d AS (SELECT *, row_number() OVER (PARTITION BY id, preview ORDER BY score DESC, key) AS copy FROM s),
c AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, key) AS candidate_rank FROM d WHERE copy = 1)
SELECT id, key, score, candidate_rank::INT AS candidate_rank, candidate_rank = 1 AND score >= 75 AS auto_selected FROM c WHERE candidate_rank <= 5""")
def q_image_selection(spark, sf_dir):
    """Ranked candidates whose images are known: of equal images one stays, and the best is selected by its score."""
    n = F.col("n")
    names = q.events_as_candidates(spark, sf_dir).select("key").distinct().withColumn("n", F.split("key", "/")[1].cast("int"))
    images = names.select("key", ((n % 6 + 1) * 16).alias("width"), ((n % 9 + 1) * 8).alias("height"), _text(n % 4).cast("binary").alias("preview"))
    shown = selection.with_images(selection.top_by_score(_inventory(spark, sf_dir)), images)
    return selection.select_by_score(shown).select("id", "key", "score", "candidate_rank", "auto_selected")


_ASSESSED_SQL = """o AS (SELECT o_orderkey // 5 AS id, (o_orderkey % 5 + 1)::INT AS candidate_rank, (o_custkey % 101)::INT AS score, o_orderkey AS k,
  ['logo', 'photo', 'icon', 'seal', 'unknown'][(o_custkey % 5 + 1)::INT] AS kind, o_orderkey % 4 <> 0 AS eligible FROM orders),
s AS (SELECT DISTINCT id, CASE WHEN id % 7 > 0 THEN (id % 7)::INT END AS chosen, (id % 10) / 10.0::DOUBLE AS confidence FROM o),
a AS (SELECT id, candidate_rank, kind, eligible FROM o WHERE k % 11 <> 0)"""


def _assessed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Candidates, a model's selections and its assessments, some of them missing or of no candidate."""
    key = F.col("o_orderkey")
    orders = q._table(spark, sf_dir, "orders").select(F.floor(key / 5).cast("long").alias("id"), (key % 5 + 1).cast("int").alias("candidate_rank"), key.alias("k"), "o_custkey")
    shown = orders.select("id", "candidate_rank", (F.col("o_custkey") % 101).cast("int").alias("score"), F.lit("image-element").alias("source"), F.lit("selected_for_visual").alias("status"))
    chosen = F.when(F.col("id") % 7 > 0, (F.col("id") % 7).cast("int"))
    selections = orders.select("id").distinct().select("id", chosen.alias("chosen"), ((F.col("id") % 10) / 10).alias("confidence"))
    kinds = q._pick(("logo", "photo", "icon", "seal", "unknown"), F.col("o_custkey"))
    views = orders.where(F.col("k") % 11 != 0).select("id", "candidate_rank", kinds.alias("kind"), (F.col("k") % 4 != 0).alias("eligible"))
    return shown, selections, views


@query(f"""WITH {_ASSESSED_SQL}, j AS (SELECT o.id, o.candidate_rank, o.score, a.kind, coalesce(a.eligible, false) AS eligible, s.chosen, s.confidence,
    coalesce(a.eligible AND a.kind IN ('logo', 'seal'), false) AS own FROM o LEFT JOIN a USING (id, candidate_rank) LEFT JOIN s USING (id)),
w AS (SELECT *, coalesce(bool_or(candidate_rank = chosen AND own) OVER (PARTITION BY id), false) AS fine FROM j),
t AS (SELECT *, CASE WHEN chosen IS NULL THEN 'no_match' WHEN NOT fine THEN 'rejected_kind' WHEN confidence >= 0.8 THEN 'accepted' ELSE 'below_threshold' END AS ai_status FROM w)
SELECT id, candidate_rank, ai_status, CASE WHEN kind = 'photo' THEN least(score, 5) WHEN kind = 'icon' AND NOT eligible THEN least(score, 12)
  WHEN kind = 'unknown' AND NOT eligible THEN least(score, 20) ELSE score END AS score, ai_status = 'accepted' AND candidate_rank = chosen AS auto_selected FROM t""")
def q_assessed_selection(spark, sf_dir):
    out = selection.select_by_assessment(*_assessed(spark, sf_dir))
    return out.select("id", "candidate_rank", "ai_status", "score", "auto_selected")


@query(f"""WITH {_ASSESSED_SQL}, h AS (SELECT id, list(candidate_rank ORDER BY candidate_rank) AS shown FROM o GROUP BY 1),
y AS (SELECT id, list(candidate_rank ORDER BY candidate_rank) AS said FROM a GROUP BY 1)
SELECT * FROM (SELECT s.id, CASE WHEN chosen IS NOT NULL AND NOT list_contains(shown, chosen) THEN 'candidate outside the set' WHEN said IS DISTINCT FROM shown THEN 'not every candidate assessed once' END AS problem
  FROM s LEFT JOIN h USING (id) LEFT JOIN y USING (id)) WHERE problem IS NOT NULL""")
def q_invalid_selections(spark, sf_dir):
    return selection.invalid_selections(*_assessed(spark, sf_dir))
