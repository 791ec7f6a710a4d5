"""The catalog queries registered with the driver, each with its DuckDB counterpart.

The driver's tables stand in for the catalog: parts, customers and line items are projected as institutions and as rows of
source files, and the operators run over them whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrangle.functions import scoring as S
from quadrangle.functions import text as T
from quadrangle.functions import urls as U
from quadrangle.operators import candidates, duplicates, enrich, ingest, numbering, review, sample, search, selection, upsert

RUN_TS = "2026-01-02 03:04:05"
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _run_ts() -> Column:
    return F.lit(RUN_TS).cast("timestamp_ntz")


# ---------------------------------------------------------------- parts as institutions


def parts_as_institutions(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    return _table(spark, sf_dir, "part").select(
        key.cast("string").alias("id"),
        F.element_at(F.array(F.lit("IPEDS"), F.lit("CCD"), F.lit("PSS")), (key % 3 + 1).cast("int")).alias("source"),
        key.cast("string").alias("source_id"),
        F.initcap("p_name").alias("name"),
        T.normalize_name("p_name").alias("normalized_name"),
        F.col("p_type").alias("category"),
        F.when(key % 7 != 0, F.when(key % 2 == 0, "Salem").otherwise("SALEM ")).alias("city"),
        F.when(key % 4 == 0, F.lower("p_brand")).otherwise(F.col("p_brand")).alias("state"),
        F.lit("US").alias("country"),
        F.when(key % 4 == 0, F.concat(F.lit("https://p"), key.cast("string"), F.lit(".example.org/"))).when(key % 5 == 0, "").alias("website"),
        F.when(key % 9 == 0, F.concat(F.lit("education/"), key.cast("string"))).alias("logo_key"),
        F.when(F.col("p_size") % 10 != 0, 2020 + F.col("p_size") % 6).alias("source_year"),
        F.when(key % 5 != 0, 1).otherwise(0).alias("is_active"),
    )


INSTITUTIONS_SQL = r"""inst AS (
  SELECT p_partkey::VARCHAR AS id, ['IPEDS', 'CCD', 'PSS'][(p_partkey % 3 + 1)::INT] AS source, p_partkey::VARCHAR AS source_id,
    array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS name,
    trim(regexp_replace(replace(lower(strip_accents(p_name)), '&', ' and '), '[^\p{L}\p{N}]+', ' ', 'g')) AS normalized_name, p_type AS category,
    CASE WHEN p_partkey % 7 <> 0 THEN CASE WHEN p_partkey % 2 = 0 THEN 'Salem' ELSE 'SALEM ' END END AS city,
    CASE WHEN p_partkey % 4 = 0 THEN lower(p_brand) ELSE p_brand END AS state, 'US' AS country,
    CASE WHEN p_partkey % 4 = 0 THEN 'https://p' || p_partkey || '.example.org/' WHEN p_partkey % 5 = 0 THEN '' END AS website,
    CASE WHEN p_partkey % 9 = 0 THEN 'education/' || p_partkey END AS logo_key,
    CASE WHEN p_size % 10 <> 0 THEN 2020 + p_size % 6 END AS source_year, CASE WHEN p_partkey % 5 <> 0 THEN 1 ELSE 0 END AS is_active
  FROM part)"""

_KEY = "concat_ws(' | ', category, coalesce(state, ''), normalized_name{})"
_LOCATION = f"""SELECT {_KEY.format(", coalesce(city, '')")} AS group_key, count(*) AS size, count(DISTINCT source) AS sources,
  CASE WHEN count(DISTINCT source) > 1 THEN 'cross_source' ELSE 'same_source_location' END AS candidate_type
  FROM inst WHERE trim(city) <> '' GROUP BY 1 HAVING count(*) > 1"""
_NAME_STATE = f"""SELECT {_KEY.format("")} AS group_key, count(*) AS size, count(DISTINCT source) AS sources, 'same_name_state' AS candidate_type
  FROM inst GROUP BY 1 HAVING count(*) > 1"""
_COLLISIONS = """SELECT concat_ws(' | ', l_returnflag, l_orderkey::VARCHAR) AS group_key, count(*) AS size, count(DISTINCT l_returnflag) AS sources,
  'same_source_location' AS candidate_type FROM lineitem GROUP BY 1 HAVING count(*) > 1"""


@query(f"WITH {INSTITUTIONS_SQL} {_NAME_STATE}")
def q_same_name_state(spark, sf_dir):
    return duplicates.same_name_state(parts_as_institutions(spark, sf_dir))


@query(f"WITH {INSTITUTIONS_SQL} {_LOCATION}")
def q_exact_location(spark, sf_dir):
    return duplicates.exact_location(parts_as_institutions(spark, sf_dir))


@query(_COLLISIONS)
def q_source_key_collisions(spark, sf_dir):
    rows = _table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("source"), F.col("l_orderkey").cast("string").alias("source_id"))
    return duplicates.source_key_collisions(rows)


@query(f"""WITH {INSTITUTIONS_SQL}, a AS ({_LOCATION}), b AS ({_NAME_STATE})
SELECT 'exact_location' AS audit, count(*) AS groups, coalesce(sum(size), 0)::BIGINT AS rows FROM a
UNION ALL SELECT 'same_name_state', count(*), coalesce(sum(size), 0)::BIGINT FROM b""")
def q_audit_totals(spark, sf_dir):
    rows = parts_as_institutions(spark, sf_dir)
    return duplicates.totals({"exact_location": duplicates.exact_location(rows), "same_name_state": duplicates.same_name_state(rows)})


_PLAN_SQL = f"""{INSTITUTIONS_SQL}, k AS (
  SELECT *, upper(trim(coalesce(state, ''))) AS st,
    trim(regexp_replace(lower(coalesce(city, '')), '[^a-z0-9]+', ' ', 'g')) AS ci, (name <> '')::INT + (normalized_name <> '')::INT
    + coalesce((trim(city) <> '')::INT, 0) + coalesce((trim(state) <> '')::INT, 0) + 1 + coalesce((trim(website) <> '')::INT, 0)
    + coalesce((trim(logo_key) <> '')::INT, 0) + (source_year IS NOT NULL)::INT AS complete
  FROM inst
), r AS (
  SELECT *, row_number() OVER w AS rn, count(*) OVER (PARTITION BY category, st, normalized_name, ci) AS n FROM k WHERE ci <> '' AND st <> ''
  WINDOW w AS (PARTITION BY category, st, normalized_name, ci ORDER BY complete DESC, coalesce(website <> '', false) DESC, source, source_id, id)
), g AS (SELECT * FROM r WHERE n > 1), p AS (
  SELECT concat_ws(' | ', category, st, normalized_name, ci) AS group_key, category, count(*) AS size,
    arg_min(id, rn) AS canonical_id, arg_min(source, rn) AS canonical_source, arg_min(source_id, rn) AS canonical_source_id,
    arg_min(name, rn) FILTER (name <> '') AS name, normalized_name, arg_min(city, rn) FILTER (trim(city) <> '') AS city,
    arg_min(state, rn) FILTER (trim(state) <> '') AS state, coalesce(arg_min(country, rn), 'US') AS country,
    arg_min(website, rn) FILTER (trim(website) <> '') AS website, arg_min(logo_key, rn) FILTER (trim(logo_key) <> '') AS logo_key,
    max(source_year) AS source_year, max((is_active = 1)::INT) AS is_active
  FROM g GROUP BY category, st, normalized_name, ci
)"""


@query(f"WITH {_PLAN_SQL} SELECT * FROM p")
def q_consolidation_plan(spark, sf_dir):
    return duplicates.plan(parts_as_institutions(spark, sf_dir)).drop("conflicts")


@query(f"""WITH {_PLAN_SQL}, v AS (
  SELECT concat_ws(' | ', category, st, normalized_name, ci) AS group_key, unnest([
    {{'f': 'name', 'v': name}}, {{'f': 'city', 'v': city}}, {{'f': 'state', 'v': state}}, {{'f': 'country', 'v': country}},
    {{'f': 'website', 'v': website}}, {{'f': 'logo_key', 'v': logo_key}}, {{'f': 'source_year', 'v': source_year::VARCHAR}}]) AS x FROM g
)
SELECT group_key, x.f AS field, string_agg(DISTINCT x.v, ' | ' ORDER BY x.v) AS "values" FROM v WHERE trim(x.v) <> ''
GROUP BY 1, 2 HAVING count(DISTINCT x.v) > 1""")
def q_conflicts(spark, sf_dir):
    return duplicates.conflict_list(duplicates.plan(parts_as_institutions(spark, sf_dir)))


@query(f"""WITH {_PLAN_SQL}, c AS (
  SELECT group_key FROM (SELECT concat_ws(' | ', category, st, normalized_name, ci) AS group_key, count(DISTINCT name) a, count(DISTINCT nullif(trim(city), '')) b0,
    count(DISTINCT city) b, count(DISTINCT state) c, count(DISTINCT nullif(website, '')) d, count(DISTINCT logo_key) e, count(DISTINCT source_year) f FROM g GROUP BY 1)
  WHERE a > 1 OR b > 1 OR c > 1 OR d > 1 OR e > 1 OR f > 1
)
SELECT (SELECT count(*) FROM p) AS groups, (SELECT coalesce(sum(size), 0)::BIGINT FROM p) AS rows, (SELECT coalesce(sum(size - 1), 0)::BIGINT FROM p) AS deletions,
  (SELECT count(*) FROM c) AS conflict_groups, (SELECT count(*) FROM k WHERE ci = '' OR st = '') AS ungroupable""")
def q_plan_totals(spark, sf_dir):
    rows = parts_as_institutions(spark, sf_dir)
    return duplicates.plan_totals(rows, duplicates.plan(rows))


_INST = "id, source, source_id, name, normalized_name, category, city, state, country, website, logo_key, source_year, is_active"


@query(f"""WITH {_PLAN_SQL}
SELECT i.id, i.source, i.source_id, CASE WHEN p.canonical_id IS NULL THEN i.name ELSE p.name END AS name, i.normalized_name, i.category,
  CASE WHEN p.canonical_id IS NULL THEN i.city ELSE p.city END AS city, CASE WHEN p.canonical_id IS NULL THEN i.state ELSE p.state END AS state, i.country,
  CASE WHEN p.canonical_id IS NULL THEN i.website ELSE p.website END AS website, CASE WHEN p.canonical_id IS NULL THEN i.logo_key ELSE p.logo_key END AS logo_key,
  CASE WHEN p.canonical_id IS NULL THEN i.source_year ELSE p.source_year END AS source_year,
  CASE WHEN p.canonical_id IS NULL THEN i.is_active ELSE p.is_active END AS is_active
FROM inst i LEFT JOIN p ON p.canonical_id = i.id WHERE i.id NOT IN (SELECT id FROM g WHERE rn > 1)""")
def q_consolidation_apply(spark, sf_dir):
    rows = parts_as_institutions(spark, sf_dir)
    return upsert.apply_merges(rows, duplicates.merged_rows(duplicates.plan(rows)), duplicates.superseded(rows))


@query(f"""WITH {INSTITUTIONS_SQL}, a AS ({_NAME_STATE}), m AS (
  SELECT a.group_key, a.size, i.* FROM a JOIN inst i ON {_KEY.format("")} = a.group_key
), raw AS (
  SELECT p_partkey::VARCHAR AS source_id, trim(p_name) AS rawName, 'P' || p_size AS sourceAddress, upper(p_brand) AS sourceState,
    CASE WHEN p_size % 2 = 0 THEN 'Active' ELSE 'Inactive/unknown' END AS status, concat_ws(', ', p_type, p_size::VARCHAR) AS sourceClassification
  FROM part WHERE p_partkey % 3 = 0
)
SELECT m.group_key, m.size AS "groupSize", m.id AS "dbId", m.source, m.source_id AS "sourceId", m.name, raw.rawName AS "rawName", raw.sourceAddress AS "sourceAddress",
  raw.sourceState AS "sourceState", raw.status AS status, raw.sourceClassification AS "sourceClassification",
  CASE WHEN raw.source_id IS NULL THEN 'missing_raw_row' ELSE 'matched_raw_row' END AS "sourceMatch",
  CASE WHEN raw.source_id IS NULL THEN 'Raw source row was not found.' ELSE '' END AS "reviewNotes"
FROM m LEFT JOIN raw ON m.source = 'IPEDS' AND raw.source_id = m.source_id""")
def q_review_join(spark, sf_dir):
    rows = parts_as_institutions(spark, sf_dir)
    keys = [F.col("category"), F.col("state"), F.col("normalized_name")]
    members = duplicates.with_members(rows, duplicates.same_name_state(rows), keys).withColumnRenamed("group_key", "groupId")
    raw = _table(spark, sf_dir, "part").where("p_partkey % 3 = 0").select(
        F.col("p_partkey").cast("string").alias("UNITID"), F.concat(F.lit(" "), "p_name").alias("INSTNM"), F.concat(F.lit("P"), F.col("p_size").cast("string")).alias("ADDR"),
        F.col("p_brand").alias("STABBR"), F.when(F.col("p_size") % 2 == 0, "1").otherwise("3").alias("CYACTIVE"), F.lit("-2").alias("WEBADDR"), F.lit("").alias("CITY"),
        F.col("p_type").alias("CONTROL"), F.col("p_size").cast("string").alias("SECTOR"), F.col("p_partkey").alias("row_no"),
    )
    table = review.review_table(members, review.contexts({"IPEDS": raw}))
    return table.select(
        F.col("groupId").alias("group_key"), "groupSize", "dbId", "source", "sourceId", "name", "rawName", "sourceAddress", "sourceState", "status", "sourceClassification", "sourceMatch", "reviewNotes"
    )


# ---------------------------------------------------------------- line items and customers as source files

_STATES = ("ma", "MA", "PR", "DC", "ny ")
_SITES = ("", "www.x.edu", "http://bad host", "-2")


def _pick(values: tuple[str, ...], key: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (key % len(values) + 1).cast("int"))


def lineitem_as_colleges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of a college file; row_no is the line item's place in a total order."""
    return _table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linenumber") == 7, "-1").when(F.col("l_linenumber") == 6, F.concat(F.lit("x"), F.col("l_orderkey").cast("string"))).otherwise(
            F.concat(F.lit(" "), F.col("l_orderkey").cast("string"))
        ).alias("UNITID"),
        F.when(F.col("l_partkey") % 11 == 0, " ").otherwise(F.concat(F.lit("Part & Co "), F.col("l_partkey").cast("string"))).alias("INSTNM"),
        F.when(F.col("l_suppkey") % 6 == 0, "-3").otherwise(F.concat(F.lit("City "), F.col("l_suppkey").cast("string"))).alias("CITY"),
        _pick(_STATES, F.col("l_suppkey")).alias("STABBR"),
        _pick(_SITES, F.col("l_partkey")).alias("WEBADDR"),
        F.when(F.col("l_discount") > 0.09, "2").otherwise("1").alias("POSTSEC"),
        F.when(F.col("l_tax") > 0.07, "3").otherwise("1").alias("CYACTIVE"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate").alias("row_no"),
    )


_COLLEGE_SQL = """raw AS (
  SELECT *, CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linenumber = 6 THEN 'x' || l_orderkey ELSE l_orderkey::VARCHAR END AS source_id,
    CASE WHEN l_partkey % 11 = 0 THEN '' ELSE 'Part & Co ' || l_partkey END AS name, ['MA', 'MA', 'PR', 'DC', 'NY'][(l_suppkey % 5 + 1)::INT] AS state
  FROM lineitem
), staged AS (
  SELECT *, source_id IS NOT NULL AND row_number() OVER (PARTITION BY source_id ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) > 1 AS dup FROM raw
), reasoned AS (
  SELECT *, list_filter([CASE WHEN source_id IS NULL THEN 'missing_source_id' WHEN source_id LIKE 'x%' OR source_id = '0' THEN 'invalid_source_id' END,
    CASE WHEN name = '' THEN 'missing_name' END, CASE WHEN l_discount > 0.09 THEN 'not_postsecondary' END, CASE WHEN l_tax > 0.07 THEN 'inactive' END,
    CASE WHEN state = 'PR' THEN 'outside_50_states_plus_dc' END, CASE WHEN dup THEN 'duplicate_source_id' END], lambda x: x IS NOT NULL) AS reasons
  FROM staged
)"""


def _staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.stage(lineitem_as_colleges(spark, sf_dir), ingest.IPEDS)


@query(f"""WITH {_COLLEGE_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, source_id, array_to_string(reasons, ',') AS reasons
FROM reasoned WHERE len(reasons) > 0""")
def q_reject_reasons(spark, sf_dir):
    rows = ingest.rejected(_staged(spark, sf_dir))
    place = (F.col(f"row_no.{c}").alias(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    return rows.select(*place, "source_id", F.array_join("reasons", ",").alias("reasons"))


@query(f"WITH {_COLLEGE_SQL} SELECT reason, count(*) AS rows FROM (SELECT unnest(reasons) AS reason FROM reasoned) GROUP BY 1")
def q_reject_histogram(spark, sf_dir):
    return ingest.reject_histogram(ingest.rejected(_staged(spark, sf_dir)))


@query(f"""WITH {_COLLEGE_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, array_to_string(reasons, ',') AS reasons FROM reasoned WHERE len(reasons) > 0
ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate LIMIT 10""")
def q_reject_examples(spark, sf_dir):
    rows = ingest.reject_examples(ingest.rejected(_staged(spark, sf_dir)))
    return rows.select(*(F.col(f"row_no.{c}").alias(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")), F.array_join("reasons", ",").alias("reasons"))


@query(f"""WITH {_COLLEGE_SQL} SELECT count(*) AS total_rows, count(*) FILTER (len(reasons) > 0) AS rejected_rows, count(*) FILTER (dup) AS duplicate_source_ids,
  count(*) FILTER (len(reasons) = 0) AS selected_rows, count(*) FILTER (len(reasons) = 0 AND l_partkey % 4 = 2) AS invalid_websites, 0::BIGINT AS mailing_city_fallbacks FROM reasoned""")
def q_import_stats(spark, sf_dir):
    staged = _staged(spark, sf_dir)
    return ingest.statistics(staged, ingest.accepted(staged, ingest.IPEDS, _run_ts()))


@query(f"""WITH {_COLLEGE_SQL} SELECT sha256('IPEDS' || chr(0) || source_id) AS id, source_id, name, 'part and co ' || l_partkey AS normalized_name, 'college' AS category,
  CASE WHEN l_suppkey % 6 <> 0 THEN 'City ' || l_suppkey END AS city, state, CASE WHEN l_partkey % 4 = 1 THEN 'https://www.x.edu' END AS website, 2025 AS source_year
FROM reasoned WHERE len(reasons) = 0""")
def q_import_records(spark, sf_dir):
    rows = ingest.accepted(_staged(spark, sf_dir), ingest.IPEDS, _run_ts())
    return rows.select("id", "source_id", "name", "normalized_name", "category", "city", "state", "website", "source_year")


@query("""SELECT l_orderkey, count(*) - 1 AS later_rows FROM lineitem GROUP BY 1 HAVING count(*) > 1""")
def q_duplicate_source_ids(spark, sf_dir):
    rows = _table(spark, sf_dir, "lineitem").select("l_orderkey", F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate").alias("row_no"))
    later = rows.withColumn("first", ingest.first_occurrence(F.col("l_orderkey"), ["row_no"])).where("not first")
    return later.groupBy("l_orderkey").agg(F.count("*").alias("later_rows"))


def customers_as_private_schools(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    rows = _table(spark, sf_dir, "customer").join(_table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return rows.select(
        F.concat(F.lit("A"), key.cast("string")).alias("PPIN"),
        F.col("c_name").alias("PINST"),
        F.when(key % 5 == 0, "").otherwise(F.col("n_name")).alias("PCITY"),
        F.col("c_nationkey").cast("string").alias("PSTANSI"),
        F.when(key % 3 == 0, " -1").otherwise(F.concat(F.lit("Town "), (key % 10).cast("string"))).alias("PL_CIT"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "1").otherwise("2").alias("P265"),
        F.when(key % 2 == 0, "1").alias("P275"),
        F.lit("").alias("P285"),
        F.lit("-1").alias("P295"),
        key.alias("row_no"),
    )


_CODES = ", ".join(f"'{int(k)}': '{v}'" for k, v in T.STATE_BY_CODE.items())


@query(f"""WITH x AS (
  SELECT 'A' || c_custkey AS source_id, c_name AS name, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'Town ' || (c_custkey % 10) END AS physical,
    CASE WHEN c_custkey % 5 = 0 THEN '' ELSE n_name END AS mailing, map {{{_CODES}}}[c_nationkey::VARCHAR] AS state, c_mktsegment = 'MACHINERY' OR c_custkey % 2 = 0 AS grade
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
)
SELECT source_id, name, nullif(CASE WHEN physical <> '' THEN physical ELSE mailing END, '') AS city, state, physical = '' AND mailing <> '' AS mailing_fallback
FROM x WHERE state IS NOT NULL AND grade""")
def q_city_fallback(spark, sf_dir):
    staged = ingest.stage(customers_as_private_schools(spark, sf_dir), ingest.PSS)
    return ingest.accepted(staged, ingest.PSS, _run_ts()).select("source_id", "name", "city", "state", "mailing_fallback")


_PADDED = r"CASE (c_custkey % 5)::INT WHEN 0 THEN '-1' WHEN 1 THEN ' -2 ' WHEN 2 THEN chr(160) || c_name || chr(8195) WHEN 3 THEN chr(65279) || c_mktsegment END"


@query(f"""WITH x AS (SELECT c_custkey, coalesce(regexp_replace({_PADDED}, '^[\\s\\x{{A0}}\\x{{2003}}\\x{{FEFF}}]+|[\\s\\x{{A0}}\\x{{2003}}\\x{{FEFF}}]+$', '', 'g'), '') AS t, c_mktsegment FROM customer)
SELECT c_custkey, CASE WHEN t IN ('-1', '-2', '-3') THEN '' ELSE t END AS cleaned,
  CASE WHEN t IN ('-1', '-2', '-3', '') THEN c_mktsegment ELSE t || ', ' || c_mktsegment END AS joined FROM x""")
def q_clean_sentinels(spark, sf_dir):
    key = F.col("c_custkey") % 5
    padded = (
        F.when(key == 0, "-1").when(key == 1, " -2 ").when(key == 2, F.concat(F.lit(chr(160)), "c_name", F.lit(chr(8195)))).when(key == 3, F.concat(F.lit(chr(65279)), "c_mktsegment"))
    )
    return _table(spark, sf_dir, "customer").select("c_custkey", T.clean(padded).alias("cleaned"), T.join_parts([padded, F.lit("-3"), "c_mktsegment"]).alias("joined"))


_D3 = r"md5(trim(regexp_replace(replace(lower(strip_accents({0})), '&', ' and '), '[^\p{{L}}\p{{N}}]+', ' ', 'g')))"


@query(f"""SELECT 'd' || doc_id AS id, {_D3.format("coalesce(text, '')")} AS normal FROM documents
UNION ALL SELECT 'c' || conv_id || '-' || turn, {_D3.format("coalesce(text, '')")} FROM conversations""")
def q_normalize_name(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), "text")
    turns = _table(spark, sf_dir, "conversations").select(F.concat_ws("-", F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.col("turn").cast("string")).alias("id"), "text")
    return docs.unionByName(turns).select("id", F.md5(T.normalize_name("text").cast("binary")).alias("normal"))


# ---------------------------------------------------------------- keyed writes


def customers_as_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    then = F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")
    return _table(spark, sf_dir, "customer").select(
        F.concat(F.lit("c"), key.cast("string")).alias("id"), F.lit("CCD").alias("source"), key.cast("string").alias("source_id"), F.col("c_name").alias("name"),
        F.lower("c_name").alias("normalized_name"), F.lit("high_school").alias("category"), F.lit(None).cast("string").alias("city"), F.lit("OR").alias("state"), F.lit("US").alias("country"),
        F.when(key % 4 != 0, F.concat(F.lit("https://c"), key.cast("string"), F.lit(".org/"))).when(key % 8 == 0, "  ").alias("website"),
        F.when(key % 2 == 0, "logo").alias("logo_key"), F.lit(2024).alias("source_year"), F.lit(1).alias("is_active"),
        then.alias("created_at"), then.alias("imported_at"), then.alias("updated_at"),
    )


_CATALOG_SQL = """cat AS (
  SELECT 'c' || c_custkey AS id, 'CCD' AS source, c_custkey::VARCHAR AS source_id, c_name AS name, 'OR' AS state, CASE WHEN c_custkey % 4 <> 0 THEN 'https://c' || c_custkey || '.org/'
    WHEN c_custkey % 8 = 0 THEN '  ' END AS website, CASE WHEN c_custkey % 2 = 0 THEN 'logo' END AS logo_key, c_custkey FROM customer)"""


@query(f"""WITH {_CATALOG_SQL}, n AS (
  SELECT 'x' || c_custkey AS id, c_custkey::VARCHAR AS source_id, upper(c_name) AS name, CASE WHEN c_custkey % 2 = 1 THEN 'https://new.org/' END AS website FROM customer WHERE c_custkey % 3 = 0
  UNION ALL SELECT 'x' || (s_suppkey + 100000000), (s_suppkey + 100000000)::VARCHAR, upper(s_name), CASE WHEN (s_suppkey + 100000000) % 2 = 1 THEN 'https://new.org/' END FROM supplier
)
SELECT coalesce(cat.id, n.id) AS id, source_id, coalesce(n.name, cat.name) AS name, CASE WHEN n.id IS NULL THEN cat.website ELSE n.website END AS website, cat.logo_key,
  cat.id IS NULL AS inserted, n.id IS NOT NULL AS changed FROM cat FULL JOIN n USING (source_id)""")
def q_upsert(spark, sf_dir):
    target = customers_as_catalog(spark, sf_dir)
    keys = _table(spark, sf_dir, "customer").where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("k"), "c_name")
    keys = keys.unionByName(_table(spark, sf_dir, "supplier").select((F.col("s_suppkey") + 100000000).alias("k"), F.col("s_name").alias("c_name")))
    k = F.col("k").cast("string")
    incoming = keys.select(
        F.concat(F.lit("x"), k).alias("id"), F.lit("CCD").alias("source"), k.alias("source_id"), F.upper("c_name").alias("name"), F.lower("c_name").alias("normalized_name"),
        F.lit("high_school").alias("category"), F.lit(None).cast("string").alias("city"), F.lit("OR").alias("state"), F.lit("US").alias("country"),
        F.when(F.col("k") % 2 == 1, "https://new.org/").alias("website"), F.lit(None).cast("string").alias("logo_key"), F.lit(2025).alias("source_year"), F.lit(1).alias("is_active"),
        _run_ts().alias("imported_at"),
    )
    now = _run_ts().cast("timestamp")
    out = upsert.upsert(target, incoming, _run_ts())
    return out.select("id", "source_id", "name", "website", "logo_key", (F.col("created_at") == now).alias("inserted"), (F.col("updated_at") == now).alias("changed"))


@query(f"""WITH {_CATALOG_SQL} SELECT id, CASE WHEN (website IS NULL OR trim(website, ' ') = '') AND c_custkey % 3 = 0 THEN 'https://found.org/' || id ELSE website END AS website,
  (website IS NULL OR trim(website, ' ') = '') AND c_custkey % 3 = 0 AS changed FROM cat""")
def q_conditional_update(spark, sf_dir):
    rows = customers_as_catalog(spark, sf_dir)
    found = rows.where(F.col("source_id").cast("long") % 3 == 0).select("id", F.concat(F.lit("https://found.org/"), "id").alias("website"))
    out = upsert.fill_blank(rows, found, ["id"], "website", _run_ts())
    return out.select("id", "website", (F.col("updated_at") == _run_ts()).alias("changed"))


# ---------------------------------------------------------------- website research


@query(f"""WITH {INSTITUTIONS_SQL}, m AS (SELECT * FROM inst WHERE website IS NULL OR trim(website, ' ') = '')
SELECT ((row_number() OVER (ORDER BY category, state, normalized_name, city NULLS FIRST, source, source_id) - 1) // 100 + 1)::INT AS batch, id, name, category, city, state, country,
  coalesce(website, '') AS website FROM m""")
def q_missing_export_batches(spark, sf_dir):
    return enrich.missing_websites(parts_as_institutions(spark, sf_dir))


def _research(catalog: DataFrame) -> DataFrame:
    """What came back for the catalog's rows: found, unchanged, in conflict, invalid or nothing."""
    key = F.col("source_id").cast("long")
    site = (
        F.when(key % 7 == 0, "").when(key % 7 == 1, "ftp://x.org").when(key % 7 == 2, "https://u:p@x.org").when(key % 7 == 3, F.concat(F.lit("HTTPS://C"), "source_id", F.lit(".ORG#top")))
        .when(key % 7 == 4, "no address").otherwise(F.concat(F.lit(" https://r"), "source_id", F.lit(".org/a ")))
    )
    return catalog.select(
        F.lit("batch.csv").alias("file_name"), (key + 2).alias("row_number"), "id", "name", "category", F.coalesce("city", F.lit("")).alias("city"), "state", "country", site.alias("website")
    )


_RESEARCH_SQL = f"""{_CATALOG_SQL}, r AS (
  SELECT *, CASE (c_custkey % 7)::INT WHEN 3 THEN 'https://c' || source_id || '.org/' WHEN 5 THEN 'https://r' || source_id || '.org/a' WHEN 6 THEN 'https://r' || source_id || '.org/a' END AS found,
    CASE (c_custkey % 7)::INT WHEN 1 THEN 'Website must use http or https.' WHEN 2 THEN 'Website must include a hostname and cannot include credentials.'
      WHEN 4 THEN 'Website is not a valid absolute URL.' END AS problem FROM cat)"""


@query(f"""WITH {_RESEARCH_SQL} SELECT id, found AS website, CASE WHEN problem IS NOT NULL THEN 'invalid_website' WHEN found IS NULL THEN 'unresolved'
  WHEN trim(website) <> '' THEN CASE WHEN website = found THEN 'already_current_local' ELSE 'local_website_conflict' END ELSE 'would_update_local' END AS outcome,
  CASE WHEN problem IS NOT NULL THEN problem WHEN found IS NOT NULL AND trim(website) <> '' THEN CASE WHEN website = found THEN 'Local D1 already has this website.'
    ELSE 'Local D1 already has a different nonblank website.' END END AS detail FROM r""")
def q_enrichment_outcomes_local(spark, sf_dir):
    catalog = customers_as_catalog(spark, sf_dir)
    outcomes, _ = enrich.reconcile(_research(catalog), catalog)
    return outcomes.select("id", "website", "outcome", "detail")


@query(f"""WITH {_RESEARCH_SQL}, z AS (SELECT *, CASE WHEN c_custkey % 2 = 0 THEN found ELSE website END AS local, c_custkey % 5 <> 0 AS there,
  CASE (c_custkey % 4)::INT WHEN 0 THEN ' ' WHEN 1 THEN 'https://c' || source_id || '.org/' WHEN 2 THEN 'https://other.org/' END AS remote FROM r)
SELECT id, CASE WHEN problem IS NOT NULL THEN 'invalid_website' WHEN found IS NULL THEN 'unresolved' WHEN local IS DISTINCT FROM found THEN 'local_not_synced'
  WHEN NOT there THEN 'remote_id_not_found' WHEN coalesce(trim(remote), '') = '' THEN 'would_update_remote' WHEN remote = found THEN 'already_current_remote'
  ELSE 'remote_website_conflict' END AS outcome FROM z""")
def q_enrichment_outcomes_remote(spark, sf_dir):
    catalog = customers_as_catalog(spark, sf_dir)
    records = _research(catalog)
    key = F.col("source_id").cast("long")
    synced = enrich.first_outcomes(records).select("id", F.col("website").alias("found"))
    local = catalog.join(synced, "id").withColumn("website", F.when(key % 2 == 0, F.col("found")).otherwise(F.col("website"))).drop("found")
    remote = catalog.where(key % 5 != 0).withColumn(
        "website", F.when(key % 4 == 0, " ").when(key % 4 == 1, F.concat(F.lit("https://c"), "source_id", F.lit(".org/"))).when(key % 4 == 2, "https://other.org/")
    )
    outcomes, _ = enrich.reconcile(records, local, remote)
    return outcomes.select("id", "outcome")


@query(f"""WITH {_RESEARCH_SQL} SELECT outcome, count(*) AS rows FROM (SELECT CASE WHEN problem IS NOT NULL THEN 'invalid_website' WHEN found IS NULL THEN 'unresolved' ELSE 'pending' END AS outcome FROM r) GROUP BY 1""")
def q_outcome_histogram(spark, sf_dir):
    return enrich.histogram(enrich.first_outcomes(_research(customers_as_catalog(spark, sf_dir))))


# ---------------------------------------------------------------- search and lookup


def _search_sql(text: str, limit: int, where: str = "") -> str:
    k = max(1, len(text) // 4)
    return f"""WITH {INSTITUTIONS_SQL}, t AS (SELECT id, name, normalized_name, levenshtein(normalized_name, '{text}') AS distance, CASE WHEN normalized_name = '{text}' THEN 0
  WHEN starts_with(normalized_name, '{text}') THEN 1 WHEN contains(normalized_name, '{text}') THEN 2 WHEN levenshtein(normalized_name, '{text}') <= {k} THEN 3 END AS tier FROM inst {where})
SELECT id, name, normalized_name, tier, distance::INT AS distance FROM t WHERE tier IS NOT NULL ORDER BY tier, distance, normalized_name, id LIMIT {limit}"""


@query(_search_sql("small ring", 25))
def q_search_exact(spark, sf_dir):
    return search.search(parts_as_institutions(spark, sf_dir), "Small  Ring!", 25)


@query(_search_sql("blue", 10, "WHERE category = 'ECONOMY'"))
def q_search_prefix(spark, sf_dir):
    return search.search(parts_as_institutions(spark, sf_dir), "BLUE", None, "ECONOMY", categories=("ECONOMY",))


@query(_search_sql("smal rng", 25))
def q_search_fuzzy(spark, sf_dir):
    return search.search(parts_as_institutions(spark, sf_dir), "smal rng", 25)


@query(f"""WITH {INSTITUTIONS_SQL} SELECT id, name, normalized_name, 0 AS tier, levenshtein(normalized_name, 'b2')::INT AS distance FROM inst
WHERE id IN (SELECT p_partkey::VARCHAR FROM part WHERE p_brand = 'Brand#2') ORDER BY distance, normalized_name, id LIMIT 25""")
def q_search_alias(spark, sf_dir):
    aliases = _table(spark, sf_dir, "part").where("p_brand = 'Brand#2'").select(
        F.lit("institution").alias("entity_type"), F.col("p_partkey").cast("string").alias("entity_id"), F.lit("B2").alias("alias"), F.lit("b2").alias("normalized_alias")
    )
    return search.search(parts_as_institutions(spark, sf_dir), "B2", 25, aliases=aliases)


@query(f"""WITH {INSTITUTIONS_SQL} SELECT id, name, category, city, state, country, website, CASE WHEN logo_key <> '' THEN 'https://logos.example/' || logo_key END AS logo_url FROM inst WHERE id = '9'""")
def q_lookup(spark, sf_dir):
    return search.lookup(parts_as_institutions(spark, sf_dir), "9", "https://logos.example/")


# ---------------------------------------------------------------- processed rows and samples


@query("""SELECT user_id FROM events GROUP BY user_id HAVING NOT bool_and(event_type IN ('error', 'no_candidates'))""")
def q_processed_ids(spark, sf_dir):
    rows = _table(spark, sf_dir, "events").select("user_id", F.col("event_type").alias("status"))
    return sample.processed(rows, refresh_failed=True, key="user_id")


@query("""SELECT c_custkey::VARCHAR AS id FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE event_type <> 'error')""")
def q_unprocessed(spark, sf_dir):
    rows = _table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("id"))
    log = _table(spark, sf_dir, "events").where("event_type <> 'error'").select(F.col("user_id").cast("string").alias("institution_id"), F.col("event_type").alias("status"))
    return sample.unprocessed(rows, sample.processed(log))


@query("""WITH x AS (SELECT c_custkey AS id, c_mktsegment AS category, sha256('s1|' || c_custkey) AS h FROM customer), r AS (
  SELECT *, row_number() OVER (PARTITION BY category ORDER BY h) AS n FROM x), a AS (SELECT *, CASE WHEN category IN ('MACHINERY', 'FURNITURE') AND n <= 20 THEN 0 ELSE 1 END AS turn FROM r)
SELECT id, category FROM a ORDER BY turn, h LIMIT 40""")
def q_sample_balanced(spark, sf_dir):
    rows = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("category"))
    return sample.balanced(rows, 40, "s1", ("MACHINERY", "FURNITURE"))


@query("SELECT row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS row_no, o_orderkey FROM orders")
def q_row_numbers(spark, sf_dir):
    return numbering.numbered(_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.col("o_orderkey")]).select("row_no", "o_orderkey")


# ---------------------------------------------------------------- addresses and pages


@query("SELECT page_id, regexp_replace(url, '#.*$', '') AS address FROM pages")
def q_url_normalize(spark, sf_dir):
    return _table(spark, sf_dir, "pages").select("page_id", U.resolved_url("url", F.lit(None).cast("string")).alias("address"))


_HOST = r"regexp_replace(lower(regexp_extract(url, '^https?://([^/?#]+)', 1)), '^www\.', '')"


@query(f"SELECT page_id, {_HOST} AS host, {_HOST} = 'example.com' OR ends_with({_HOST}, '.example.com') OR ends_with('example.com', '.' || {_HOST}) AS same FROM pages")
def q_same_site(spark, sf_dir):
    url = F.col("url")
    return _table(spark, sf_dir, "pages").select("page_id", U.host_without_www(url).alias("host"), U.same_site(url, F.lit("https://www.example.com/x")).alias("same"))


@query(r"SELECT page_id, lower(regexp_extract(url, '^(https?://[^/?#]+)', 1)) || '/' || regexp_extract(url, '^https?://[^/?#]+/?([^?#]*)', 1) AS asset FROM pages")
def q_asset_identity(spark, sf_dir):
    return _table(spark, sf_dir, "pages").select("page_id", U.asset_identity(F.col("url")).alias("asset"))


_WORDS = {"the": 30, "tion": 12, "ment": -25, "ung": -7, "ción": 5}


def _points_sql(column: str) -> str:
    return " + ".join(f"CASE WHEN contains(lower({column}), '{t}') THEN {p} ELSE 0 END" for t, p in (_WORDS | S.TOKEN_POINTS).items())


@query(f"SELECT doc_id, {_points_sql('text')} AS points FROM documents")
def q_token_score(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", S.token_score(F.col("text"), _WORDS | S.TOKEN_POINTS).alias("points"))


@query("""WITH x AS (SELECT doc_id, lower(text) AS t, list_filter(regexp_split_to_array(lower(source || ' the and of ' || lang || ' source'), '[^a-z0-9]+'),
  lambda w: len(w) >= 3 AND w NOT IN ('a', 'an', 'and', 'at', 'career', 'college', 'center', 'for', 'high', 'in', 'of', 'school', 'technical', 'the', 'university')) AS w FROM documents),
y AS (SELECT *, len(list_filter(w, lambda v: contains(t, v))) AS n, array_to_string(list_transform(w, lambda v: v[1]), '') AS a FROM x)
SELECT doc_id, (least(30, n * 12) + CASE WHEN len(a) >= 3 AND contains(t, a) THEN 35 ELSE 0 END)::INT AS score FROM y""")
def q_institution_match(spark, sf_dir):
    name = F.concat_ws("", "source", F.lit(" the and of "), "lang", F.lit(" source"))
    return _table(spark, sf_dir, "documents").select("doc_id", S.institution_match(name, F.col("text"))["score"].alias("score"))


_LINK_WORDS = ("the", "tion", "la", "sch")
_ADDRESS_POINTS = " + ".join(f"CASE WHEN contains(about, '{t}') THEN {p} ELSE 0 END" for t, p in S.TOKEN_POINTS.items())
_LINKS = """regexp_extract_all(html, '(?is)<a href="/[^"]*">.*?</a>')"""
# url_encode() also escapes characters that a path may hold as they are
_PATH = """url_encode(regexp_extract(a, 'href="/([^"]*)"', 1))"""
for _ch in "!$&'()*+,:;=@/":
    _PATH = f"replace({_PATH}, '%{ord(_ch):02X}', chr({ord(_ch)}))"


@query(f"""WITH l AS (
  SELECT page_id, url AS page_url, lower(regexp_extract(url, '^(https?://[^/?#]+)', 1)) AS origin, unnest({_LINKS}) AS a, generate_subscripts({_LINKS}, 1) - 1 AS ord FROM pages
), h AS (
  SELECT page_id, page_url, ord, origin || '/' || {_PATH} AS url, regexp_replace(regexp_extract(a, '(?s)>(.*)</a>', 1), '<[^>]*>', ' ', 'g') AS inside FROM l
), n AS (
  SELECT *, {" + ".join(f"contains(about, '{t}')::INT" for t in _LINK_WORDS)} AS n FROM (SELECT *, lower(url || '  ' || inside) AS about FROM h)
), r AS (SELECT page_id, page_url, url, ord, (n * 10 + {_ADDRESS_POINTS})::INT AS score FROM n WHERE n > 0)
SELECT page_id AS id, page_url, url, max(score) AS score, arg_min(ord, (-score, ord))::INT AS ord FROM r GROUP BY 1, 2, 3""")
def q_relevant_links(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), F.col("url").alias("page_url"), F.col("url").alias("root_url"), "html")
    return candidates.relevant_links(pages, _LINK_WORDS)


@query(f"""WITH c AS (SELECT page_id AS id, lower(regexp_extract(url, '^(https?://[^/?#]+)', 1)) || '/favicon.ico' AS about FROM pages)
SELECT id, about AS key, 'favicon-fallback' AS source, (10 + {_ADDRESS_POINTS})::INT AS initial_score, 1 AS inventory_index, 1 AS final_rank,
  'selected_as_favicon_fallback' AS status FROM c""")
def q_html_candidates(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), F.lit("Example School").alias("name"), F.col("url").alias("page_url"), "html")
    found = candidates.inventory(candidates.best_per_asset(candidates.scored(candidates.page_mentions(pages))))
    return selection.top_by_score(found).select("id", "key", "source", "initial_score", "inventory_index", "final_rank", "status")


# ---------------------------------------------------------------- ranking and selection


def events_as_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's events as candidates of an institution: one asset for each event type."""
    score = (F.col("value") * 10).cast("int") % 97
    return _table(spark, sf_dir, "events").select(
        F.col("user_id").alias("id"), F.concat_ws("/", F.col("event_type"), (F.col("event_id") % 20).cast("string")).alias("key"), F.col("event_id").alias("ord"), score.alias("initial_score"),
        F.when(F.col("event_type") == "error", "favicon-fallback").otherwise("image-element").alias("source"),
    )


_CANDIDATES_SQL = """cand AS (SELECT user_id AS id, event_type || '/' || (event_id % 20) AS key, event_id AS ord, (trunc(value * 10)::INT % 97)::INT AS initial_score,
  CASE WHEN event_type = 'error' THEN 'favicon-fallback' ELSE 'image-element' END AS source FROM events), best AS (
  SELECT id, key, first_seen, ord, initial_score, source FROM (SELECT *, min(ord) OVER (PARTITION BY id, key) AS first_seen,
    row_number() OVER (PARTITION BY id, key ORDER BY initial_score DESC, ord) AS n FROM cand) WHERE n = 1)"""


@query(f"WITH {_CANDIDATES_SQL} SELECT id, key, first_seen, ord, initial_score FROM best")
def q_argmax_candidate(spark, sf_dir):
    return candidates.best_per_asset(events_as_candidates(spark, sf_dir)).select("id", "key", "first_seen", "ord", "initial_score")


@query(f"""WITH {_CANDIDATES_SQL}, i AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY first_seen, key) AS inventory_index FROM best) WHERE inventory_index <= 144),
r AS (SELECT *, source = 'favicon-fallback' AS icon, row_number() OVER (PARTITION BY id, source = 'favicon-fallback' ORDER BY initial_score DESC, key) AS n,
  count(*) FILTER (source <> 'favicon-fallback') OVER (PARTITION BY id) AS others FROM i)
SELECT id, key, inventory_index::INT AS inventory_index, ((inventory_index - 1) // 36 + 1)::INT AS batch_number,
  CASE WHEN icon AND others = 0 AND n <= 5 OR NOT icon AND n <= 12 THEN n END::INT AS final_rank,
  CASE WHEN icon AND others = 0 AND n <= 5 THEN 'selected_as_favicon_fallback' WHEN icon THEN 'deferred_favicon' ELSE 'ai_disabled' END AS status FROM r""")
def q_topk_candidates(spark, sf_dir):
    found = candidates.inventory(candidates.best_per_asset(events_as_candidates(spark, sf_dir)))
    return selection.top_by_score(found).select("id", "key", "inventory_index", "batch_number", "final_rank", "status")


@query("""WITH x AS (SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderkey % 5 + 1 END AS chosen,
  ['logo', 'photo', 'icon', 'seal', 'unknown'][(o_custkey % 5 + 1)::INT] AS kind, o_orderkey % 4 <> 0 AS eligible, (o_orderkey % 10) / 10.0::DOUBLE AS confidence, (o_custkey % 101)::INT AS score FROM orders)
SELECT o_orderkey, CASE WHEN chosen IS NULL THEN 'no_match' WHEN NOT (eligible AND kind IN ('logo', 'seal')) THEN 'rejected_kind' WHEN confidence >= 0.8 THEN 'accepted' ELSE 'below_threshold' END AS status,
  CASE WHEN kind = 'photo' THEN least(score, 5) WHEN kind = 'icon' AND NOT eligible THEN least(score, 12) WHEN kind = 'unknown' AND NOT eligible THEN least(score, 20) ELSE score END AS score FROM x""")
def q_select_status(spark, sf_dir):
    key = F.col("o_orderkey")
    rows = _table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(key % 6 != 0, key % 5 + 1).alias("chosen"), _pick(("logo", "photo", "icon", "seal", "unknown"), F.col("o_custkey")).alias("kind"),
        (key % 4 != 0).alias("eligible"), ((key % 10) / 10).alias("confidence"), (F.col("o_custkey") % 101).cast("int").alias("score"),
    )
    fine = S.acceptable(F.col("kind"), F.col("eligible"), F.lit("image-element"), F.lit(False))
    return rows.select("o_orderkey", S.selection_status(F.col("chosen"), fine, F.col("confidence")).alias("status"), S.review_score(F.col("score"), F.col("kind"), F.col("eligible")).alias("score"))


@query("""WITH x AS (SELECT p_partkey, (p_size % 20 + 1) * 8 AS w, (p_partkey % 25 + 1) * 8 AS h, p_size AS s FROM part)
SELECT p_partkey, greatest(0, least(100, 30 + s + CASE WHEN w / h BETWEEN 0.65 AND 1.7 THEN 4 WHEN w / h > 4 OR w / h < 0.25 THEN -12 ELSE 0 END
  + CASE WHEN w >= 32 AND h >= 32 THEN 2 ELSE 0 END))::INT AS score FROM x""")
def q_shape_score(spark, sf_dir):
    width, height = (F.col("p_size") % 20 + 1) * 8, (F.col("p_partkey") % 25 + 1) * 8
    return _table(spark, sf_dir, "part").select("p_partkey", S.shape_score(F.col("p_size"), width, height).alias("score"))
