"""Queries of the index for search, of the bucketed store and of the seeded shuffle."""

from __future__ import annotations

from pyspark.sql import functions as F

from quadrangle.functions import text as T
from quadrangle.operators import name_index, shuffle, store
from quadrangle.plans.catalog_queries import _CATALOG_SQL, INSTITUTIONS_SQL, _run_ts, _table, customers_as_catalog, parts_as_institutions, query
from quadrangle.sources.schema import INSTITUTIONS
from quadrangle.sources.scratch import new_folder

# ---------------------------------------------------------------- search of many requests


@query(f"""WITH {INSTITUTIONS_SQL}, q AS (
  SELECT s_suppkey AS request, normalized_name[1:2] || normalized_name[4:] AS query FROM supplier JOIN inst ON id = s_suppkey::VARCHAR
  UNION ALL SELECT s_suppkey + 1000000000, 'alias ' || s_nationkey FROM supplier
), a AS (SELECT DISTINCT s_suppkey::VARCHAR AS id, 'alias ' || s_nationkey AS query FROM supplier), m AS (
  SELECT request, inst.id, name, normalized_name, levenshtein(normalized_name, query) AS distance,
    CASE WHEN normalized_name = query OR a.id IS NOT NULL THEN 0 WHEN starts_with(normalized_name, query) THEN 1 WHEN contains(normalized_name, query) THEN 2
      WHEN levenshtein(normalized_name, query) <= greatest(1, len(query) // 4) THEN 3 END AS tier
  FROM q CROSS JOIN inst LEFT JOIN a USING (id, query)
)
SELECT request, id, name, normalized_name, tier, distance::INT AS distance FROM m WHERE tier IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY request ORDER BY tier, distance, normalized_name, id) <= 10""")
def q_search_many(spark, sf_dir):
    catalog = parts_as_institutions(spark, sf_dir)
    supplier = _table(spark, sf_dir, "supplier")
    alias = F.concat(F.lit("alias "), F.col("s_nationkey").cast("string"))
    folder = new_folder(spark)
    name_index.build(catalog, folder, supplier.select(F.col("s_suppkey").cast("string").alias("entity_id"), alias.alias("normalized_alias")))
    names = catalog.select("id", "normalized_name").join(supplier.select("s_suppkey", F.col("s_suppkey").cast("string").alias("id")), "id")
    misspelt = F.concat(F.substring("normalized_name", 1, 2), F.expr("substring(normalized_name, 4)"))
    asked = names.select(F.col("s_suppkey").alias("request"), misspelt.alias("query"))
    asked = asked.unionByName(supplier.select((F.col("s_suppkey") + 1000000000).alias("request"), alias.alias("query")))
    asked = asked.withColumns({"n": F.lit(10), "category": F.lit(None).cast("string")})
    return name_index.NameIndex(spark, folder).search(asked)


# ---------------------------------------------------------------- writes that touch what changes


def _customers_store(spark, sf_dir) -> store.Store:
    rows = customers_as_catalog(spark, sf_dir)
    return store.Store.create(rows.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in INSTITUTIONS.fields)), new_folder(spark), ["source", "source_id"], 32)


@query(f"""WITH {_CATALOG_SQL}, n AS (SELECT s_suppkey, s_suppkey::VARCHAR AS source_id, upper(s_name) AS name FROM supplier UNION ALL SELECT s_suppkey, (s_suppkey + 100000000)::VARCHAR, s_name FROM supplier)
SELECT coalesce(cat.id, 'x' || source_id) AS id, source_id, coalesce(n.name, cat.name) AS name, CASE WHEN n.name IS NULL THEN cat.website ELSE 'https://new.org/' || s_suppkey END AS website,
  n.name IS NOT NULL AS changed FROM cat FULL JOIN n USING (source_id)""")
def q_store_upsert(spark, sf_dir):
    held = _customers_store(spark, sf_dir)
    supplier = _table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey")
    both = supplier.select("s_suppkey", key.cast("string").alias("source_id"), F.upper("s_name").alias("name"))
    both = both.unionByName(supplier.select("s_suppkey", (key + 100000000).cast("string").alias("source_id"), F.col("s_name").alias("name")))
    incoming = both.select(
        F.concat(F.lit("x"), "source_id").alias("id"), F.lit("CCD").alias("source"), "source_id", "name", T.normalize_name("name").alias("normalized_name"), F.lit("college").alias("category"),
        F.lit("Salem").alias("city"), F.lit("OR").alias("state"), F.lit("US").alias("country"), F.concat(F.lit("https://new.org/"), key.cast("string")).alias("website"),
        F.lit(2025).alias("source_year"), F.lit(1).alias("is_active"), _run_ts().alias("imported_at"),
    )
    store.upsert(held, incoming, _run_ts())
    return held.read().select("id", "source_id", "name", "website", (F.col("updated_at") == _run_ts().cast("timestamp")).alias("changed"))


@query(f"""WITH {_CATALOG_SQL}, f AS (SELECT 'c' || s_suppkey AS id, 'education/' || s_suppkey AS new_key, s_suppkey % 3 = 0 AS gone FROM supplier)
SELECT id, CASE WHEN logo_key IS NULL THEN new_key ELSE logo_key END AS logo_key, CASE WHEN gone = false THEN 'https://merged.org/' ELSE website END AS website
FROM cat LEFT JOIN f USING (id) WHERE gone IS NOT true""")
def q_store_updates(spark, sf_dir):
    held = _customers_store(spark, sf_dir)
    key = F.col("s_suppkey")
    rows = _table(spark, sf_dir, "supplier").select(F.concat(F.lit("c"), key.cast("string")).alias("id"), F.concat(F.lit("education/"), key.cast("string")).alias("logo_key"), key)
    store.fill_blank(held, rows.select("id", "logo_key"), "logo_key", _run_ts())
    store.fill_blank(held, rows.select("id", F.lit("too late").alias("logo_key")), "logo_key", _run_ts())
    merged = rows.where("s_suppkey % 3 <> 0").select("id", F.lit("https://merged.org/").alias("website"))
    store.apply_merges(held, merged, rows.where("s_suppkey % 3 = 0").select("id"))
    return held.read().select("id", "logo_key", "website")


# ---------------------------------------------------------------- the seeded sample

_SEED = "evaluation-1"


def _shuffle_sql(number: int, source: str, skip: str) -> str:
    """Common tables l (the list before each step) of one shuffle, step by step; o is its result."""
    word = 4294967296
    state = f"(({shuffle.first_state(_SEED)}::HUGEINT + {shuffle.STEP}::HUGEINT * (skip + n - i)) % {word})::UBIGINT"
    times = lambda a, b: f"(({a})::HUGEINT * ({b})::HUGEINT % {word})::UBIGINT"
    one = times("xor(v, v >> 15)", "v | 1::UBIGINT")
    two = f"xor(w, ((w::HUGEINT + {times('xor(w, w >> 7)', 'w | 61::UBIGINT')}) % {word})::UBIGINT)"
    return f"""b{number} AS (SELECT {source} AS l, len({source}) AS n, {skip} AS skip), s{number} AS (
  SELECT l, n, skip, n - 1 AS i FROM b{number}
  UNION ALL
  SELECT list_transform(l, lambda x, p: CASE p WHEN i + 1 THEN l[j + 1] WHEN j + 1 THEN l[i + 1] ELSE x END), n, skip, i - 1
  FROM (SELECT *, floor(xor(u, u >> 14)::DOUBLE / {word}.0::DOUBLE * (i + 1))::BIGINT AS j FROM (SELECT *, {two} AS u FROM (SELECT *, {one} AS w FROM (SELECT *, {state} AS v FROM s{number} WHERE i > 0))))
), o{number} AS (SELECT l, skip + greatest(n - 1, 0) AS skip FROM s{number} ORDER BY i LIMIT 1)"""


@query(f"""WITH RECURSIVE {_shuffle_sql(1, "(SELECT list(s_suppkey ORDER BY s_suppkey) FROM supplier WHERE s_nationkey = 3)", "0")},
{_shuffle_sql(2, "(SELECT list(s_suppkey ORDER BY s_suppkey) FROM supplier WHERE s_nationkey = 7)", "(SELECT skip FROM o1)")},
c AS (SELECT list_concat(o1.l[1:10], o2.l[1:10]) AS l FROM o1, o2),
{_shuffle_sql(3, "(SELECT list(s_suppkey ORDER BY s_suppkey) FROM supplier, c WHERE NOT list_contains(l, s_suppkey))", "(SELECT skip FROM o2)")},
{_shuffle_sql(4, "(SELECT list_concat(c.l, o3.l[1:20 - len(c.l)]) FROM c, o3)", "(SELECT skip FROM o3)")}
SELECT unnest(l) AS id, generate_subscripts(l, 1)::BIGINT - 1 AS place FROM o4""")
def q_seeded_sample(spark, sf_dir):
    rows = _table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").cast("string").alias("category"))
    return shuffle.balanced(rows, 20, _SEED, ["id"], ("3", "7")).select("id", "place")
