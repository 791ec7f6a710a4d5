"""Queries of the corpus operators over their whole tables, and their DuckDB counterparts where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrangle.llm import bpe, centroids, htmltext, infill, linedup, minhash, mixing, packing, quality, stages, suffixdedup, tokenfiles, topk, toxicity
from quadrangle.llm.common import scratch_path, table, text_hash


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.remove_repeats(table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linedup.line_classes(table(spark, sf_dir, "documents"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(table(spark, sf_dir, "pages"))


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bpe.encode(table(spark, sf_dir, "documents"), decoded="decoded")
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark)
    tokenfiles.write_ids(table(spark, sf_dir, "documents"), folder)
    return tokenfiles.with_crc32(tokenfiles.read_ids(spark, folder))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # by the text's hash, not by doc_id: so rows with a null or the same doc_id have clusters of their own text
    texts = docs.select(text_hash().alias("doc_id"), "text")
    near = minhash.near_duplicates(texts, words=5, percent=80).where("doc_id <> component_id")
    return packing.pack(docs, clusters=near.select("doc_id", "component_id").distinct().toDF("text_hash", "cluster"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80).drop("text_hash", "group")


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.Mix(table(spark, sf_dir, "documents")).taken()


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = infill.transform(table(spark, sf_dir, "documents"))
    digests = {f"{name}_sha256": F.sha2(value.cast("binary"), 256) for name, value in (("output", F.col("output")), ("restored", infill.restored(F.col("output"), F.col("form"))))}
    return rows.withColumns(digests).drop("output")


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


OP10_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS a
  FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(a) = 0 THEN [] WHEN len(a) = 1 THEN a
    ELSE list_transform(range(1, len(a)), lambda i: a[i] || ' ' || a[i + 1]) END) AS g
  FROM w
), n AS (SELECT doc_id, len(g)::BIGINT AS n FROM s), u AS (SELECT doc_id, unnest(g) AS x FROM s),
l AS (
  SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS k FROM u p JOIN u q ON p.x = q.x AND p.doc_id < q.doc_id GROUP BY 1, 2
), e AS (
  SELECT a, b FROM l JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)
), r AS (
  SELECT doc_id AS a, doc_id AS b FROM n
  UNION
  SELECT r.a, d.b FROM r JOIN (SELECT a, b FROM e UNION ALL SELECT b, a FROM e) d ON r.b = d.a
), c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT n.doc_id, n.n AS n_shingles, c.component_id, c.component_id = n.doc_id AS kept FROM n JOIN c USING (doc_id)
"""

OP2_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents), w AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS a,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM t
), c AS (
  SELECT *, len(a)::BIGINT AS n_words, len(array_to_string(a, ''))::BIGINT AS word_chars, len(l)::BIGINT AS n_lines,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines
  FROM w
), g AS (
  SELECT r, i, array_to_string(a[i:i + 4], ' ') AS g FROM (SELECT r, a, unnest(range(1, len(a) - 3)) AS i FROM c)
), d AS (
  SELECT r, i FROM (SELECT *, count(*) OVER (PARTITION BY r, g) AS k FROM g) WHERE k > 1
), p AS (SELECT r, count(DISTINCT i + j)::BIGINT AS n FROM d, range(5) AS x(j) GROUP BY r), s AS (
  SELECT c.*, coalesce(p.n, 0) AS n_repeat_words, n_words < 10 OR 100 * coalesce(p.n, 0) > 20 * n_words AS base_failed
  FROM c LEFT JOIN p USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 15 * n_words
    OR 10 * n_dup_lines > 3 * n_lines OR 100 * len(regexp_extract_all(text, '[^\x20\x09-\x0D]*\p{L}[^\x20\x09-\x0D]*')) < 60 * n_words
    OR 10 * len(regexp_extract_all(text, '(?m)(\.\.\.|…)$')) > 3 * n_lines
    OR 10 * len(regexp_extract_all(text, '(?m)^[•‣*-]\x20')) > 9 * n_lines) AS kept
FROM s
"""

OP5_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, x.vec_id, list_inner_product(q.v, x.v)::BIGINT AS score FROM v q JOIN v x ON q.vec_id <> x.vec_id WHERE q.vec_id % 100 = 0
)
SELECT query_id, rank::INT AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10
"""

# Positions in a source, blocks and the shuffle that chooses them; which shard a block goes to does not change what is taken.
OP11_SQL = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, source, coalesce(text, '') AS text, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), d AS (
  SELECT row_number() OVER () AS id, doc_id, source, size, ('0x' || substr(sha256('11:' || coalesce(doc_id::VARCHAR, '') || ':' || text), 1, 15))::BIGINT AS h FROM t
), a AS (
  SELECT source, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS s, sum(size)::BIGINT AS z FROM d GROUP BY source
), w AS (SELECT *, ([3, 1, 2])[(s % 3) + 1]::BIGINT AS w FROM a), o AS (
  SELECT *, 3 * (sum(z) OVER ())::BIGINT - 4 * coalesce(sum(z) OVER (q ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS l,
    (sum(w) OVER (q ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS ws, row_number() OVER q AS i
  FROM w WINDOW q AS (ORDER BY z / w, s)
), f AS (SELECT i, l, ws FROM o WHERE 4 * z * ws > l * w ORDER BY i LIMIT 1), g AS (
  SELECT source, s, z, CASE WHEN f.i IS NULL OR o.i < f.i THEN (2 * z)::DOUBLE ELSE least((f.l * w)::DOUBLE / (2 * f.ws)::DOUBLE, (2 * z)::DOUBLE) END AS target
  FROM o LEFT JOIN f ON true
), b AS (
  SELECT *, round(target)::BIGINT % z AS rest, round(target)::BIGINT // z AS passes, ((z + 511) // 512)::BIGINT AS n FROM g WHERE z > 0
), k AS (SELECT unnest([{rounds}]) AS k, generate_subscripts([{rounds}], 1) AS r), r AS (
  SELECT s, n, x, x AS now, 1 AS r FROM (SELECT s, n, unnest(range(n)) AS x FROM b)
  UNION ALL
  SELECT s, n, x, CASE WHEN (((y * y + v) % 2147483647) >> 7) % 2 = 1 THEN other ELSE now END, r + 1
  FROM (
    SELECT *, (v * v + c) % 2147483647 AS y
    FROM (
      SELECT *, ((greatest(now, other) % 2147483647) * a + ((greatest(now, other) // 2147483647 + s) % 2147483647) * b) % 2147483647 AS v
      FROM (SELECT r.*, k.k.a AS a, k.k.b AS b, k.k.c AS c, (((k.k.k - now) % n) + n) % n AS other FROM r JOIN k USING (r))
    )
  )
), p AS (
  SELECT r.s, x, now AS rank, CASE WHEN x = r.n - 1 THEN z - 512 * (r.n - 1) ELSE 512 END AS words, rest FROM r JOIN b USING (s) WHERE r = {last}
), c AS (
  SELECT s, x, least(words, greatest(0, rest - coalesce(sum(words) OVER (PARTITION BY s ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)))::BIGINT AS part
  FROM p
), e AS (
  SELECT d.*, b.s, b.passes,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS lo
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source
), m AS (
  SELECT id, any_value(size * passes) + sum(greatest(0, least(lo + size, 512 * x + part) - greatest(lo, 512 * x)))::BIGINT AS taken
  FROM (SELECT *, unnest(range(lo // 512, (lo + size - 1) // 512 + 1)) AS x FROM e WHERE size > 0) JOIN c USING (s, x) GROUP BY id
)
SELECT doc_id, size, z AS source_size, target, coalesce(taken, 0)::BIGINT AS taken
FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source LEFT JOIN m USING (id)
""".format(
    rounds=", ".join(f"{{'k': {k}::BIGINT, 'a': {a}::BIGINT, 'b': {b}::BIGINT, 'c': {c}::BIGINT}}" for k, a, b, c in mixing.shuffle_rounds(mixing.SEED)),
    last=mixing.SHUFFLE_ROUNDS + 1,
)

OP12_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), h AS (
  SELECT doc_id, text, u, len(u)::BIGINT AS n, list_transform([1, 9, 17, 25], lambda i: ('0x' || substr(h, i, 8))::BIGINT) AS h FROM t
), c AS (
  SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 100 THEN 'plain' WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM h
), p AS (
  SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS prefix, coalesce(array_to_string(u[a + 1:b], ''), '') AS middle, coalesce(array_to_string(u[b + 1:n], ''), '') AS suffix FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN len(prefix)::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN len(middle)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""

_ROUND = """
), d{i} AS (SELECT v.id, c.k, sum((v.x - c.x) * (v.x - c.x)) AS d FROM e v JOIN c{i} c USING (i) GROUP BY v.id, c.k), a{i} AS (
  SELECT id, arg_min(k, (d, k)) AS k, min(d) AS d FROM d{i} GROUP BY id
), m{i} AS (SELECT k, i, sum(x)::BIGINT AS s, count(*) AS n FROM a{i} JOIN e USING (id) GROUP BY k, i), c{j} AS (
  SELECT k, i, coalesce((s - ((s % n) + n) % n) // n, x)::BIGINT AS x FROM c{i} LEFT JOIN m{i} USING (k, i)"""
OP13_SQL = (
    """
WITH v AS (
  SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), e AS (SELECT id, unnest(range(64)) AS i, unnest(v) AS x FROM v), f AS (
  SELECT id, row_number() OVER (ORDER BY sha256('1:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS k FROM v QUALIFY k < 16
), c0 AS (SELECT k, i, x FROM f JOIN e USING (id)"""
    + "".join(_ROUND.format(i=i, j=i + 1) for i in range(4))
    + """
), s AS (SELECT k, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c3 GROUP BY k)
SELECT vec_id, k::INT AS cluster, d::BIGINT AS distance, (sum(d) OVER (PARTITION BY k))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a3 JOIN v USING (id) JOIN s USING (k)
"""
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_suffix_array_dedup": op1_suffix_array_dedup,
        "op2_quality_rules": op2_quality_rules,
        "op3_line_dedup": op3_line_dedup,
        "op4_html_extraction": op4_html_extraction,
        "op5_exact_topk": op5_exact_topk,
        "op6_bpe": op6_bpe,
        "op7_token_files": op7_token_files,
        "op8_toxicity": op8_toxicity,
        "op9_packing": op9_packing,
        "op10_minhash": op10_minhash,
        "op11_mixing": op11_mixing,
        "op12_fill_in_middle": op12_fill_in_middle,
        "op13_centroids": op13_centroids,
        "pipeline": stages.run,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_quality_rules": OP2_SQL, "op5_exact_topk": OP5_SQL, "op10_minhash": OP10_SQL, "op11_mixing": OP11_SQL, "op12_fill_in_middle": OP12_SQL, "op13_centroids": OP13_SQL}
