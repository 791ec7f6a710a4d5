"""Ranked search of many requests at once over an index of name grams, without a scan of the catalog.

A name of a category has a posting for each of its positions: the three characters from there, the position and the name's length.
Postings lie in folders by a hash of the first two characters and the length, sorted within, so that a request reads the folders of its
probes alone. However many entities share a name, it is met once; its first `FIRST` ids lie beside it, dealt by the name.

* Equal names, beginnings and parts: every such name holds the request's rarest gram. One probe for each length finds them; of a name
  that holds the gram more than once the first place counts.
* Other spellings, within `edits` of the request: the request is cut into one segment more than edits. An edit can spoil one segment, so
  one of them stands in the name as it is, at most `edits` places away, and the lengths differ by as much at most. Requests of up to
  three characters meet the names of their lengths instead, which have a posting by length.

Both come out of the same verification as `search.search`, so rows and their order are the same. Equal requests are answered once.
Names are ranked before their ids are fetched, and of the ids no more than a request can show; the best take their display names from a
table dealt by id.

Probes are broadcast up to `FEW` different requests, beyond that Spark picks the join. The folders to read are known before the read (a
number for each, `MAX_BUCKETS` at most).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quadrangle.operators import search
from quadrangle.sources.schema import CATEGORIES
from quadrangle.sources.scratch import written

#: Postings in a folder, folders, requests whose probes are broadcast, and the longest name that is found by its length alone.
BUCKET_ROWS, MIN_BUCKETS, MAX_BUCKETS, FEW, SHORT = 2_000_000, 16, 4096, 10_000, 4
#: Ids of a name, and rows of a request, that hold the best: an entity that its alias puts first can come again by its name, at most once.
FIRST = 2 * search.MAX_LIMIT


def edits(query: Column) -> Column:
    """How far a spelling may be from a request."""
    return F.greatest(F.lit(1), F.floor(F.length(query) / 4)).cast("int")


def _bucket(start: Column, length: Column, buckets: int) -> Column:
    return F.pmod(F.crc32(F.concat_ws(":", start, length.cast("string"))), F.lit(buckets)).cast("int")


def _dealt(key: Column, buckets: int) -> Column:
    return F.pmod(F.crc32(key), F.lit(buckets)).cast("int").alias("bucket")


def build(catalog: DataFrame, folder: str, aliases: DataFrame | None = None, buckets: int | None = None) -> None:
    """Writes the index of catalog (id, name, normalized_name, category) and of aliases (entity_id, normalized_alias)."""
    name = F.col("normalized_name")
    rows = catalog.select("id", "name", name, "category").where(F.length(name) > 0)
    if buckets is None:
        size = rows.agg(F.sum(F.length(name))).first()[0] or 0
        buckets = min(MAX_BUCKETS, max(MIN_BUCKETS, -(-size // BUCKET_ROWS)))
    by_name = Window.partitionBy(name, "category").orderBy("id")
    firsts = rows.select("id", name, "category").distinct().withColumn("at", F.row_number().over(by_name)).where(F.col("at") <= FIRST)
    firsts = written(firsts.select("id", name, "category", _dealt(name, buckets)))
    distinct = firsts.groupBy(name, "category").agg(F.count("*").cast("int").alias("ids"))
    firsts.hint("rebalance", "bucket").sortWithinPartitions("bucket", "normalized_name", "category").write.partitionBy("bucket").parquet(f"{folder}/firsts")
    at = F.explode(F.sequence(F.lit(0), F.greatest(F.length(name) - 2, F.lit(0))))
    places = distinct.select("ids", name, "category", F.length(name).alias("length"), at.alias("place"))
    start, gram = F.substring(name, F.col("place") + 1, F.lit(2)), F.substring(name, F.col("place") + 1, F.lit(3))
    places = places.select("*", start.alias("start"), gram.alias("gram")).where("length > 1")
    short = distinct.where(F.length(name) <= SHORT).select("ids", name, "category", F.length(name).alias("length"), F.lit(-1).alias("place"), F.lit("").alias("start"), F.lit("").alias("gram"))
    postings = places.unionByName(short).withColumn("bucket", _bucket(F.col("start"), F.col("length"), buckets))
    postings.hint("rebalance", "bucket").sortWithinPartitions("bucket", "start", "length", "gram", "place").write.partitionBy("bucket").parquet(f"{folder}/postings")
    counts = places.groupBy("gram").agg(F.count("*").alias("n"), F.max("length").alias("longest"))
    counts.repartitionByRange("gram").sortWithinPartitions("gram").write.parquet(f"{folder}/grams")
    rows.select(_dealt(F.col("id"), buckets), "id", "name", name, "category").hint("rebalance", "bucket").sortWithinPartitions("bucket", "id").write.partitionBy("bucket").parquet(f"{folder}/names")
    known = aliases if aliases is not None else catalog.sparkSession.createDataFrame([], "entity_id string, normalized_alias string")
    known = known.select("normalized_alias", "entity_id").distinct()
    known.select(_dealt(F.col("normalized_alias"), buckets), "*").hint("rebalance", "bucket").sortWithinPartitions("bucket", "normalized_alias").write.partitionBy("bucket").parquet(f"{folder}/aliases")
    catalog.sparkSession.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.parquet(f"{folder}/layout")


def requests(spark: SparkSession, asked: Iterable[tuple], categories: tuple[str, ...] = CATEGORIES) -> DataFrame:
    """request, query, n, category from (request, query, limit, category) tuples; a SearchError if one cannot be served."""
    rows = []
    for request, query, limit, category in asked:
        text, n = search.checked(query, limit, category, categories)
        rows.append((request, text, n, category))
    return spark.createDataFrame(rows, "request long, query string, n int, category string")


def _few(frame: DataFrame, few: bool) -> DataFrame:
    return F.broadcast(frame) if few else frame


class NameIndex:
    """An index that build() wrote."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.buckets = spark.read.schema("buckets int").parquet(f"{folder}/layout").first()[0]

    def _read(self, table: str, schema: str, keys: DataFrame) -> DataFrame:
        """The rows of a table in the folders that keys (bucket) name."""
        wanted = sorted(r.bucket for r in keys.select("bucket").distinct().collect())  # a number for each folder
        return self.spark.read.schema(f"{schema}, bucket int").parquet(f"{self.folder}/{table}").where(F.col("bucket").isin(wanted))

    def _part_probes(self, asked: DataFrame) -> DataFrame:
        """query, category, start, gram, length of the probes for names that hold the request: its rarest gram, in all lengths."""
        q = F.col("query")
        grams = F.transform(F.sequence(F.lit(1), F.greatest(F.length(q) - 2, F.lit(1))), lambda i: F.substring(q, i, F.lit(3)))
        each = asked.select("query", "category", F.explode(F.array_distinct(grams)).alias("gram"))
        known = self.spark.read.schema("gram string, n long, longest int").parquet(f"{self.folder}/grams")
        # a request of two characters is the beginning of grams
        long, two = each.where(F.length("query") > 2), each.where(F.length("query") == 2)
        counted = long.join(known, "gram", "left").select("query", "category", "gram", "n", "longest")
        rarest = counted.groupBy("query", "category").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram", "longest")).alias("x")).select("query", "category", "x.gram", "x.longest")
        starts = known.groupBy(F.substring("gram", 1, 2).alias("gram")).agg(F.max("longest").alias("longest"))
        rows = rarest.unionByName(two.join(starts, "gram", "left").select("query", "category", "gram", "longest"))
        rows = rows.where(F.col("longest") >= F.length("query"))
        return rows.select("query", "category", F.substring("gram", 1, 2).alias("start"), "gram", F.explode(F.sequence(F.length("query"), F.col("longest"))).alias("length"))

    def _edit_probes(self, asked: DataFrame) -> DataFrame:
        """query, category, start, gram, place, length of the probes for other spellings."""
        q, k = F.col("query"), edits(F.col("query"))
        size = F.length(q)

        def segment(i: Column) -> Column:
            begin, end = F.floor(i * size / (k + 1)).cast("int"), F.floor((i + 1) * size / (k + 1)).cast("int")
            return F.struct(begin.alias("place"), F.substring(q, begin + 1, F.least(end - begin, F.lit(3))).alias("gram"))

        by_length = F.array(F.struct(F.lit(-1).alias("place"), F.lit("").alias("gram")))
        segments = F.when(size >= SHORT, F.transform(F.sequence(F.lit(0), k), segment)).otherwise(by_length)
        rows = asked.select("query", "category", k.alias("k"), F.explode(segments).alias("s"))
        lengths = F.explode(F.sequence(F.greatest(size - k, F.lit(1)), size + k))
        return rows.select("query", "category", "k", F.substring("s.gram", 1, 2).alias("start"), "s.gram", "s.place", lengths.alias("length"))

    def search(self, asked: DataFrame) -> DataFrame:
        """request, id, name, normalized_name, tier, distance: the best n of each request (request, query in normal form, n, category or
        null), by tier, distance, name and id."""
        asked = written(asked.select("request", "query", "n", "category"))
        texts = written(asked.select("query", "category").distinct())
        few = texts.count() <= FEW
        posting = "ids int, normalized_name string, category string, length int, place int, start string, gram string"
        name = F.col("normalized_name")
        key = ["query", "p_category"]
        found = []
        for kind, probes in (("part", self._part_probes(texts)), ("edit", self._edit_probes(texts))):
            probes = written(probes.withColumn("bucket", _bucket(F.col("start"), F.col("length"), self.buckets)))
            rows = self._read("postings", posting, probes).drop("bucket")
            probes = probes.drop("bucket").withColumnsRenamed({"category": "p_category", "start": "p_start", "gram": "p_gram", "length": "p_length", "place": "p_place"})
            meets = (F.col("start") == F.col("p_start")) & (F.col("length") == F.col("p_length")) & F.startswith("gram", "p_gram")
            meets = meets & (F.col("p_category").isNull() | (F.col("category") == F.col("p_category")))
            if kind == "part":
                first = F.col("place") == F.instr(name, F.col("p_gram")) - 1
                met = rows.join(_few(probes, few), meets & first & F.contains(name, F.col("query")))
                tier = F.when(name == F.col("query"), 0).when(F.startswith(name, F.col("query")), 1).otherwise(2)
                found.append(met.select(*key, "normalized_name", "category", "ids", tier.alias("tier")))
            else:
                near = (F.abs(F.col("place") - F.col("p_place")) <= F.col("k")) & ~F.contains(name, F.col("query"))
                met = rows.join(_few(probes, few), meets & near & (F.levenshtein(name, F.col("query")) <= F.col("k")))
                found.append(met.select(*key, "normalized_name", "category", "ids", F.lit(3).alias("tier")).distinct())
        named = self._named(found[0].unionByName(found[1]).withColumn("distance", F.levenshtein("normalized_name", "query")), key)
        found = named.unionByName(self._aliased(texts, few).withColumn("distance", F.levenshtein("normalized_name", "query")))
        best = Window.partitionBy(*key).orderBy("tier", "distance", "normalized_name", "id")
        top = found.withColumn("at", F.row_number().over(best)).where(F.col("at") <= FIRST)
        top = top.groupBy(*key, "id", "normalized_name", "distance").agg(F.min("tier").alias("tier"))
        top = top.withColumn("at", F.row_number().over(best)).where(F.col("at") <= search.MAX_LIMIT)
        top = written(top.withColumn("bucket", _dealt(F.col("id"), self.buckets)))
        names = self._read("names", "id string, name string", top).select("bucket", "id", "name")
        shown = names.join(_few(top, few), ["bucket", "id"]).withColumnRenamed("query", "p_query")
        meets = (F.col("query") == F.col("p_query")) & F.col("category").eqNullSafe(F.col("p_category")) & (F.col("at") <= F.col("n"))
        return asked.join(_few(shown, few), meets).select("request", "id", "name", "normalized_name", "tier", "distance")

    def _named(self, found: DataFrame, key: list[str]) -> DataFrame:
        """key, id, normalized_name, tier, distance: the ids of the names that were found, as long as the names before them leave room."""
        order = Window.partitionBy(*key).orderBy("tier", "distance", "normalized_name")
        ranked = found.withColumn("at", F.rank().over(order)).where(F.col("at") <= FIRST)
        before = F.coalesce(F.sum("ids").over(Window.partitionBy(*key).orderBy("at").rangeBetween(Window.unboundedPreceding, -1)), F.lit(0))
        wanted = written(ranked.withColumn("before", before).where(F.col("before") < FIRST).drop("at", "before", "ids").withColumn("bucket", _dealt(F.col("normalized_name"), self.buckets)))
        ids = self._read("firsts", "id string, normalized_name string, category string", wanted)
        same = [ids["bucket"] == wanted["bucket"], ids["normalized_name"] == wanted["normalized_name"], ids["category"].eqNullSafe(wanted["category"])]
        return wanted.join(ids, same).select(*key, ids["id"], wanted["normalized_name"], "tier", "distance")

    def _aliased(self, texts: DataFrame, few: bool) -> DataFrame:
        """query, p_category, id, normalized_name, tier 0 of the entities that have the request as an alias."""
        keys = texts.withColumn("bucket", _dealt(F.col("query"), self.buckets))
        rows = self._read("aliases", "normalized_alias string, entity_id string", keys).drop("bucket")
        hits = rows.join(_few(keys.drop("bucket"), few), F.col("normalized_alias") == F.col("query"))
        hits = hits.select("query", F.col("entity_id").alias("id"), F.col("category").alias("p_category"))
        hits = written(hits.withColumn("bucket", _dealt(F.col("id"), self.buckets)))
        names = self._read("names", "id string, normalized_name string, category string", hits)
        met = names.join(hits, ["bucket", "id"]).where("p_category is null or category = p_category")
        return met.select("query", "p_category", "id", "normalized_name", F.lit(0).alias("tier"))
