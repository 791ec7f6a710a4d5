"""The name index, the bucketed store with its version log, and the seeded shuffle."""

import random
import threading
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quadrangle.operators import name_index, search, shuffle, store, upsert
from quadrangle.plans.catalog_queries import parts_as_institutions
from quadrangle.sources.versions import Conflict, VersionLog

# ---------------------------------------------------------------- name index

WORDS = "boston university lincoln high school of the saint mary college north central état institute for arts a ii".split()


def names(n, seed=1):
    rnd = random.Random(seed)
    rows = [" ".join(rnd.choice(WORDS) for _ in range(rnd.choice((1, 2, 3, 4, 6)))) for _ in range(n)]
    return [*rows, "a", "ab", "abc", "abcd", "abcde", "aaaaaaaa", "aa", "ababab", "\U0001f600 hall", ""]


def misspelt(rnd, name):
    chars = list(name)
    for _ in range(rnd.randint(0, len(chars) // 4 + 1)):
        at = rnd.randrange(len(chars) + 1)
        chars[at : at + rnd.randint(0, 1)] = rnd.choice(["", "x", "e", "un"])
    return "".join(chars)[: rnd.choice((3, 8, 60, 60))]


@pytest.fixture(scope="module")
def indexed(spark, tmp_path_factory):
    rows = [(f"i{i}", n.title(), n, ("college", "high_school")[i % 2]) for i, n in enumerate(names(1500))]
    catalog = spark.createDataFrame(rows, "id string, name string, normalized_name string, category string").cache()
    aliases = spark.createDataFrame([("i3", "bu"), ("i4", "bu"), ("i5", "boston university"), ("none", "bu")], "entity_id string, normalized_alias string")
    folder = str(tmp_path_factory.mktemp("index") / "x")
    name_index.build(catalog, folder, aliases, buckets=64)
    return catalog, aliases, name_index.NameIndex(spark, folder), folder


def test_a_thousand_requests_in_one_search(spark, indexed):
    catalog, aliases, index, _ = indexed
    rnd, known = random.Random(2), names(1500)
    texts = ["bu", "boston university", "ab", "abc", "aaaa", "état", "hall", "zzzz", "of", "\U0001f600 hall"]
    while len(texts) < 1000:
        text = " ".join(misspelt(rnd, rnd.choice(known)).split())
        if len(text) >= search.MIN_QUERY:
            texts.append(text)
    asked = spark.createDataFrame([(i, t, rnd.choice((1, 10, 25)), rnd.choice((None, None, "college"))) for i, t in enumerate(texts)], "request long, query string, n int, category string")
    got = sorted(map(tuple, index.search(asked).collect()))
    # the same verdicts over all pairs of requests and names
    hits = aliases.withColumnsRenamed({"entity_id": "id", "normalized_alias": "query"}).withColumn("alias", F.lit(True))
    pairs = asked.crossJoin(catalog.withColumnRenamed("category", "kind")).where("category is null or category = kind").join(hits, ["id", "query"], "left")
    name, q = F.col("normalized_name"), F.col("query")
    tier = F.when(F.col("alias") | (name == q), 0).when(F.startswith(name, q), 1).when(F.contains(name, q), 2).when(F.levenshtein(name, q) <= F.greatest(F.lit(1), F.floor(F.length(q) / 4)), 3)
    found = pairs.withColumns({"tier": tier, "distance": F.levenshtein(name, q)}).where("tier is not null and normalized_name <> ''")
    found = found.selectExpr("*", "row_number() over (partition by request order by tier, distance, normalized_name, id) as at").where("at <= n")
    assert got == sorted(map(tuple, found.select("request", "id", "name", "normalized_name", "tier", "distance").collect()))
    assert {r[4] for r in got} == {0, 1, 2, 3} and len({r[0] for r in got}) > 700


def test_the_index_read_is_pruned(spark, indexed):
    _, _, index, folder = indexed
    asked = name_index.requests(spark, [(1, "Linclon High!", 5, None)])
    probes = index._edit_probes(asked).withColumn("bucket", name_index._bucket(F.col("start"), F.col("length"), index.buckets))
    rows = index._read("postings", "id string, normalized_name string, category string, length int, place int, start string, gram string", probes)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    folders = len(list(Path(folder, "postings").glob("bucket=*")))
    assert folders > 40 and 0 < rows.select("_metadata.file_path").distinct().count() < folders / 2
    assert {r.name for r in index.search(asked).collect()} >= {"Lincoln High"}
    with pytest.raises(search.SearchError):
        name_index.requests(spark, [(1, "x", None, None)])


def test_same_rows_as_the_scan(spark, sf_dir, tmp_path):
    catalog = parts_as_institutions(spark, sf_dir)
    aliases = spark.read.parquet(f"{sf_dir}/part.parquet").where("p_brand = 'Brand#2'").select(F.col("p_partkey").cast("string").alias("entity_id"), F.lit("b2").alias("normalized_alias"))
    name_index.build(catalog, str(tmp_path / "x"), aliases)
    asked = [(0, "Small  Ring!", 25, None), (1, "BLUE", None, "ECONOMY"), (2, "smal rng", 25, None), (3, "B2", 25, None), (4, "ri", 3, None), (5, "no such name", 3, None)]
    index = name_index.NameIndex(spark, str(tmp_path / "x"))
    got = index.search(name_index.requests(spark, asked, ("ECONOMY",))).collect()
    for request, query, limit, category in asked:
        wanted = search.search(catalog, query, limit, category, aliases=aliases, categories=("ECONOMY",)).collect()
        mine = sorted((tuple(r)[1:] for r in got if r.request == request), key=lambda r: (r[3], r[4], r[2], r[0]))
        assert mine == [tuple(r) for r in wanted]


def test_an_empty_index(spark, tmp_path):
    none = spark.createDataFrame([], "id string, name string, normalized_name string, category string")
    name_index.build(none, str(tmp_path / "x"))
    assert name_index.NameIndex(spark, str(tmp_path / "x")).search(name_index.requests(spark, [(1, "boston", None, None)])).count() == 0


def test_a_name_and_a_request_of_many_are_met_once(spark, tmp_path):
    rows = [(f"i{i:04}", "Lincoln High", "lincoln high", ("college", "high_school")[i % 2]) for i in range(600)]
    catalog = spark.createDataFrame([*rows, ("j", "Lincoln Hig", "lincoln hig", "college")], "id string, name string, normalized_name string, category string")
    aliases = spark.createDataFrame([(f"i{i:04}", "lincoln high") for i in range(580, 600)] + [("i0001", "lincoln hgh"), ("j", "lincoln high")], "entity_id string, normalized_alias string")
    folder = str(tmp_path / "x")
    name_index.build(catalog, folder, aliases)
    assert spark.read.parquet(f"{folder}/postings").groupBy("normalized_name", "category", "place").count().where("count > 1").count() == 0
    asked = spark.createDataFrame([(i, ("lincoln high", "lincoln hgh")[i % 2], 25, (None, "college")[i // 2 % 2]) for i in range(40)], "request long, query string, n int, category string")
    got = name_index.NameIndex(spark, folder).search(asked).collect()
    for i in range(40):
        mine = [r.id for r in sorted((r for r in got if r.request == i), key=lambda r: (r.tier, r.distance, r.normalized_name, r.id))]
        college = i // 2 % 2
        ids = [f"i{x:04}" for x in range(0, 600, 1 + college)]
        if i % 2 and not college:
            ids = ["i0001", "i0000", *ids[2:]]
        assert mine == ids[:25]


# ---------------------------------------------------------------- bucketed store


def rows_of(spark, n, value=""):
    return spark.range(n).select(F.concat(F.lit("i"), "id").alias("id"), F.lit("S").alias("source"), F.col("id").cast("string").alias("source_id"), F.lit(value).alias("logo_key"), F.lit(None).cast("string").alias("website"))


def new_store(spark, tmp_path, n=5000, buckets=512):
    return store.Store.create(rows_of(spark, n), str(tmp_path / "t"), ["source", "source_id"], buckets)


def folders(held, version):
    return held.log.read(version)["folders"]


def test_a_small_write_touches_few_buckets(spark, tmp_path):
    held = new_store(spark, tmp_path)
    files = {p for p in Path(held.folder).rglob("*.parquet")}
    changed = spark.range(200).select(F.lit("S").alias("source"), (F.col("id") * 7).cast("string").alias("source_id"), F.lit("new").alias("v"))

    def change(rows):
        return rows.join(changed, ["source", "source_id"], "left").withColumn("logo_key", F.coalesce("v", "logo_key"))

    touched = held.buckets_of(changed)
    assert held.commit(lambda _: touched, change) == 2
    before, after = folders(held, 1), folders(held, 2)
    assert {b for b in after if after[b] != before[b]} == set(map(str, touched)) and len(touched) <= 200
    more = {p for p in Path(held.folder).rglob("*.parquet")} - files
    assert len({p.parent for p in more}) == len(touched) and files <= {p for p in Path(held.folder).rglob("*.parquet")}
    assert held.read().where("logo_key = 'new'").count() == 200 and held.read().count() == 5000
    assert held.read(version=1).where("logo_key = 'new'").count() == 0
    assert len(held.read(only=touched).inputFiles()) < len(held.read().inputFiles())


def test_the_first_value_stays_and_merges_delete(spark, tmp_path):
    held = new_store(spark, tmp_path, 100, 16)
    first = spark.createDataFrame([("i1", "a"), ("i2", "b"), ("nobody", "c")], "id string, logo_key string")
    store.fill_blank(held, first, "logo_key")
    store.fill_blank(held, first.withColumn("logo_key", F.lit("late")), "logo_key")
    assert {r.id: r.logo_key for r in held.read().where("logo_key <> ''").collect()} == {"i1": "a", "i2": "b"}
    merged = spark.createDataFrame([("i5", "https://m.org/")], "id string, website string")
    store.apply_merges(held, merged, spark.createDataFrame([("i6",), ("i7",)], "id string"))
    assert held.read().count() == 98 and held.read().where("website is not null").first().id == "i5"
    everything = held.read().select("id")
    store.apply_merges(held, merged.limit(0), everything)
    assert held.read().count() == 0 and held.read(version=1).count() == 100
    with pytest.raises(Conflict):
        new_store(spark, tmp_path, 10, 4)


def test_two_writers_lose_nothing_and_readers_never_fail(spark, tmp_path):
    held = new_store(spark, tmp_path, 300, 3)  # three buckets: the writers meet in each
    errors, done, seen = [], threading.Event(), []

    def write(who):
        try:
            mine = store.Store(spark, held.folder)
            for i in range(4):
                rows = spark.range(20).select(F.concat(F.lit("i"), (F.col("id") + 20 * i + 100 * who).cast("string")).alias("id"), F.lit(f"w{who}").alias("logo_key"))
                store.fill_blank(mine, rows, "logo_key")
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    def read():
        while not done.is_set():
            try:
                seen.append((held.read().count(), held.read().where("logo_key <> ''").count()))
            except Exception as e:  # noqa: BLE001
                errors.append(e)
            time.sleep(0.05)

    threads = [threading.Thread(target=write, args=(w,)) for w in (0, 1)]
    reader = threading.Thread(target=read)
    for t in (*threads, reader):
        t.start()
    for t in threads:
        t.join()
    done.set()
    reader.join()
    assert not errors
    assert held.version() == 9
    assert {r.logo_key: r["count"] for r in held.read().where("logo_key <> ''").groupBy("logo_key").count().collect()} == {"w0": 80, "w1": 80}
    assert seen and all(n == 300 for n, _ in seen) and [m for _, m in seen] == sorted(m for _, m in seen)


def test_a_change_beside_another_is_not_made_again(spark, tmp_path):
    held = new_store(spark, tmp_path, 200, 8)
    mine, other = held.buckets_of(rows_of(spark, 1)), None
    for i in range(1, 50):
        other = held.buckets_of(rows_of(spark, i + 1).where(f"source_id = '{i}'"))
        if other != mine:
            break
    runs = []

    def change(rows):
        runs.append(len(runs))
        if len(runs) == 1:  # another writer is faster, in another bucket
            held.commit(lambda _: other, lambda r: r.withColumn("website", F.lit("other")))
        return rows.withColumn("website", F.lit("mine"))

    held.commit(lambda _: mine, change)
    assert runs == [0] and {r.website for r in held.read().collect()} == {None, "mine", "other"}
    # and in the same bucket: the change runs again on what the other has written
    runs.clear()

    def again(rows):
        runs.append(len(runs))
        if len(runs) == 1:
            held.commit(lambda _: mine, lambda r: r.withColumn("logo_key", F.lit("faster")))
        return rows.withColumn("website", F.concat("logo_key", F.lit("!")))

    held.commit(lambda _: mine, again)
    assert runs == [0, 1] and held.read(only=mine).select("website").distinct().first().website == "faster!"
    with pytest.raises(ValueError, match="buckets"):
        held.commit(lambda _: mine, lambda r: r.withColumn("source_id", F.lit("x9")).unionByName(r))


def test_versions_are_exclusive(spark, tmp_path):
    log, won = VersionLog(spark, str(tmp_path / "a b")), []

    def take(who):
        try:
            VersionLog(spark, str(tmp_path / "a b")).append(1, {"who": who})
            won.append(who)
        except Conflict:
            pass

    assert log.latest() == 0
    threads = [threading.Thread(target=take, args=(w,)) for w in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) == 1 and log.latest() == 1 and log.read(1) == {"who": won[0]}
    snapshot = spark.createDataFrame([("college", "a")], "category string, normalized_name string")
    assert upsert.publish(snapshot, str(tmp_path / "s")) == 1 and upsert.publish(snapshot.limit(0), str(tmp_path / "s"), based_on=1) == 2
    with pytest.raises(Conflict):
        upsert.publish(snapshot, str(tmp_path / "s"), based_on=1)
    assert upsert.current(spark, str(tmp_path / "s")).count() == 0


# ---------------------------------------------------------------- seeded shuffle


class Sequential:
    """The generator and the shuffle as one loop."""

    def __init__(self, seed):
        self.state = shuffle.first_state(seed)

    def draw(self):
        mask = 0xFFFFFFFF
        self.state += 0x6D2B79F5
        v = self.state & mask
        v = ((v ^ (v >> 15)) * (v | 1)) & mask
        v ^= (v + (((v ^ (v >> 7)) * (v | 61)) & mask)) & mask
        return (v ^ (v >> 14)) / 4294967296

    def shuffled(self, rows):
        rows = list(rows)
        for i in range(len(rows) - 1, 0, -1):
            j = int(self.draw() * (i + 1))
            rows[i], rows[j] = rows[j], rows[i]
        return rows


@pytest.mark.parametrize(("seed", "n"), [("a", 0), ("a", 1), ("b", 2), ("c", 3), ("", 50), ("x", 4000), ("y", 4001)])
def test_shuffle_like_one_loop(spark, seed, n):
    one = Sequential(seed)
    skip = len(seed) * 11
    for _ in range(skip):
        one.draw()
    got = sorted(map(tuple, shuffle.permutation(spark, n, shuffle.first_state(seed), skip).collect()))
    assert got == list(enumerate(one.shuffled(range(n))))


@pytest.mark.parametrize(("limit", "seed"), [(10, "s"), (7, "t"), (500, "u")])
def test_balanced_like_one_loop(spark, limit, seed):
    rows = [(i, "college" if i % 7 == 0 else "high_school" if i % 3 else "other") for i in range(200)]
    one = Sequential(seed)
    half = limit // 2
    chosen = [r for c in ("college", "high_school") for r in one.shuffled(x for x in rows if x[1] == c)[:half]]
    rest = one.shuffled(x for x in rows if x not in chosen)
    wanted = one.shuffled(chosen + rest[: limit - len(chosen)])
    frame = spark.createDataFrame(rows, "id long, category string").repartition(5)
    got = shuffle.balanced(frame, limit, seed, ["id"]).orderBy("place").collect()
    assert [(r.id, r.category) for r in got] == wanted and [r.place for r in got] == list(range(len(wanted)))
