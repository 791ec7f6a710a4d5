"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree, in DataFrame functions only.

A budget of words is shared by the sources' weights; a source gets at most `most` times its own words, and what it cannot use goes to
the others by weight. A source's documents, in an order that a hash gives, are one run of words that is cut into blocks of
`block_words`. Its target is an exact quota of blocks: whole passes over the source and a part of one more, whose last block is cut so
that the words taken are the rounded target.

* The splitting tree starts with all sources' quotas and halves the output shards: of a node's blocks the left half gets its exact
  share, and how many of them come from each source is drawn from the multivariate hypergeometric distribution, source after source.
  Leaves are shards of about `shard_blocks` blocks. After every `LEVELS` levels the nodes are dealt out anew, so tasks share the tree.
* The blocks of a pass and the draws of a source are permuted by a swap-or-not shuffle: some rounds of arithmetic on the block's
  number, a bijection of any range without sorting. So a block finds its draw, its draw finds its shard, and draws are disjoint.
* Within a shard the blocks are shuffled by a hash.

Scale: texts are read once, for sizes and hashes. Positions in a source are prefix sums over buckets of the hash range (a bucket holds
about `BUCKET` rows of all sources together, so a hot source has as many buckets as it needs), over groups of buckets, and over groups
of groups. A draw meets its shard by an equi-join on ranges of draws. Nothing is collected but the number of rows, words and draws.
The tree's rows grow with shards times sources, at most with the draws: sources without blocks leave a node.

Defined cases: null text is empty and has no words; a document or a source without words takes nothing, its target is 0. A null source
is a source, the last. Rows that repeat doc_id and text have places of their own, though they lie side by side; a bucket holds them as
one row with a count. Rows that share a doc_id are told apart by their text, also with a null doc_id. An empty table has no result.
Columns other than doc_id, text and source are ignored, whatever their names.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadrangle.llm import common as c

WEIGHTS, SHARE, MOST = (3, 1, 2), (3, 2), 2
BLOCK_WORDS, SHARD_BLOCKS, BUCKET, LEVELS = 512, 1024, 2048, 6
WORD = r"[^\x20\x09-\x0D]+"
SEED = 11
#: Above this standard deviation a draw of the tree is made by rejection, in so many tries at most.
WIDE, TRIES = 20, 100
#: The shuffle's arithmetic is modulo a prime below 2**31, so that products fit 63 bits.
PRIME, SHUFFLE_ROUNDS = (1 << 31) - 1, 32


def shuffle_rounds(seed: int) -> list[tuple[int, int, int, int]]:
    """Numbers of each round of a swap-or-not shuffle: a large one and three below PRIME, from a linear congruence."""
    out, x = [], seed
    for _ in range(SHUFFLE_ROUNDS):
        row = []
        for _ in range(5):
            x = (x * 6364136223846793005 + 1442695040888963407) % (1 << 64)
            row.append(x >> 33)
        out.append((row[0] << 31 | row[1], row[2] % PRIME, row[3] % PRIME, row[4] % PRIME))
    return out


def permuted(x: Column, n: Column, salt: Column, seed: int) -> Column:
    """The place of x in a shuffle of 0 to n - 1; salt makes another shuffle."""

    def step(now: Column, r: Column) -> Column:
        other = F.pmod(r["k"] - now, n)

        def swap(m: Column) -> Column:
            v = F.pmod(F.pmod(m, F.lit(PRIME)) * r["a"] + F.pmod(F.floor(m / PRIME) + salt, F.lit(PRIME)) * r["b"], F.lit(PRIME))
            w = F.pmod(v * v + r["c"], F.lit(PRIME))
            return F.pmod(F.shiftright(F.pmod(w * w + v, F.lit(PRIME)), 7), F.lit(2)) == 1

        return F.when(swap(F.greatest(now, other)), other).otherwise(now)

    rounds = F.array(*(F.struct(*(F.lit(v).cast("long").alias(k) for k, v in zip("kabc", r, strict=True))) for r in shuffle_rounds(seed)))
    return F.aggregate(rounds, x.cast("long"), step)


# ---------------------------------------------------------------- sizes and targets


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def _order() -> Column:
    """60 bits of a hash of doc_id and text: a document's place among its source's."""
    name = F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), _text())
    return F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 15), 16, 10).cast("long").alias("h")


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size (words), h (60 bits of a hash of doc_id and text), m (rows alike)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.regexp_count(_text(), F.lit(WORD)).cast("long").alias("size"), _order())
    return rows.groupBy("doc_id", "source", "size", "h").agg(F.count("*").alias("m"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: tuple[int, int] = SHARE, most: int = MOST) -> DataFrame:
    """source, s (its number by code point, null last), source_size, target.

    The sources that stop at their limit are those with the smallest limit for their weight. With sources in that order the words left
    for a weight of one do not fall from source to source until none is above its limit, so each source's share follows from sums over
    those before it. One row for each source meets in a window."""
    words = F.sum(F.col("size") * F.col("m")).alias("source_size")
    every = Window.orderBy(F.asc_nulls_last("source"))
    n = F.row_number().over(every) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(n, F.lit(len(weights))) + 1).cast("int")).cast("long")
    rows = sizes.groupBy("source").agg(words).select("source", n.cast("long").alias("s"), "source_size", weight.alias("w"))
    by_limit = Window.orderBy(F.col("source_size") / F.col("w"), "s")
    before, after = by_limit.rowsBetween(Window.unboundedPreceding, -1), by_limit.rowsBetween(0, Window.unboundedFollowing)
    rows = rows.select(
        "*",
        F.sum("source_size").over(Window.partitionBy()).alias("all"),
        F.coalesce(F.sum("source_size").over(before), F.lit(0)).alias("used"),
        F.sum("w").over(after).alias("weights"),
        F.row_number().over(by_limit).alias("i"),
    )
    up, down = share
    left = up * F.col("all") - down * most * F.col("used")  # in parts of 1 / down
    full = (down * most * F.col("source_size")).cast("double") * F.col("weights") <= left.cast("double") * F.col("w")
    rows = rows.select("source", "s", "source_size", "w", "i", left.alias("left"), "weights", full.alias("full"))
    free = F.min(F.when(~F.col("full"), F.struct("i", "left", "weights"))).over(Window.partitionBy())
    rows = rows.select("*", free.alias("free"))
    share_of = (F.col("free.left") * F.col("w")).cast("double") / (down * F.col("free.weights")).cast("double")
    limit = (most * F.col("source_size")).cast("double")
    target = F.when(F.col("free").isNull() | (F.col("i") < F.col("free.i")), limit).otherwise(F.least(share_of, limit))
    return rows.select("source", "s", "source_size", target.alias("target"))


# ---------------------------------------------------------------- blocks and draws


def placed(rows: DataFrame, sources: DataFrame, n_rows: int) -> DataFrame:
    """doc_id, h, size, m, s and `begin`: the words of the source that lie before the row's, in the order of h, doc_id."""
    buckets = max(1, n_rows // BUCKET)
    at = F.least(F.floor(F.col("h") / F.lit(float(1 << 60)) * buckets), F.lit(buckets - 1)).cast("long")
    with_source = rows.join(sources.select(F.col("source").alias("t_source"), "s"), F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source", "source")
    keyed = with_source.where("size > 0").withColumn("b0", at)

    def prefix(frame: DataFrame, keys: list[str], order: list[str], words: Column, name: str) -> DataFrame:
        before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return frame.withColumn(name, F.coalesce(F.sum(words).over(before), F.lit(0)))

    words = F.col("size") * F.col("m")
    sums = keyed.groupBy("s", "b0").agg(F.sum(words).alias("n0")).withColumn("b1", F.floor(F.col("b0") / BUCKET))
    wider = sums.groupBy("s", "b1").agg(F.sum("n0").alias("n1"))
    start = prefix(sums, ["s", "b1"], ["b0"], F.col("n0"), "p0").join(prefix(wider, ["s"], ["b1"], F.col("n1"), "p1"), ["s", "b1"])
    start = start.select("s", "b0", (F.col("p0") + F.col("p1")).alias("start"))
    inside = prefix(keyed, ["s", "b0"], ["h", "doc_id"], words, "p")
    return inside.join(start, ["s", "b0"]).select("doc_id", "h", "size", "m", "s", (F.col("start") + F.col("p")).alias("begin"))


def quotas(sources: DataFrame, block_words: int) -> DataFrame:
    """sources with blocks (of one pass), passes (whole ones), part (blocks drawn of one more), last_words (taken of its last block) and
    draws (all blocks)."""
    words = F.round("target").cast("long")
    rows = sources.where("source_size > 0").select("s", "source_size", words.alias("words"), F.ceil(F.col("source_size") / block_words).cast("long").alias("blocks"))
    rows = rows.withColumn("passes", F.floor(F.col("words") / F.col("source_size")).cast("long"))
    rows = rows.withColumn("rest", F.col("words") - F.col("passes") * F.col("source_size"))
    # the source's last block is short; where it is drawn, blocks from its rank on reach fewer words
    short = F.col("blocks") * block_words - F.col("source_size")
    rows = rows.select("*", short.alias("short"), permuted(F.col("blocks") - 1, F.col("blocks"), F.col("s"), SEED).alias("rank_of_short"))
    early = F.col("rest") > F.col("rank_of_short") * block_words  # it is drawn
    reach = F.col("rest") + F.when(early, F.col("short")).otherwise(0)
    part = F.greatest(F.ceil(reach / block_words).cast("long"), F.when(early, F.col("rank_of_short") + 1).otherwise(0))
    rows = rows.withColumn("part", part)
    before = (F.col("part") - 1) * block_words - F.when(F.col("rank_of_short") < F.col("part") - 1, F.col("short")).otherwise(0)
    return rows.withColumn("last_words", F.when(F.col("part") > 0, F.col("rest") - before).otherwise(0)).withColumn("draws", F.col("passes") * F.col("blocks") + F.col("part"))


def drawn(placed_rows: DataFrame, quota: DataFrame, block_words: int) -> DataFrame:
    """doc_id, h, m, s, copy, from_word, n_words, slot: the pieces of documents in all draws; slot is the draw's place among the source's."""
    rows = placed_rows.select("doc_id", "h", "size", "s", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1)).alias("copy"), (F.col("begin") + F.col("copy") * F.col("size")).alias("begin"))
    end = F.col("begin") + F.col("size")
    first, last = F.floor(F.col("begin") / block_words).cast("long"), F.floor((end - 1) / block_words).cast("long")
    rows = rows.select("doc_id", "h", "s", "copy", "begin", end.alias("end"), F.explode(F.sequence(first, last)).alias("block"))
    rows = rows.join(quota.select("s", "blocks", "passes", "part", "last_words", "draws"), "s")
    low = F.col("block") * block_words
    rows = rows.select("*", F.greatest("begin", low).alias("lo"), F.least("end", low + block_words).alias("hi"), (low + F.col("last_words")).alias("cut"))
    rows = rows.withColumn("rank", F.when(F.col("part") > 0, permuted(F.col("block"), F.col("blocks"), F.col("s"), SEED)))
    rows = rows.withColumn("pass", F.explode(F.sequence(F.lit(0).cast("long"), F.col("passes"))))
    whole = F.col("pass") < F.col("passes")
    hi = F.when(whole | (F.col("rank") < F.col("part") - 1), F.col("hi")).when(F.col("rank") == F.col("part") - 1, F.least("hi", "cut"))
    rows = rows.withColumn("hi", hi).where("hi > lo")
    draw = F.col("pass") * F.col("blocks") + F.when(whole, F.col("block")).otherwise(F.col("rank"))
    slot = permuted(draw, F.col("draws"), F.col("s"), SEED + 1)
    return rows.select("doc_id", "h", "s", "copy", (F.col("lo") - F.col("begin")).alias("from_word"), (F.col("hi") - F.col("lo")).alias("n_words"), "draws", slot.alias("slot"))


# ---------------------------------------------------------------- the splitting tree


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once."""
    return F.transform(F.array(value), body)[0]


def log_factorial(n: Column) -> Column:
    """ln n! by Stirling's series, eight steps further out."""
    z = n.cast("double") + 9
    shift = F.ln(functools.reduce(lambda a, b: a * b, (n.cast("double") + i for i in range(1, 9))))
    series = 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * z * z * z * z * z)
    return (z - 0.5) * F.ln(z) - z + 0.9189385332046727 + series - shift


def hypergeometric(total: Column, good: Column, taken: Column, key: Column) -> Column:
    """How many of `taken` draws without replacement from total, of which good are good, are good; key (a bigint) decides the draw.

    Up to a standard deviation of `WIDE` by inversion: the distribution function is summed over 12 deviations and 12 on either side of
    the mode. Beyond that by rejection from a ratio of uniforms, whose hat lies over every hypergeometric distribution: a try is accepted
    with a probability over one half, so that `TRIES` tries fail about once in 10**30 draws, which then take the mode."""

    def uniform(i: Column | int) -> Column:
        return (F.pmod(F.xxhash64(key, F.lit(i) if isinstance(i, int) else i), F.lit(1 << 52)) + 0.5) / float(1 << 52)

    def draw(a: Column) -> Column:
        n, k, t = a["n"], a["k"], a["t"]
        share = k / F.greatest(n, F.lit(1))
        spread = F.sqrt(F.greatest(t * share * (1 - share) * (n - t) / F.greatest(n - 1, F.lit(1)), F.lit(0.0)))
        mode = F.floor((t + 1) * ((k + 1) / (n + 2)))
        reach = F.ceil(12 * spread + 12)
        least, most = F.greatest(F.lit(0).cast("long"), t - (n - k)), F.least(t, k)

        def sum_of_logs(*x: Column) -> Column:
            return F.aggregate(F.transform(F.array(*x), log_factorial), F.lit(0.0), lambda s, v: s + v)

        def log_ways(x: Column) -> Column:
            return -sum_of_logs(x, k - x, t - x, n - k - t + x)

        def inverted(b: Column) -> Column:
            first = F.exp(sum_of_logs(k, n - k, t, n - t) - sum_of_logs(n, b["lo"], k - b["lo"], t - b["lo"], n - k - t + b["lo"]))
            start = F.struct(first.alias("p"), F.lit(0.0).alias("sum"), b["lo"].alias("x"), uniform(0).alias("u"))

            def step(s: Column, i: Column) -> Column:
                done = s["sum"] + s["p"]
                after = s["p"] * ((k - i) * (t - i)).cast("double") / ((i + 1) * (n - k - t + i + 1)).cast("double")
                next_x = F.when((done <= s["u"]) & (i < b["hi"]), i + 1).otherwise(s["x"])
                return F.struct(F.when(i < b["hi"], after).otherwise(F.lit(0.0)).alias("p"), done.alias("sum"), next_x.alias("x"), s["u"].alias("u"))

            return F.aggregate(F.sequence(b["lo"], b["hi"]), start, step, lambda s: s["x"])

        def rejected(b: Column) -> Column:
            """b: hat (its width), top (the logarithm at the mode)."""

            def attempt(i: Column) -> Column:
                x = F.floor(t * share + 0.5 + b["hat"] * (uniform(2 * i + 1) - 0.5) / uniform(2 * i)).cast("long")
                inside = (x >= least) & (x <= most)
                return _let(x, lambda v: F.when(inside, F.when(2 * F.ln(uniform(2 * i)) <= log_ways(v) - b["top"], v)))

            tries = F.sequence(F.lit(0), F.lit(TRIES - 1))
            return F.coalesce(F.aggregate(tries, F.lit(None).cast("long"), lambda found, i: F.when(found.isNotNull(), found).otherwise(attempt(i))), b["mode"])

        narrow = F.struct(F.greatest(least, (mode - reach).cast("long")).alias("lo"), F.least(most, (mode + reach).cast("long")).alias("hi"))
        # the width of the hat: 2 * sqrt(2 / e) deviations, and 3 - 2 * sqrt(3 / e)
        wide = F.struct((1.7155277699214135 * F.sqrt(spread * spread + 0.5) + 0.8989161620588988).alias("hat"), log_ways(mode.cast("long")).alias("top"), mode.cast("long").alias("mode"))
        return F.when(least == most, least).when(spread <= WIDE, _let(narrow, inverted)).otherwise(_let(wide, rejected))

    args = F.struct(total.cast("long").alias("n"), good.cast("long").alias("k"), taken.cast("long").alias("t"))
    return _let(args, draw)


def _halves(first: Column, shards: Column, counts: Column, all_draws: int, n_shards: int) -> Column:
    """A node's two halves: an array of structs first, shards, counts (source s, n); a node of one shard is its only half."""
    left = F.floor(shards / 2).cast("long")

    def bound(shard: Column) -> Column:
        return F.floor(shard.cast("decimal(38,0)") * all_draws / n_shards).cast("long")

    share = bound(first + left) - bound(first)

    def draw(state: Column, x: Column) -> Column:
        got = hypergeometric(state["all"], x["n"], state["left"], F.xxhash64(first, shards, x["s"], F.lit(SEED)))
        return _let(got, lambda g: F.struct((state["all"] - x["n"]).alias("all"), (state["left"] - g).alias("left"), F.concat(state["out"], F.array(g)).alias("out")))

    everything = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x["n"])
    start = F.struct(everything.alias("all"), share.alias("left"), F.array().cast("array<bigint>").alias("out"))
    mine = F.aggregate(counts, start, draw, lambda s: s["out"])

    def half(begin: Column, size: Column, part: Column) -> Column:
        return F.struct(begin.alias("first"), size.alias("shards"), F.filter(part, lambda x: x["n"] > 0).alias("counts"))

    def both(g: Column) -> Column:
        a = F.zip_with(counts, g, lambda x, n: F.struct(x["s"].alias("s"), n.alias("n")))
        b = F.zip_with(counts, g, lambda x, n: F.struct(x["s"].alias("s"), (x["n"] - n).alias("n")))
        return F.array(half(first, left, a), half(first + left, shards - left, b))

    return F.when(shards > 1, _let(mine, both)).otherwise(F.array(half(first, shards, counts)))


def splitting_tree(own: c.Scratch, quota: DataFrame, all_draws: int, n_shards: int) -> DataFrame:
    """shard, s, n: the blocks that each shard gets of each source; a shard's sum is its exact share of all draws."""
    rows = quota.where("draws > 0").select("s", F.col("draws").alias("n"))
    counts = F.array_sort(F.collect_list(F.struct("s", "n")))  # one entry for each source
    tree = rows.agg(counts.alias("counts")).select(F.lit(0).cast("long").alias("first"), F.lit(n_shards).cast("long").alias("shards"), "counts")
    half = F.explode(_halves(F.col("first"), F.col("shards"), F.col("counts"), all_draws, n_shards)).alias("half")
    for level in range((n_shards - 1).bit_length()):
        if level and level % LEVELS == 0:  # tasks share the nodes from here on
            tree = own.cut(tree.repartition("first"))
        tree = tree.select(half).select("half.*")
    return tree.select(F.col("first").alias("shard"), F.explode("counts").alias("x")).select("shard", "x.s", "x.n")


def dealt(own: c.Scratch, pieces: DataFrame, tree: DataFrame, n_shards: int) -> DataFrame:
    """pieces with their shard. A source's slots are its shards' counts laid end to end; both sides meet on ranges of as many slots as a
    shard has on average, so that a piece meets few shards."""
    before = Window.partitionBy("s").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = own.cut(tree)
    groups = shards.withColumn("g", F.floor(F.col("shard") / BUCKET))
    coarse = groups.groupBy("s", "g").agg(F.sum("n").alias("n")).select(F.col("s").alias("c_s"), F.col("g").alias("c_g"), F.coalesce(F.sum("n").over(Window.partitionBy("s").orderBy("g").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    fine = groups.withColumn("low", F.coalesce(F.sum("n").over(Window.partitionBy("s", "g").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    laid = fine.join(coarse, (F.col("s") == F.col("c_s")) & (F.col("g") == F.col("c_g"))).select("s", "shard", (F.col("base") + F.col("low")).alias("low"), (F.col("base") + F.col("low") + F.col("n")).alias("high"))
    width = shards.groupBy("s").agg(F.sum("n").alias("draws")).select("s", F.greatest(F.lit(1), F.ceil(F.col("draws") / n_shards)).cast("long").alias("width"))
    laid = laid.join(width, "s").withColumn("r", F.explode(F.sequence(F.floor(F.col("low") / F.col("width")), F.floor((F.col("high") - 1) / F.col("width")))))
    laid = laid.select(F.col("s").alias("l_s"), F.col("r").alias("l_r"), "shard", "low", "high")
    r = F.floor(F.col("slot") / F.greatest(F.lit(1), F.ceil(F.col("draws") / n_shards)))
    met = pieces.withColumn("r", r).join(laid, (F.col("s") == F.col("l_s")) & (F.col("r") == F.col("l_r")) & F.expr("slot >= low and slot < high"))
    return met.drop("l_s", "l_r", "r", "low", "high", "draws")


class Mix:
    """The plan of a mix: `sizes` (doc_id, source, size, h, m), `sources` (source, s, source_size, target) and `pieces` (doc_id, h, s, copy,
    from_word, n_words, slot, shard)."""

    def __init__(self, docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: tuple[int, int] = SHARE, most: int = MOST, block_words: int = BLOCK_WORDS, shard_blocks: int = SHARD_BLOCKS):
        self.own = own = c.Scratch(docs.sparkSession)
        self.docs = docs
        self.sizes, seen = own.measured(sized(docs))
        self.sources = own.cut(targets(self.sizes, weights, share, most))
        quota, found = own.measured(quotas(self.sources, block_words), F.coalesce(F.sum("draws"), F.lit(0)).alias("draws"))
        self.n_shards = max(1, -(-found["draws"] // shard_blocks))
        tree = splitting_tree(own, quota, found["draws"], self.n_shards)
        self.pieces = dealt(own, drawn(placed(self.sizes, self.sources, seen["n"]), quota, block_words), tree, self.n_shards)

    def rows(self) -> DataFrame:
        """shard, place, doc_id, source, from_word, n_words, text: the mix itself. A piece that is not a whole text is its words with one
        space between them. place is the order within the shard: blocks shuffled, a block's pieces together."""
        texts = self.docs.select(F.col("doc_id").cast("long").alias("doc_id"), _order(), _text().alias("text")).dropDuplicates(["doc_id", "h"])
        pieces = self.pieces.join(self.sources.select("s", "source"), "s").withColumnsRenamed({"doc_id": "p_doc_id", "h": "p_h"})
        met = pieces.join(texts, F.col("p_doc_id").eqNullSafe(F.col("doc_id")) & (F.col("p_h") == F.col("h")))
        words = F.regexp_extract_all("text", F.lit(WORD), 0)
        part = _let(words, lambda w: F.when((F.col("from_word") == 0) & (F.col("n_words") == F.size(w)), F.col("text")).otherwise(F.array_join(F.slice(w, (F.col("from_word") + 1).cast("int"), F.col("n_words").cast("int")), " ")))
        place = F.row_number().over(Window.partitionBy("shard").orderBy(F.xxhash64("s", "slot", F.lit(SEED)), "s", "slot", "h", "doc_id", "copy"))
        return met.select("shard", place.alias("place"), "doc_id", "source", "from_word", "n_words", part.alias("text"))

    def taken(self) -> DataFrame:
        """doc_id, size, source_size, target, taken for every row of docs."""
        n = self.pieces.groupBy("doc_id", "h", "s", "copy").agg(F.sum("n_words").alias("taken")).withColumnsRenamed({"doc_id": "p_doc_id", "h": "p_h", "s": "p_s", "copy": "p_copy"})
        rows = self.sizes.join(self.sources.withColumnRenamed("source", "t_source"), F.col("source").eqNullSafe(F.col("t_source")))
        rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1)))
        met = rows.join(n, F.col("doc_id").eqNullSafe(F.col("p_doc_id")) & (F.col("h") == F.col("p_h")) & (F.col("s") == F.col("p_s")) & (F.col("copy") == F.col("p_copy")), "left")
        return met.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
