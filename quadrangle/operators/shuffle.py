"""The seeded shuffle, draw for draw what one loop over all rows would do, without that loop.

The generator adds a constant to its state for each draw and then mixes it, so the i-th draw is an expression of i. The shuffle swaps
position i, from the last to the second, with a drawn position j(i) up to i. So what ends at i is what position j(i) held before step i: that
was put there by the step k that drew the same position last, the smallest k above i with j(k) = j(i), and it is what position k held
before step k; without such a step it is the row that began at j(i). And what position k held before its step is, in the same way, what
the smallest m above k with j(m) = k put there. These links point upwards; pointer doubling finds all their ends in as many joins as
the longest chain has binary digits. Chains and groups of equal draws are short, about the logarithm of the number of rows.

Numbers are those of IEEE doubles and 32-bit integers. A state counts exactly up to 2**53, some 4.9 million draws; a generator that keeps
it in a double loses low bits beyond that, this one goes on exactly.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from quadrangle.operators.numbering import numbered
from quadrangle.sources.scratch import written

# Fixed values of the generator.
STEP, WORD = 0x6D2B79F5, 1 << 32


def first_state(seed: str) -> int:
    """The first four bytes of the seed's sha256, lowest first."""
    return int.from_bytes(hashlib.sha256(seed.encode()).digest()[:4], "little")


def _times(a: Column, b: Column) -> Column:
    """The low 32 bits of a product of 32-bit numbers, in 64-bit arithmetic that cannot overflow."""
    high, low = F.shiftrightunsigned(b, 16), b.bitwiseAND(F.lit(0xFFFF))
    return F.pmod(F.pmod(a * high, F.lit(1 << 16)) * (1 << 16) + a * low, F.lit(WORD))


def drawn(state: int, number: Column) -> Column:
    """The draw of that number, from 1, in [0, 1)."""

    def held(value: Column, body) -> Column:
        return F.transform(F.array(value), body)[0]

    def mixed(v: Column) -> Column:
        return _times(v.bitwiseXOR(F.shiftrightunsigned(v, 15)), v.bitwiseOR(F.lit(1)))

    def again(v: Column) -> Column:
        return v.bitwiseXOR(F.pmod(v + _times(v.bitwiseXOR(F.shiftrightunsigned(v, 7)), v.bitwiseOR(F.lit(61))), F.lit(WORD)))

    start = F.pmod(F.lit(state) + number.cast("long") * STEP, F.lit(WORD))
    value = held(held(start, mixed), again)
    return held(value, lambda v: v.bitwiseXOR(F.shiftrightunsigned(v, 14)) / F.lit(float(WORD)))


def permutation(spark: SparkSession, n: int, state: int, skip: int = 0) -> DataFrame:
    """place, origin: what the shuffle of n rows puts at each place, both from 0, when `skip` draws were made before."""
    i = F.col("id")
    steps = spark.range(1, max(n, 1)).select(i.alias("i"), F.floor(drawn(state, skip + n - i) * (i + 1)).alias("j"))
    steps = written(steps.unionByName(spark.range(min(n, 1)).select(i.alias("i"), i.alias("j"))))
    ends = steps.where("j < i").groupBy("j").agg(F.min("i").alias("end")).withColumnRenamed("j", "k")
    moved = 1
    while moved:
        ends, seen = written(ends), Observation()
        further = ends.select(F.col("k").alias("end"), F.col("end").alias("next"))
        ends = written(ends.join(further, "end", "left").select("k", F.coalesce("next", "end").alias("end"), F.col("next").isNotNull().alias("moved")).observe(seen, F.count_if("moved").alias("n")))
        ends, moved = ends.drop("moved"), seen.get["n"]
    later = steps.select("i", "j", F.lead("i").over(Window.partitionBy("j").orderBy("i")).alias("k"))
    return later.join(ends, "k", "left").select(F.col("i").alias("place"), F.coalesce("end", "k", "j").alias("origin"))


def shuffled(rows: DataFrame, order: list[Column | str], seed: str, skip: int = 0, name: str = "place") -> tuple[DataFrame, int]:
    """rows with their place (from 0) after the shuffle of rows in the given total order, and the number of draws made so far."""
    lined = numbered(rows, order, "_from")
    n = lined.count()
    places = permutation(rows.sparkSession, n, first_state(seed), skip).withColumnRenamed("place", name)
    return lined.join(places, F.col("_from") == F.col("origin") + 1).drop("_from", "origin"), skip + max(n - 1, 0)


def balanced(rows: DataFrame, limit: int, seed: str, order: list[Column | str], categories: tuple[str, str] = ("college", "high_school"), key: str = "id") -> DataFrame:
    """limit rows with their `place` from 0: the first half of the limit of each category's shuffle, the rest from a shuffle of all rows
    that are left, then all shuffled; one generator makes all draws in that order."""
    half, skip, parts = limit // len(categories), 0, []
    for number, category in enumerate(categories):
        mixed, skip = shuffled(rows.where(F.col("category") == category), order, seed, skip)
        parts.append(written(mixed.where(F.col("place") < half).withColumn("_part", F.lit(number))))
    chosen = parts[0]
    for more in parts[1:]:
        chosen = chosen.unionByName(more)
    left = rows.join(chosen.select(key), key, "left_anti").select(*rows.columns)
    mixed, skip = shuffled(left, order, seed, skip)
    missing = limit - chosen.count()
    chosen = chosen.unionByName(mixed.where(F.col("place") < missing).withColumn("_part", F.lit(len(categories))))
    chosen = written(chosen.withColumnRenamed("place", "_at"))  # limit rows at most
    mixed, _ = shuffled(chosen, ["_part", "_at"], seed, skip)
    return mixed.select(*rows.columns, "place")
