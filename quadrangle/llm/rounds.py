"""Links within buckets by rounds of leaders, so that the pairs of a bucket are not all made.

Members of a bucket (rows that share a key) may be linked. First every member is compared with the best leader of all its
buckets. Then within a bucket every member is compared with MORE leaders, then with MORE times as many in each round, until all
that is left of the bucket is one component. No pair that could join two components goes untested, so components are those of
all links. A leader is the member with the largest score, usually the original of a group of altered copies. Pairs that a
caller's condition rules out never leave the join. Before a round would compare more than CROWDED leaders, buckets that hold more
members than that can be replaced by finer ones, which a caller makes without losing a link.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrangle.llm import common as c

#: Leaders of a bucket are this many times more in each round; components are found anew when links grow by this part.
MORE, GROWN, CROWDED = 16, 1 / 16, 4096


def with_sizes(own: c.Scratch, keys: DataFrame, about: DataFrame) -> DataFrame:
    """Members (key, id) of buckets of two or more, without repeated rows, with `size`, `score` (the sum of a member's bucket sizes) and the
    columns of about, one row for each id. These columns, which can be wide, meet only members that share a bucket."""
    sizes = own.cut(keys.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"))
    sized = own.cut(keys.join(sizes, "key"))
    scores = sized.groupBy("id").agg(F.sum("size").alias("score"))
    out = own.cut(sized.join(scores.join(about, "id"), "id"))
    own.drop(sizes, sized)
    return out


def _pairs(members: DataFrame, leaders: DataFrame, extra: list[str], possible: Column, best_only: bool) -> DataFrame:
    """Distinct pairs of a leader and a member of its bucket that are in different components; if best_only, a member's pair with
    the leader of the highest score alone."""
    mine = members.select(F.col("key").alias("m_key"), "id", "comp", *extra)
    met = mine.join(leaders, (F.col("m_key") == F.col("key")) & F.expr("id <> l_id and comp <> l_comp") & possible)
    if best_only:
        met = met.groupBy("id").agg(F.max(F.struct("score", (-F.col("l_id")).alias("d"))).alias("m")).select("id", (-F.col("m.d")).alias("l_id"))
    return met.select(F.least("id", "l_id").alias("a"), F.greatest("id", "l_id").alias("b")).distinct()


def components(
    own: c.Scratch,
    members: DataFrame,
    extra: list[str],
    possible: Column,
    confirm: Callable[[DataFrame], DataFrame],
    finer: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame | None:
    """node, component of all ids that are linked, or None without a link. members: as with_sizes gives them, with the extra columns;
    possible: a condition on extra columns of a member and, with l_ before their names, a leader; confirm: the links (a, b) of pairs."""
    members = members.withColumn("comp", F.col("id"))
    table: DataFrame | None = None
    links = checked = latest = None
    n_links = n_known = 0
    round_no = -1  # in the first round a member meets only the best of its buckets' leaders
    many = 1
    while many:
        slots = MORE ** (round_no + 1)  # a bucket of no more members has all of them as leaders
        slot = F.when((F.col("size") <= slots) & (round_no >= 0), F.col("id")).otherwise(F.pmod(F.xxhash64("id"), F.lit(slots)))
        best = F.struct("score", (-F.col("id")).alias("d"), "comp", *extra)
        leaders = members.groupBy("key", slot.alias("slot")).agg(F.max(best).alias("m"))
        leaders = leaders.select("key", (-F.col("m.d")).alias("l_id"), "m.score", F.col("m.comp").alias("l_comp"), *(F.col(f"m.{x}").alias(f"l_{x}") for x in extra))
        pairs = _pairs(members, leaders, extra, possible, best_only=round_no < 0)
        if checked is not None:
            pairs = pairs.join(checked, ["a", "b"], "left_anti")
        pairs = own.cut(pairs)
        found, seen = own.measured(confirm(pairs))
        links = found if links is None else links.unionByName(found)
        checked = pairs if checked is None else checked.unionByName(pairs)
        rest = members
        if round_no >= 0:
            rest = rest.join(leaders.select("key", F.col("l_id").alias("id")), ["key", "id"], "left_anti")
        n_links += seen["n"]
        if n_links - n_known > n_known * GROWN:  # else the components are nearly as they were, which costs a few more pairs
            n_known = n_links
            latest = c.components(own, links)
            comps = latest.withColumnRenamed("node", "id")
            rest = rest.drop("comp").join(comps, "id", "left").withColumn("comp", F.coalesce("component", "id")).drop("component")
        open_keys = rest.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("key")
        last = table
        table, seen = own.measured(rest.join(open_keys, "key", "left_semi"), F.max("size").alias("largest"))
        own.drop(last)
        members, many = table, seen["n"]
        if finer is not None and MORE ** (round_no + 1) < CROWDED <= MORE ** (round_no + 2):
            crowded = members.where(F.col("size") > CROWDED)
            if many and seen["largest"] > CROWDED:
                names = ["key", "id", *extra]
                fine = own.cut(finer(crowded.select(*names, "comp")).distinct())
                split = with_sizes(own, fine.select("key", "id"), fine.drop("key").distinct())
                rest = members.where(F.col("size") <= CROWDED)
                members = rest.unionByName(split.select(rest.columns))
        round_no += 1
    return latest if n_links == n_known else c.components(own, links)
