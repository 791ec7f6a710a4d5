"""From an institution's candidates to its logo: ranking, favicon fallback, image scores and the selection."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from typing import Protocol

import numpy as np
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from quadrangle.functions import scoring as S
from quadrangle.sources.scratch import written

BATCH, WINNERS, PREVIEWS = 36, 12, 5
#: Lists of candidates that a model gets at a time.
MODEL_BATCH = 64


class Ranker(Protocol):
    """A model that ranks candidates by their texts: returns indexes from 1 of the best, best first. It may have rank_many, which gets a
    list of lists and returns an answer for each."""

    def rank(self, candidates: list[dict]) -> Iterable[int]: ...


class ScoreRanker:
    """The default: by score, then key."""

    def __init__(self, winners: int = WINNERS):
        self.winners = winners

    def rank(self, candidates: list[dict]) -> list[int]:
        order = sorted(range(len(candidates)), key=lambda i: (-candidates[i]["initial_score"], candidates[i]["key"]))
        return [i + 1 for i in order[: self.winners]]


def valid_ranks(ranks: Iterable[int], n: int) -> list[int]:
    """A ranker's answer: indexes of shown candidates, each once, in its order."""
    return list(dict.fromkeys(i for i in ranks if isinstance(i, int) and 1 <= i <= n))


def top_by_score(inventory: DataFrame, by: str = "id", k: int = WINNERS, previews: int = PREVIEWS) -> DataFrame:
    """The retrieval table without a ranker: inventory with final_rank and status. Favicons come in only where an institution
    has nothing else."""
    icon = F.col("source").isin(*S.FAVICON_SOURCES)
    own = Window.partitionBy(by)
    rank = F.row_number().over(Window.partitionBy(by, icon).orderBy(F.desc("initial_score"), "key"))
    rows = inventory.withColumns({"_others": F.count_if(~icon).over(own), "_rank": rank, "_icon": icon})
    fallback = F.col("_icon") & (F.col("_others") == 0) & (F.col("_rank") <= previews)
    status = F.when(fallback, "selected_as_favicon_fallback").when(F.col("_icon"), "deferred_favicon").otherwise("ai_disabled")
    final = F.when(fallback | (~F.col("_icon") & (F.col("_rank") <= k)), F.col("_rank"))
    number = (F.floor((F.col("inventory_index") - 1) / BATCH) + 1).cast("int")
    return rows.withColumns({"final_rank": final, "status": status, "batch_number": number}).drop("_others", "_rank", "_icon")


def _loaded(ranker: Ranker | Callable[[], Ranker]) -> Ranker:
    return ranker if hasattr(ranker, "rank") else ranker()


def _model_ranks(groups: DataFrame, ranker: Ranker | Callable[[], Ranker], batch: int) -> Column:
    """Ranks (indexes from 1, best first, padded with 0) of the candidates in column `_shown`, an array of structs.

    Lists of many institutions go to the model together, `batch` at a time; a worker loads it once."""

    def make() -> Callable[[np.ndarray], np.ndarray]:
        model = _loaded(ranker)

        def predict(shown: np.ndarray) -> np.ndarray:
            lists = [[{"index": n + 1, **x} for n, x in enumerate(json.loads(s))] for s in shown]
            answers = model.rank_many(lists) if hasattr(model, "rank_many") else [model.rank(x) for x in lists]
            ranks = [valid_ranks(a, len(x)) for a, x in zip(answers, lists, strict=True)]
            out = np.zeros((len(ranks), max(1, *map(len, ranks))), np.int32)
            for row, r in zip(out, ranks, strict=True):
                row[: len(r)] = r
            return out

        return predict

    return predict_batch_udf(make, return_type=ArrayType(IntegerType()), batch_size=batch)(F.to_json("_shown"))


def ranked_by_text(
    inventory: DataFrame,
    ranker: Ranker | Callable[[], Ranker],
    by: str = "id",
    batch: int = BATCH,
    winners: int = WINNERS,
    previews: int = PREVIEWS,
    model_batch: int = MODEL_BATCH,
) -> DataFrame:
    """The retrieval table of a two-level tournament: each batch of an institution's candidates sends its winners on, and if more than
    `winners` come together they are ranked again. The default ranker is windows alone. A model, or a function that loads one in a
    worker, gets lists of candidates: at most `batch` of an institution, then at most all its winners."""
    kept = [c for c in inventory.columns if c not in ("batch_number", "batch_rank", "final_rank", "status")]
    shown = [c for c in ("source", "page_url", "url", "metadata", "ancestry", "region", "initial_score", "key") if c in kept]
    rows = inventory.select(*kept).withColumn("_icon", F.col("source").isin(*S.FAVICON_SOURCES))
    rows = rows.withColumn("_place", F.row_number().over(Window.partitionBy(by, "_icon").orderBy("inventory_index")))
    rows = rows.withColumn("_batch", (F.floor((F.col("_place") - 1) / batch) + 1).cast("int"))
    best = [F.desc("initial_score"), F.col("key")]

    def ranks(of: DataFrame, groups: list[str], some: Column, name: str) -> DataFrame:
        """of with the ranker's rank, from 1 or null, of the rows that meet `some`, in each group."""
        if isinstance(ranker, ScoreRanker):
            rank = F.row_number().over(Window.partitionBy(*groups, some).orderBy(*best))
            return of.withColumn(name, F.when(some & (rank <= ranker.winners), rank))
        entry = F.struct("_turn", F.struct(*shown).alias("x"), F.col("inventory_index").alias("i"))
        lists = of.where(some).groupBy(*groups).agg(F.sort_array(F.collect_list(entry)).alias("_l"))  # a batch, or the winners of one institution
        lists = lists.withColumn("_shown", F.transform("_l", lambda e: e["x"]))
        told = written(lists.withColumn("_ranks", _model_ranks(lists, ranker, model_batch)).select(by, "_l", "_ranks"))
        told = told.select(by, "_l", F.posexplode("_ranks").alias("_at", "_n")).where("_n > 0")
        told = told.select(by, F.get("_l", F.col("_n") - 1)["i"].alias("inventory_index"), (F.col("_at") + 1).alias(name))
        return of.join(told, [by, "inventory_index"], "left")

    rows = ranks(rows.withColumn("_turn", F.struct("_batch", F.col("inventory_index").alias("r"))), [by, "_batch"], ~F.col("_icon"), "batch_rank").drop("_turn")
    short = F.col("batch_rank").isNotNull()
    rows = rows.withColumns({"_short": short, "_n_short": F.count_if(short).over(Window.partitionBy(by))})
    rows = rows.withColumn("_in_turn", F.row_number().over(Window.partitionBy(by, "_short").orderBy("_batch", "batch_rank")))
    many = F.col("_short") & (F.col("_n_short") > winners)
    rows = ranks(rows.withColumn("_turn", F.struct("_batch", F.col("batch_rank").alias("r"))), [by], many, "_again").drop("_turn")
    icon_rank = F.row_number().over(Window.partitionBy(by, "_icon").orderBy(*best))
    n_final = F.when(F.col("_n_short") > winners, F.count("_again").over(Window.partitionBy(by))).otherwise(F.col("_n_short"))
    rows = rows.withColumns({"_icon_rank": icon_rank, "_n_final": n_final})
    fallback = F.col("_icon") & (F.col("_n_final") == 0) & (F.col("_icon_rank") <= previews)
    final = F.when(F.col("_short") & (F.col("_n_short") <= winners), F.col("_in_turn")).when(F.col("_short"), F.col("_again")).when(fallback, F.col("_icon_rank"))
    status = (
        F.when(fallback, "selected_as_favicon_fallback").when(F.col("_icon"), "deferred_favicon").when(final.isNotNull(), "selected_for_visual")
        .when(F.col("_short"), "shortlisted_by_text").otherwise("not_selected_by_text")
    )
    number = F.when(F.col("_short"), F.col("_batch")).otherwise((F.floor((F.col("inventory_index") - 1) / BATCH) + 1).cast("int"))
    return rows.select(*kept, number.alias("batch_number"), F.col("batch_rank").cast("int").alias("batch_rank"), final.cast("int").alias("final_rank"), status.alias("status"))


def with_images(retrieval: DataFrame, images: DataFrame, by: str = "id", previews: int = PREVIEWS, by_score: bool = True) -> DataFrame:
    """The ranked candidates whose image could be had (images: key, width, height, preview), scored; of images with equal
    content the first stays; at most `previews` of each institution, with candidate_rank."""
    rows = retrieval.where("final_rank is not null").join(images, "key")
    rows = rows.withColumn("score", S.shape_score(F.col("initial_score"), F.col("width"), F.col("height"))).withColumn("fingerprint", F.sha2("preview", 256))
    order = [F.desc("score"), F.coalesce("url", "page_url")] if by_score else [F.col("final_rank")]
    first = F.row_number().over(Window.partitionBy(by, "fingerprint").orderBy(*order, "key"))
    rows = rows.withColumn("_n", first).where("_n = 1")
    rank = F.row_number().over(Window.partitionBy(by).orderBy(*order, "key"))
    return rows.withColumn("candidate_rank", rank).where(F.col("candidate_rank") <= previews).drop("_n")


def select_by_score(candidates: DataFrame, min_score: int = S.MIN_SCORE) -> DataFrame:
    return candidates.withColumn("auto_selected", (F.col("candidate_rank") == 1) & (F.col("score") >= min_score))


def select_by_assessment(candidates: DataFrame, selections: DataFrame, assessments: DataFrame, by: str = "id", threshold: float = S.AI_THRESHOLD) -> DataFrame:
    """candidates with a model's choice (selections: id, chosen or null, confidence) and its view of each candidate (assessments:
    id, candidate_rank, kind, eligible): score capped, ai_status and auto_selected."""
    rows = candidates.join(assessments, [by, "candidate_rank"], "left").join(selections, by, "left")
    fallback = F.col("status") == "selected_as_favicon_fallback"
    own = F.coalesce(S.acceptable(F.col("kind"), F.col("eligible"), F.col("source"), fallback), F.lit(False))
    chosen_ok = F.max((F.col("candidate_rank") == F.col("chosen")) & own).over(Window.partitionBy(by))
    status = S.selection_status(F.col("chosen"), F.coalesce(chosen_ok, F.lit(False)), F.col("confidence"), threshold)
    rows = rows.withColumn("ai_status", status).withColumn("score", S.review_score(F.col("score"), F.col("kind"), F.coalesce("eligible", F.lit(False))))
    return rows.withColumn("auto_selected", (F.col("ai_status") == "accepted") & F.coalesce(F.col("candidate_rank") == F.col("chosen"), F.lit(False)))


def invalid_selections(candidates: DataFrame, selections: DataFrame, assessments: DataFrame, by: str = "id") -> DataFrame:
    """id, problem of answers that must not be used: a choice outside the candidates, or not every candidate assessed once."""
    shown = candidates.groupBy(by).agg(F.collect_set("candidate_rank").alias("shown"))  # at most the previews of one institution
    said = assessments.groupBy(by).agg(F.sort_array(F.collect_list("candidate_rank")).alias("said"))
    rows = selections.join(shown, by, "left").join(said, by, "left")
    outside = F.col("chosen").isNotNull() & ~F.coalesce(F.array_contains("shown", F.col("chosen")), F.lit(False))
    uneven = ~F.coalesce(F.array_sort("shown") == F.array_sort("said"), F.lit(False))
    problem = F.when(outside, "candidate outside the set").when(uneven, "not every candidate assessed once")
    return rows.select(by, problem.alias("problem")).where("problem is not null")
