"""Problem 4: one ranking from several differently scaled scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmloom.operators.positions import cumulative, positions
from filmloom.operators.snapshot import current_rows, number, stands
from filmloom.sources.tables import table


def borda(items: DataFrame, group: str, item: str, scores: dict[str, float], *, missing: str = "lowest") -> DataFrame:
    """Borda count of each item within its group: (group, item, ``points``, ``place``).

    Each score ranks the items of a group; equal values share the average of
    their ranks, so that scale and distribution of a score play no part.  The
    points of an item are the weighted sum of its ranks (the lowest value has
    rank 1); ``place`` orders them from high to low, equal points by item.

    A null or NaN value takes part as the lowest place: all missing ones share
    the average rank at the bottom (``missing='lowest'``), or the middle rank of
    the group (``missing='middle'``).  Rows with a null group or item are not
    ranked.  Repeated (group, item) rows all take part in the ranks, and the item
    gets the mean of their points.  An empty table gives an empty result.
    """
    kept = items.select(F.col(group).alias("g"), F.col(item).alias("i"), *[number(F.col(s).cast("double")).alias(f"s{k}") for k, s in enumerate(scores)]).dropna(subset=["g", "i"])
    # One row per item and score; equal values are counted together before anything is sorted.
    long = kept.select("g", "i", F.posexplode(F.array(*[f"s{k}" for k in range(len(scores))])).alias("k", "v"))
    held = long.groupBy("g", "k", "v").agg(F.count(F.lit(1)).alias("n"))
    ranked = cumulative(held, ["g", "k"], [F.col("v")], "n")
    middle = (F.col("size") + 1) / 2
    rank: Column = F.col("below") + (F.col("n") + 1) / 2
    if missing == "middle":
        rank = F.when(F.col("v").isNull(), middle).otherwise(rank)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in scores.values()]), F.col("k") + 1)
    worth = ranked.select(F.col("g").alias("__g"), F.col("k").alias("__k"), F.col("v").alias("__v"), (rank * weight).alias("points"))
    same = (F.col("g") == F.col("__g")) & (F.col("k") == F.col("__k")) & F.col("v").eqNullSafe(F.col("__v"))
    copies = F.count(F.lit(1)) / len(scores)
    points = long.join(worth, same).groupBy("g", "i").agg((F.sum("points") / copies).alias("points"))
    placed = positions(points, ["g"], [F.col("points").desc(), F.col("i")], name="place")
    return placed.select(F.col("g").alias(group), F.col("i").alias(item), "points", "place")


SCORES = {"clip_score": 1.0, "icr": 1.0, "aod": 1.0, "dover_score": 1.0}


def p4_ranking(spark, folder: str) -> DataFrame:
    """Place and points of every standing clip in its batch."""
    columns = {c: F.col(c) for c in ["batch_id", *SCORES, "keep", "reject"]}
    standing = current_rows(table(spark, folder, "clips"), columns).where(stands())
    return borda(standing, "batch_id", "clip_id", SCORES)


def p4_found(spark, folder: str) -> DataFrame:
    """The shortlist of each batch: its first clips, as many as the done run asks for."""
    runs = table(spark, folder, "score_batches").where(F.lower(F.trim("status")) == "done")
    runs = runs.groupBy("batch_id").agg(F.max_by("shortlist_size", F.struct("started_at", "shortlist_size")).alias("shortlist_size"))
    return p4_ranking(spark, folder).join(runs, "batch_id").where("place <= shortlist_size").select("batch_id", "clip_id")


QUERIES = {"p4_found": p4_found, "p4_ranking": p4_ranking}
