"""Votes of several frames about one clip or movie."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmloom.functions.rounding import rounded


def frame_vote(df: DataFrame, key: list[str], order: str, bucket: str, confidence: str, reject: str, attributes: list[str] | None = None) -> DataFrame:
    """One label per clip from its frames: (key, frames, reject, bucket, bucket_confidence, attributes...).

    Rejected if more than half of the frames say so (at least one).  Else the most
    frequent bucket wins, of equals the one seen first; the confidence is the
    mean over its frames times its share of all frames, 4 digits.  Attributes
    are those of its first frame.

    Frames are summed per (clip, bucket) on the map side.  Null confidence
    counts as 0.5, null reject as false; a null bucket is a bucket.
    """
    attributes = attributes or []
    one = F.struct(F.col(order), *[F.col(a) for a in attributes])
    per = df.groupBy(*key, F.col(bucket).alias("__b")).agg(
        F.count(F.lit(1)).alias("__n"),
        F.min(one).alias("__first"),
        F.sum(F.coalesce(F.col(confidence), F.lit(0.5))).alias("__c"),
        F.count_if(F.coalesce(F.col(reject), F.lit(False))).alias("__r"),
    )
    best = F.min_by(F.struct("__b", "__n", "__c", "__first"), F.struct((-F.col("__n")).alias("n"), F.col(f"__first.{order}").alias("o")))
    all_ = per.groupBy(*key).agg(F.sum("__n").cast("int").alias("frames"), F.sum("__r").alias("__r"), best.alias("__w"))
    refused = F.col("__r") >= F.greatest(F.lit(1), F.floor(F.col("frames") / 2) + 1)
    share = F.col("__w.__c") / F.col("__w.__n") * F.col("__w.__n") / F.col("frames")
    return all_.select(*key, "frames", refused.alias("reject"), F.col("__w.__b").alias(bucket), rounded(share, 4).alias(confidence), *[F.col(f"__w.__first.{a}").alias(a) for a in attributes])


def most_common(df: DataFrame, key: list[str], value: str, order: str) -> DataFrame:
    """The most frequent value per key with its count, of equals the one seen first."""
    per = df.groupBy(*key, F.col(value).alias("__v")).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("__o"))
    first = F.min_by(F.struct("__v", "n"), F.struct((-F.col("n")).alias("m"), "__o", "__v"))
    return per.groupBy(*key).agg(first.alias("b")).select(*key, F.col("b.__v").alias(value), F.col("b.n").alias("n"))


def frame_summary(df: DataFrame, key: list[str], frame: str, names: str, similarity: str, margin: str, score: str, order: tuple[int, ...] = (2, 1, 3)) -> DataFrame:
    """One row per clip from its frames: (key, actors, least_similarity, least_margin, clip_score).

    The actors are those of the first frame, in ``order``, that has any; the least
    similarity and margin go over all frames (0 where there is none), and the score is the mean over them.  A map-side
    aggregate: no frame but the chosen one is held.
    """
    place = F.array_position(F.array(*[F.lit(x) for x in order]), F.col(frame))
    chosen = F.min(F.when((place > 0) & (F.size(names) > 0), F.struct(place.alias("at"), F.col(names).alias("names"))))
    known = lambda c: F.when(~F.isnan(c), F.col(c))
    zero = F.lit(0.0)
    out = df.groupBy(*key).agg(chosen.alias("__c"), F.coalesce(F.min(known(similarity)), zero).alias("least_similarity"), F.coalesce(F.min(known(margin)), zero).alias("least_margin"), F.coalesce(F.avg(known(score)), zero).alias("clip_score"))
    return out.select(*key, F.coalesce("__c.names", F.array().cast("array<string>")).alias("actors"), "least_similarity", "least_margin", "clip_score")


def corner_vote(df: DataFrame, key: list[str], corners: dict[str, str], least_std: float = 40.0, least_votes: int = 2) -> DataFrame:
    """Whether a movie has a logo: each frame votes for its most contrasted corner above ``least_std``.

    (key, corner, votes, present); ``corners`` maps names to columns, of equals the first one counts.
    """
    rows = F.array(*[F.struct(F.col(c).cast("double").alias("s"), F.lit(-i).alias("o"), F.lit(n).alias("c")) for i, (n, c) in enumerate(corners.items())])
    top = F.array_max(F.filter(rows, lambda r: r["s"] > least_std))
    order = F.array_position(F.array(*[F.lit(n) for n in corners]), F.col("corner"))
    votes = df.select(*key, top["c"].alias("corner")).groupBy(*key, "corner").agg(F.count(F.lit(1)).alias("votes"))
    best = F.max_by(F.struct("corner", "votes"), F.struct(F.when(F.col("corner").isNull(), 0).otherwise(F.col("votes")).alias("v"), (-order).alias("o")))
    return votes.groupBy(*key).agg(best.alias("b")).select(*key, "b.corner", F.when(F.col("b.corner").isNull(), F.lit(0)).otherwise(F.col("b.votes")).alias("votes"), (F.col("b.corner").isNotNull() & (F.col("b.votes") >= least_votes)).alias("present"))


def crop_vote(boxes: Column) -> Column:
    """The box that most probes agree on, or the median of each side where all differ."""
    counts = F.transform(F.array_distinct(boxes), lambda b: F.struct(F.size(F.filter(boxes, lambda x: x == b)).alias("n"), (-F.array_position(boxes, b)).alias("o"), b.alias("b")))
    top = F.array_max(counts)
    side = lambda i: F.sort_array(F.transform(boxes, lambda b: b[i]))[F.floor(F.size(boxes) / 2).cast("int")]
    return F.when(top["n"] > 1, top["b"]).otherwise(F.array(*[side(i) for i in range(4)]))
