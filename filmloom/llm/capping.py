"""Problem 6: no more than so many records per contributor, the best ones first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filmloom.operators.positions import positions
from filmloom.operators.snapshot import clean, current_rows, number, stands
from filmloom.session import materialise
from filmloom.sources.tables import table


def capped(
    records: DataFrame,
    contributor: str,
    item: str,
    quality: str,
    *,
    cap: int | None = None,
    share: tuple[int, int] | None = None,
    bins: int = 256,
) -> DataFrame:
    """Mark the records beyond the cap of their contributor: (item, contributor, quality, ``kept``).

    A contributor keeps its first ``cap`` records by quality from high to low
    (null and NaN last), equal quality by item.  ``share`` (a, b) stands for
    cap = floor(records * a / b).

    Each contributor's quality goes into a histogram, a sum of small counts that is
    reduced on the map side (one more bin holds missing values).  The bins follow the data: ``bins`` of them to the
    interquartile range around the median, and ever wider ones outside, so that neither the
    scale nor a few extreme values matter.  From it follow, for contributors above the cap,
    the bin in which the cap is reached: better bins are kept, worse ones fall
    out, and only the records of that one bin are ranked, by positions that
    spread over many tasks however large the bin is.

    Defined cases: records without an item are left out; a null contributor is a
    contributor like any other; infinite qualities lie in bins of their own;
    repeated rows count each; an empty table gives an empty result.
    """
    if (cap is None) == (share is None):
        raise ValueError("give either cap or share")
    score = F.col(quality).cast("double")
    narrow = materialise(records.where(F.col(item).isNotNull()).select(F.col(contributor).alias("c"), F.col(item).alias("i"), number(score).alias("q")))
    facts = narrow.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(F.when(F.abs("q") < float("inf"), F.col("q")), [0.25, 0.5, 0.75], 1000).alias("p")).first()
    if share:
        cap = facts["n"] * share[0] // share[1]
    low, middle, high = facts["p"] or (0.0, 0.0, 0.0)
    # Nondecreasing in q: linear near the median, logarithmic far from it.
    z = (F.col("q") - middle) / ((high - low) or 1.0)
    step: Column = F.floor(F.signum(z) * F.log1p(F.abs(z)) * bins).cast("int")
    far = 2**30
    binned = narrow.withColumn("bin", F.when(F.col("q") == float("inf"), far).when(F.col("q") == float("-inf"), -far).otherwise(F.coalesce(step, F.lit(-far - 1))))
    histogram = binned.groupBy("c", "bin").agg(F.count(F.lit(1)).alias("n"))
    by = Window.partitionBy("c")
    above = F.coalesce(F.sum("n").over(by.orderBy(F.col("bin").desc()).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    reached = histogram.withColumn("above", above).where((F.col("above") <= cap) & (F.col("above") + F.col("n") > cap))
    cutoff = reached.select(F.col("c").alias("cc"), F.col("bin").alias("cut"), (F.lit(cap) - F.col("above")).alias("room"))
    placed = binned.join(cutoff, F.col("c").eqNullSafe(F.col("cc")), "left")
    border = placed.where("bin = cut").select("c", "i", "q", "room")
    ranked = positions(border, ["c"], [F.col("q").desc_nulls_last(), F.col("i")])
    clear = placed.where("cut is null or bin <> cut").select("c", "i", "q", F.coalesce(F.col("bin") > F.col("cut"), F.lit(True)).alias("kept"))
    out = clear.unionByName(ranked.select("c", "i", "q", (F.col("position") <= F.col("room")).alias("kept")))
    return out.select(F.col("i").alias(item), F.col("c").alias(contributor), F.col("q").alias(quality), "kept")


def _standing(spark, folder: str) -> DataFrame:
    columns = {"video_id": clean(F.col("video_id")), "final_score": F.col("final_score"), "keep": F.col("keep"), "reject": F.col("reject")}
    return current_rows(table(spark, folder, "clips"), columns).where(stands())


def p6_found(spark, folder: str) -> DataFrame:
    """Standing clips beyond a fiftieth of all for their movie."""
    return capped(_standing(spark, folder), "video_id", "clip_id", "final_score", share=(1, 50)).where("not kept").select("clip_id")


QUERIES = {"p6_found": p6_found}
