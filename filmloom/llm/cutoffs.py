"""Problem 7: a cutoff per source that keeps a target fraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmloom.operators.positions import positions
from filmloom.operators.snapshot import clean, current_rows, number, stands
from filmloom.sources.tables import table


def fraction_cutoffs(records: DataFrame, source: str, item: str, score: str, percent: str) -> tuple[DataFrame, DataFrame]:
    """The score from which on a source keeps its percentage, and the records kept.

    With n records of the source that have a score, the cutoff is the
    ceil(n * percent / 100)-th highest one; ties of it are kept too.  The
    records lie in order of (source, score from high to low, item) over all
    partitions, and the exact cumulative position tells the row that holds the
    cutoff.

    ``percent`` is a column of ``records``, the same in all rows of a source.
    Returns (cutoffs, kept): cutoffs has source, ``n``, ``target``, ``cutoff``,
    ``kept``; kept has source, item, score, ``cutoff``.  Records with null source,
    item or percent, and those whose score is null or NaN, take no part; a percentage of
    0 or less keeps nothing, one above 100 everything; an empty table gives
    empty results.
    """
    part = records.select(F.col(source).alias("s"), F.col(item).alias("i"), number(F.col(score).cast("double")).alias("v"), F.col(percent).cast("bigint").alias("p")).dropna()
    at = positions(part, ["s"], [F.col("v").desc(), F.col("i")], total="n")
    target = F.least(F.col("n"), F.ceil((F.col("n") * F.col("p")) / 100))
    cut = at.withColumn("target", target).where("position = target").select(F.col("s").alias("cs"), "n", "target", F.col("v").alias("cutoff"))
    kept = at.select("s", "i", "v").join(cut, F.col("s") == F.col("cs")).where("v >= cutoff")
    sizes = kept.groupBy("s").agg(F.count(F.lit(1)).alias("kept"), F.first("n").alias("n"), F.first("target").alias("target"), F.first("cutoff").alias("cutoff"))
    return (
        sizes.select(F.col("s").alias(source), "n", "target", "cutoff", "kept"),
        kept.select(F.col("s").alias(source), F.col("i").alias(item), F.col("v").alias(score), "cutoff"),
    )


def _movies(spark, folder: str) -> tuple[DataFrame, DataFrame]:
    columns = {"video_id": clean(F.col("video_id")), "final_score": F.col("final_score"), "keep": F.col("keep"), "reject": F.col("reject")}
    standing = current_rows(table(spark, folder, "clips"), columns).where(stands() & F.col("final_score").isNotNull())
    movies = source_types(spark, folder)
    targets = table(spark, folder, "keep_targets").select(clean(F.col("source_type")).alias("source_type"), "keep_pct")
    targets = targets.groupBy("source_type").agg(F.max("keep_pct").alias("keep_pct"))
    listed = movies.join(targets, "source_type")
    return fraction_cutoffs(standing.select("clip_id", "video_id", "final_score").join(listed, "video_id"), "video_id", "clip_id", "final_score", "keep_pct")


def source_types(spark, folder: str) -> DataFrame:
    """(video_id, source_type) of each listed movie; null or blank is youtube, of repeated entries the latest holds."""
    kind = clean(F.col("source_type"))
    named = F.when(kind != "", kind).otherwise(F.lit("youtube"))
    movie = clean(F.col("video_id"))
    listed = table(spark, folder, "movie_registry").select(movie.alias("video_id"), named.alias("k"), "registered_at").dropna(subset=["video_id"])
    return listed.groupBy("video_id").agg(F.max(F.struct("registered_at", "k")).alias("m")).select("video_id", F.col("m.k").alias("source_type"))


def p7_found(spark, folder: str) -> DataFrame:
    """Clips whose final score reaches the cutoff of their movie."""
    return _movies(spark, folder)[1].select("clip_id")


def p7_cutoffs(spark, folder: str) -> DataFrame:
    """Cutoff and sizes of each movie."""
    return _movies(spark, folder)[0]


QUERIES = {"p7_found": p7_found, "p7_cutoffs": p7_cutoffs}
