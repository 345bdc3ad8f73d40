"""Sinks: snapshots, exports and their indexes."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmloom.functions.naming import file_name, parent_name, unique_stem
from filmloom.functions.scoring import keeps, rejected
from filmloom.schema import EXPORT


def snapshot(df: DataFrame, path: str, *, fmt: str = "parquet", by: str | None = None, version: str = "1.0") -> None:
    """Write a new snapshot with a schema version; rows that have one keep it. The committer makes it appear as a whole."""
    own = F.coalesce(F.col("schema_version"), F.lit(version)) if "schema_version" in df.columns else F.lit(version)
    w = df.withColumn("schema_version", own).write.mode("overwrite")
    (w.partitionBy(by) if by else w).format(fmt).save(path)


def table_csv(df: DataFrame, path: str) -> None:
    """CSV with header and a fixed column list; arrays and other nested values as JSON, null as empty."""
    nested = [c for c, t in df.dtypes if t.startswith(("array", "struct", "map"))]
    df.withColumns({c: F.to_json(c) for c in nested}).write.mode("overwrite").csv(path, header=True, emptyValue="")


def accepted(df: DataFrame, verdicts: list[str]) -> DataFrame:
    """Clips with one of the verdicts that are kept and not rejected."""
    return df.where(F.upper(F.trim("verdict")).isin(verdicts) & keeps(F.col("keep")) & ~rejected(F.col("reject")))


def caption_rows(df: DataFrame, verdicts: list[str]) -> DataFrame:
    """The twelve columns of the caption export."""
    return accepted(df, verdicts).select(*EXPORT)


def filled(df: DataFrame) -> DataFrame:
    """All columns as text, nested ones as JSON, null as empty."""
    text = lambda c, t: F.to_json(c) if t.startswith(("array", "struct", "map")) else F.col(c).cast("string")
    return df.select(*[F.coalesce(text(c, t), F.lit("")).alias(c) for c, t in df.dtypes])


def bucket_index(df: DataFrame, folder: str, bucket: str = "bucket") -> DataFrame:
    """(bucket, count, manifest, clips_dir) of the partitioned export."""
    b = F.coalesce(F.col(bucket), F.lit("unknown"))
    where = lambda part: F.concat(F.lit(f"{folder}/"), F.col(bucket), F.lit(f"/{part}"))
    return df.groupBy(b.alias(bucket)).agg(F.count(F.lit(1)).alias("count")).select(bucket, "count", where("manifest.jsonl").alias("manifest"), where("clips").alias("clips_dir"))


def write_buckets(df: DataFrame, path: str, bucket: str = "bucket") -> None:
    """One folder of JSON Lines per bucket. Rows are spread over the buckets' tasks first, so a hot bucket takes several."""
    df.withColumn(bucket, F.coalesce(F.col(bucket), F.lit("unknown"))).write.mode("overwrite").partitionBy(bucket).json(path)


def rejected_union(discarded: DataFrame, refused: DataFrame) -> DataFrame:
    """Rows of both kinds with where they come from; one that is in both counts twice."""
    return discarded.withColumn("origin", F.lit("gate")).unionByName(refused.withColumn("origin", F.lit("classify")), allowMissingColumns=True)


def export_name(path: Column) -> Column:
    """Name of an exported image: folder and stem, with its own extension."""
    return F.concat(unique_stem(path), F.regexp_extract(file_name(path), r"(\.[^.]*)$", 1))


def reject_folder(reason: Column) -> Column:
    """Folder of clips that were refused for a reason; null where there is none."""
    # Folders by reason.
    return F.when(reason == "duplicate", "dups").when(reason == "static", "static_clips").when(reason == "excessive_motion", "excessive_motion").when(reason == "low_quality", "low_quality")


def run_folder(base: str, video: str, stamp: str | None, layout: str = "per_run") -> str:
    """Folder of one run: shared (legacy), one per run, or one per movie."""
    return {"legacy": base, "per_run": f"{base}/{video}_{stamp}", "per_movie": f"{base}/{video}"}[layout]


def runs(df: DataFrame, path: str = "path") -> DataFrame:
    """(video_id, run) of run folders ``<video>_YYYYmmdd_HHMMSS``."""
    form = r"^(.+)_(\d{8}_\d{6})$"
    return df.where(file_name(F.col(path)).rlike(form)).select(F.regexp_extract(file_name(F.col(path)), form, 1).alias("video_id"), file_name(F.col(path)).alias("run"))


def faces_long(df: DataFrame, key: list[str], faces: str) -> DataFrame:
    """One row per face with its position in the frame; frames without faces give none."""
    return df.select(*key, F.posexplode(faces).alias("position", "face")).select(*key, "position", "face.*")


def video_filter(crop: Column, box: Column) -> Column:
    """Filter text for a media tool: crop first, then the removal of a logo; empty without either."""
    logo = F.when(F.size(box) == 4, F.format_string("delogo=x=%d:y=%d:w=%d:h=%d", box[0], box[1], box[2], box[3]))
    return F.concat_ws(",", F.when(F.coalesce(crop, F.lit("")) != "", F.concat(F.lit("crop="), crop)), logo)


def filter_attempts(crop: Column, box: Column) -> Column:
    """Filter texts to try in order: all, the crop alone, none; each once."""
    none = F.array().cast("array<int>")
    return F.array_distinct(F.array(video_filter(crop, box), video_filter(crop, none), F.lit("")))


def origin_folder(path: Column) -> Column:
    return parent_name(path)


def safe_name(s: str) -> str:
    """A folder name without blanks and separators."""
    return re.sub(r"[^\w.-]+", "_", s).strip("_")
